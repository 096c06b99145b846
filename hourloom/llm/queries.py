"""One query per operator over the whole tables, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    katz,
    line_dedup,
    merkle,
    minhash_dedup,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    toxicity,
    vector_codes,
)
from hourloom.llm import sql as texts
from hourloom.llm.common import documents, embeddings, labels, remainder, stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def vocabulary_path() -> str:
    """The vocabulary file that the contracts name; another path serves as well."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


@query()
def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_dedup(documents(spark, folder))


@query()
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary_path()
    ids = bpe.encode(documents(spark, folder).select("doc_id", F.coalesce("text", F.lit("")).alias("text")), path)
    return bpe.decode(ids, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    limits = " AND ".join(
        f"{m} {sign} {value}"
        for m, least, most in quality_rules.THRESHOLDS
        for sign, value in ((">=", least), ("<=", most))
        if value is not None
    )
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id),
counts AS (SELECT doc_id, len(w) AS n_words,
    length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
    coalesce(n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words
  FROM docs LEFT JOIN covered USING (doc_id)),
ratios AS (SELECT *,
    CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END AS mean_word_length,
    CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN n_stop_words::DOUBLE / n_words ELSE 0 END AS stop_word_share,
    CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END AS repeat_word_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END AS dup_line_share,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND {limits} AS kept
FROM ratios"""


@query(_quality_sql())
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_rules(documents(spark, folder).select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"qr_{n}").alias(n) for n in names])


@query()
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit_packing(documents(spark, folder), vocabulary_path())


_DIGESTED = r"""
WITH rows AS (SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
ranked AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked"""


@query(_DIGESTED)
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, folder))


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), labels(spark, folder))


@query()
def op7_katz(spark: SparkSession, folder: str) -> DataFrame:
    return katz.katz_of_folds(documents(spark, folder))


@query()
def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_classifier.classify(documents(spark, folder).select("doc_id", "text"))
    return scored.select("doc_id", "score", "weak_label", (F.col("score") >= 0.5).alias("kept"))


@query()
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rest = line_dedup.line_dedup(documents(spark, folder).select("doc_id", "text"))
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    return rest.select("doc_id", lines.alias("n_lines"), "n_dropped", F.sha2("text", 256).alias("text_sha256"))


SHARDS = [f"shard-{i:03d}" for i in range(128)]


@query()
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(documents(spark, folder).select("doc_id", "source"), ["doc_id"], SHARDS)


@query(
    texts.vector_codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE)
)
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_codes.vector_codes(embeddings(spark, folder), carry=["label"])
    coded = found.rows.select("vec_id", "label", vector_codes.hex_code(F.col("entries")).alias("code"), "error")
    rows = vector_codes.with_total(stored(coded, "coded"), "label", "error", "label_error")
    digest = F.lit(found.digest()).alias("codebooks_sha256")
    return rows.select("vec_id", "code", "error", "label_error", digest)


@query(texts.embedding_dedup_sql(embedding_dedup.COSINE))
def op12_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(embeddings(spark, folder))


@query(texts.merkle_sql())
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) == 0)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = merkle.manifest(documents(spark, folder), altered={"text": lower}, when=tampered)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
