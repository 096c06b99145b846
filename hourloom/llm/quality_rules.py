"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Native: no Python runs on the executors. All numbers of a text come from its own row, so
there is no shuffle, and a long text costs n log n of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import SPACES, words_of

SYMBOLS = "#*$%&|<>"

# Frequent short words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is was for that with this be by from it on as at an a are or "
    "le la les de des du un une et en dans pour que qui sur par est au aux "
    "der die das und von mit den dem ein eine im zu ist für auf nicht sich "
    "el los las del y por con una se no es"
).split()

#: (measure, least, most); None is no limit. The measures are those of ``measures``.
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 50, None),
    ("mean_word_length", 2.0, 14.0),
    ("symbols_per_word", None, 0.15),
    ("stop_word_share", 0.03, None),
    ("repeat_word_share", None, 0.5),
    ("dup_line_share", None, 0.5),
)

MEASURES = (
    "_words _lines _windows _at word_chars n_symbols n_words n_stop_words n_lines n_dup_lines n_repeat_words "
    "mean_word_length symbols_per_word stop_word_share repeat_word_share dup_line_share base_failed kept"
).split()


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """The rows with the counts and ratios of their whole texts; a null text has no words.

    Three-word windows are compared by 64-bit hash within a text. Ratios of a text without
    words, or without lines with words, are 0. New columns carry ``prefix``
    and replace columns of the same name.
    """
    p = prefix
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in {p + m for m in MEASURES}]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = docs.select(
        *kept,
        words_of(F.col(f"`{text}`")).alias(f"{p}_words"),
        lines.alias(f"{p}_lines"),
        F.length(F.translate(body, SPACES, "")).cast("long").alias(f"{p}word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias(f"{p}n_symbols"),
    )
    kept += [F.col(f"{p}word_chars"), F.col(f"{p}n_symbols")]
    w = F.col(f"{p}_words")
    windows = F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    df = df.select(
        *kept,
        F.size(w).cast("long").alias(f"{p}n_words"),
        F.sort_array(windows).alias(f"{p}_windows"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias(f"{p}n_stop_words"),
        F.size(f"{p}_lines").cast("long").alias(f"{p}n_lines"),
        (F.size(f"{p}_lines") - F.size(F.array_distinct(f"{p}_lines"))).cast("long").alias(f"{p}n_dup_lines"),
    )
    kept += [F.col(f"{p}{c}") for c in ("n_words", "n_stop_words", "n_lines", "n_dup_lines")]
    s = F.col(f"{p}_windows")
    same = lambda j: (F.get(s, j)["h"] == F.get(s, j - 1)["h"]) | (F.get(s, j)["h"] == F.get(s, j + 1)["h"])
    repeated = F.when(
        F.size(s) >= 2, F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.coalesce(same(j), F.lit(False)))
    ).otherwise(F.array().cast("array<int>"))
    df = df.select(*kept, F.sort_array(F.transform(repeated, lambda j: F.get(s, j)["i"])).alias(f"{p}_at"))
    at = F.col(f"{p}_at")
    covered = F.aggregate(
        F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    # Never below 0, but not known to be deterministic: a filter on what follows would else be
    # pushed below all projections above, each of their expressions repeated for every use.
    fence = F.when(F.monotonically_increasing_id() < 0, 1).otherwise(0)
    df = df.select(*kept, (covered + fence).alias(f"{p}n_repeat_words"))
    share = lambda a, b: F.when(F.col(p + b) > 0, F.col(p + a) / F.col(p + b)).otherwise(0.0)
    return df.withColumns(
        {
            f"{p}mean_word_length": share("word_chars", "n_words"),
            f"{p}symbols_per_word": share("n_symbols", "n_words"),
            f"{p}stop_word_share": share("n_stop_words", "n_words"),
            f"{p}repeat_word_share": share("n_repeat_words", "n_words"),
            f"{p}dup_line_share": share("n_dup_lines", "n_lines"),
        }
    )


def compiled(thresholds=THRESHOLDS, prefix: str = "") -> Column:
    """One condition: every measure lies within its limits."""
    passed = F.lit(True)
    for measure, least, most in thresholds:
        if least is not None:
            passed = passed & (F.col(prefix + measure) >= least)
        if most is not None:
            passed = passed & (F.col(prefix + measure) <= most)
    return passed


def quality_rules(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS, prefix: str = "qr_") -> DataFrame:
    """The rows with measures, ``base_failed`` and ``kept``, all under ``prefix``.

    base_failed: fewer than 50 words, or over half of the words in repeated windows.
    Null and empty texts fail it. Rows are judged one by one, so repeated rows get equal
    verdicts and an empty table stays empty; columns of other names pass through.
    """
    p = prefix
    failed = (F.col(f"{p}n_words") < 50) | (100 * F.col(f"{p}n_repeat_words") > 50 * F.col(f"{p}n_words"))
    df = measured(docs, text, p).withColumn(f"{p}base_failed", failed)
    return df.withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & compiled(thresholds, p))
