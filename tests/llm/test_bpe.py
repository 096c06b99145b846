import hashlib

import pytest
from helpers import ODD, table
from hypothesis import given, settings
from hypothesis import strategies as st

from hourloom.llm import queries
from hourloom.llm.bpe import Bpe, decode, encode, id_lists

tokenizers = pytest.importorskip("tokenizers")
PATH = queries.vocabulary_path()


@pytest.fixture(scope="module")
def both():
    with open(PATH, encoding="utf-8") as f:
        return Bpe(f.read()), tokenizers.Tokenizer.from_file(PATH)


def same(both, text):
    own, library = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.ids(text).tolist() == ids
    assert own.decode(id_lists([own.ids(text)])).to_pylist() == [library.decode(ids, skip_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x52F, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_any_text_encodes_as_the_library_does(both, text):
    same(both, text)


@pytest.mark.parametrize("text", [r[1] or "" for r in ODD] + ["ΑΣ ΣΑΣ.", "İ", "x" * 33, "ab" * 3000, "don't 'LL 's's", "<|startoftext|>a"])
def test_odd_texts(both, text):
    same(both, text)


def test_long_and_short_words_merge_alike(both):
    own, _ = both
    words = [w.encode() for w in ("a", "information", "internationalization", "qqqqqqqqqqqqqqqq")]
    short = own.merge_short(words, 32)
    assert [list(own.merge_long(w)) for w in words] == [list(memoryview(s).cast("i")) for s in short]


def test_rows_and_columns_pass(spark, both):
    _, library = both
    docs = table(spark, clash=True)
    rows = decode(encode(docs, PATH), PATH).collect()
    assert len(rows) == len(ODD)
    want = sorted(library.encode(r[1] or "", add_special_tokens=False).ids for r in ODD)
    assert sorted(r["ids"] for r in rows) == want
    assert "text" not in rows[0].asDict() and rows[0]["kept"] in ("en", "de", None)
    empty = decode(encode(docs.limit(0), PATH), PATH)
    assert empty.count() == 0 and "decoded" in empty.columns


def test_ids_without_a_token_are_left_out(spark):
    rows = spark.createDataFrame([([320, -1, 10**6, 320],), ([],), (None,)], "ids array<int>")
    first = decode(rows.limit(1), PATH).first()["decoded"]
    assert first == "a</w> a</w>"
    assert [r["decoded"] for r in decode(rows, PATH).collect()] == [first, "", ""]


def test_query(spark, tmp_path, both):
    _, library = both
    table(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op2_bpe(spark, str(tmp_path)).collect())
    want = []
    for r in ODD:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        texts = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        want.append((len(ids), *[hashlib.sha256(t.encode()).hexdigest() for t in texts]))
    assert got == sorted(want)
