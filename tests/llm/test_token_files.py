"""Token files against the library, and what their readers skip."""

from __future__ import annotations

import glob
import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from edges import ROWS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from varve.llm import queries
from varve.llm import token_files as files
from varve.session import fresh_dir

SPEC = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(SPEC)
ODD = [
    "Ünḯcöde  ΣΑΣ Σ x y\x1cz\x85q​w don't WE'LL 12345 <|endoftext|>a<|startoftext|> <|end oftext|>",
    "́ starts with a mark ́and another",
    "İstanbul ﬁne Å 각 日本語 \U0001f600\U0001f600 _ __ a_b",
]


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def digest(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def placed(pairs):
    """{(doc_id, start, n_tokens, crc)} of documents in order; rows of one id may stand in any order."""
    at, out = 0, []
    for doc, text in pairs:
        ids = ids_of(text)
        out.append((doc, at, len(ids), digest(ids)))
        at += len(ids)
    return out


def encoded(encoder, texts):
    """The ids of each text, as lists."""
    ids, ends = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]


def test_word_encoder_equals_the_library():
    encoder = files.WordEncoder(SPEC, 2)
    texts = [t or "" for _, t in ROWS] + ODD
    for _ in range(2):
        for text, ids in zip(texts, encoded(encoder, texts)):
            assert ids == ids_of(text), text[:80]
    assert encoded(encoder, []) == []
    assert encoded(files.WordEncoder(SPEC, None), texts[3:9]) == [ids_of(t)[:-1] for t in texts[3:9]]


def test_random_words_equal_the_library():
    """Letters, marks, contractions and special strings in every order, in words and beside odd spaces."""
    rng = random.Random(7)
    signs = ["a", "B", "é", "É", "ß", "1", "'s", "'", ".", ",", "#", "***", "<|endoftext|>", "-", "\u0301", "\u0338", "ﬁ", "İ", "Σ", "日", "_", "|", "<", "¼"]
    gaps = [" ", "\n", "\x1d", "\u2003", "\xa0", "", "\x0b", "\u200b"]
    encoder = files.WordEncoder(SPEC, 2)
    texts = ["".join(rng.choice(signs) + rng.choice([*gaps, *[""] * 20]) for _ in range(60)) for _ in range(400)]
    for text, ids in zip(texts, encoded(encoder, texts)):
        assert ids == ids_of(text), text


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(files, "REMEMBERED", 50)
    encoder = files.WordEncoder(SPEC, None)
    for n in range(0, 600, 20):
        text = " ".join(f"w{k}" for k in range(n - 30, n + 20))
        assert encoded(encoder, [text]) == [ids_of(text)[:-1]]
        assert len(encoder.new) <= 50 and len(encoder.old) <= 160


def written(spark, docs, **options):
    path = fresh_dir(spark, "tokens")
    files.write_tokens(docs, path, SPEC, end=2, **options)
    return path


def test_edges_and_repeats(spark, docs):
    path = written(spark, docs)
    found = files.id_digests(files.TokenFiles(spark, path).tokens()).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == Counter((d, len(ids_of(t)), digest(ids_of(t))) for d, t in ROWS)
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order)


def test_empty_table(spark, no_docs):
    tokens = files.TokenFiles(spark, written(spark, no_docs))
    assert tokens.documents().collect() == [] and tokens.parts().collect() == [] and tokens.span(0, 10).collect() == []


def test_a_text_of_some_megabytes(spark):
    text = " ".join(f"word{n % 5000} and ÉTÉ{n % 77}," for n in range(200_000)) + " " + "z" * 300_000
    path = written(spark, spark.createDataFrame([(2, text), (1, "a b")], "doc_id int, text string"))
    found = [tuple(r) for r in files.id_digests(files.TokenFiles(spark, path).tokens()).orderBy("start").collect()]
    assert found == placed([(1, "a b"), (2, text)])


def test_a_hot_id_is_spread_over_files(spark, monkeypatch):
    """A third of the rows has one id and one text: they lie in several files, in one order."""
    monkeypatch.setattr(files, "FILE_ROWS", 200)
    rows = [(7 if n % 3 else n, "same text" if n % 3 else f"text {n}") for n in range(2000)]
    path = written(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    tokens = files.TokenFiles(spark, path)
    per_file = [r["n_docs"] for r in tokens.parts().collect()]
    assert len(per_file) >= 8 and max(per_file) < 800
    found = [(r[0], r[2], r[3]) for r in files.id_digests(tokens.tokens()).orderBy("start").collect()]
    assert found == [(d, n, c) for d, _, n, c in placed(sorted(rows, key=lambda r: r[0]))]


@pytest.mark.parametrize("encoding, expected", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_layout_of_the_files(spark, sf_texts, encoding, expected):
    layout = files.Layout(encoding=encoding, group_bytes=100_000, page_bytes=8_000, page_rows=20)
    docs = spark.createDataFrame(sf_texts, "doc_id long, text string")
    path = written(spark, docs, layout=layout)
    (file,) = glob.glob(f"{path}/data/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 1
    for g in range(meta.num_row_groups):
        for c in range(meta.num_columns):
            column = meta.row_group(g).column(c)
            assert column.has_column_index and column.has_offset_index
            wanted = expected if column.path_in_schema.startswith("ids") else "DELTA_BINARY_PACKED"
            assert wanted in column.encodings, (column.path_in_schema, column.encodings)
    assert [tuple(r) for r in files.id_digests(files.TokenFiles(spark, path).tokens()).orderBy("start").collect()] == placed(sorted(sf_texts))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_skip_what_they_do_not_need(spark, sf_texts):
    layout = files.Layout(group_bytes=100_000, page_bytes=8_000, page_rows=10)
    docs = spark.createDataFrame(sf_texts, "doc_id long, text string")
    tokens = files.TokenFiles(spark, written(spark, docs, layout=layout))
    assert "ids:array" not in plan(tokens.documents())
    assert "ids:array" in plan(tokens.tokens())
    some = tokens.where(F.col("doc_id") == 50).tokens()
    assert "EqualTo(doc_id,50)" in plan(some)
    expected = {d: ids_of(t) for d, t in sf_texts}
    assert [(r["doc_id"], r["ids"]) for r in some.collect()] == [(50, expected[50])]
    all_ids = [i for d in sorted(expected) for i in expected[d]]
    for first, last in ((0, 1), (1000, 3000), (len(all_ids) - 5, len(all_ids) + 9), (40, 40)):
        span = tokens.span(first, last).orderBy("start").collect()
        assert [i for r in span for i in r["ids"]] == all_ids[first:last]
        assert all(r["start"] >= first for r in span)
    assert "LessThan(at," in plan(tokens.span(1000, 3000))


def test_query_equals_the_library(spark, sf_dir, sf_texts):
    found = [tuple(r) for r in queries.QUERIES["op13_token_files"](spark, sf_dir).orderBy("start").collect()]
    assert found == placed(sorted(sf_texts))
