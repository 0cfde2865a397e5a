"""Models, tokens, repeats and vectors against libraries, plain versions and held-out rows."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edges import ROWS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from varve.llm import ann, bpe, crf, lm, queries, repeats
from varve.llm.common import remainder, text_of
from varve.llm.repeats import remove_repeats
from varve.llm.tokens import count_tokens, read_merges

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BIG = "/root/testdata/sf0.1"


def rows(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def library(text):
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_digests(pairs):
    tool = library(None)
    out = Counter()
    for d, t in pairs:
        ids = np.array(tool.encode_ordinary(t or ""), "<u4").tobytes()
        out[d, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    return out


def test_bpe_equals_the_library(spark, docs, no_docs, sf_texts, sf_dir):
    ranks = bpe.read_ranks(RANKS)
    assert rows(queries.QUERIES["op4_byte_bpe"](spark, sf_dir)) == bpe_digests(sf_texts)
    assert rows(bpe.encode_digests(docs, ["doc_id"], ranks, public_tokenizers.PATTERN)) == bpe_digests(ROWS)
    assert bpe.encode(no_docs, ["doc_id"], ranks, public_tokenizers.PATTERN).count() == 0
    whole = bpe.encode(docs, ["doc_id", "text"], ranks, public_tokenizers.PATTERN).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() and len(r.ids) == 4 * r.n_tokens for r in whole)


def test_a_merge_of_lower_rank_goes_first():
    ranks = {bytes([n]): 200 + n for n in range(256)} | {b"ab": 50, b"abc": 3, b"cab": 10, b"bc": 60}
    tool = bpe.Codec(ranks, r".+")
    plain = tiktoken.Encoding("own", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcabcab", "ababcabcc", "cabab", "bcabcb" * 9):
        got = np.frombuffer(tool.encode_all([text])[0], "<u4").tolist()
        assert got == plain.encode_ordinary(text), text


def test_rank_queue():
    queue = bpe.RankQueue(100_000)
    queue.put(70_000, [5, 1])
    queue.put(3, [9])
    queue.put(70_000, [2])
    assert [queue.pop(), queue.pop(), queue.pop()] == [(3, [9]), (70_000, [1, 2, 5]), None]


def test_token_counts_equal_the_library(spark, docs, no_docs, sf_texts, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tool = Tokenizer.from_file(path)

    def expected(pairs):
        counts = [len(e.ids) for e in tool.encode_batch([t or "" for _, t in pairs], add_special_tokens=False)]
        return Counter((d, len((t or "").encode()), n, n > 512) for (d, t), n in zip(pairs, counts))

    assert rows(queries.QUERIES["op6_token_counts"](spark, sf_dir)) == expected(sf_texts)
    assert rows(count_tokens(docs, ["doc_id"], read_merges(path))) == expected(ROWS)
    assert count_tokens(no_docs, ["doc_id"], read_merges(path)).count() == 0


def held_out(doc, modulus):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % modulus


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*brute.WORDS.findall(lower), None]


def base_scores(pairs):
    counts = Counter(w for d, t in pairs if held_out(d, 7) != 2 for w in tokens(t))
    total, types = sum(counts.values()), len(counts)
    out = []
    for d, t in pairs:
        found = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in found)
        out.append((d, held_out(d, 7) == 2, len(found), sum(counts[w] > 0 for w in found), total, round(base, 6)))
    return Counter(out)


def lm_rows(df):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return Counter((*[r[n] for n in names], round(r.base_score, 6)) for r in df.collect())


def test_lm_base_scores(spark, docs, no_docs, sf_texts, sf_dir, monkeypatch):
    monkeypatch.setattr(lm, "SENT_WORDS", 300)
    monkeypatch.setattr(lm, "OWN_WORDS", 100)
    assert lm_rows(queries.QUERIES["op3_lm_scores"](spark, sf_dir)) == base_scores(sf_texts)
    edge = lm.score(docs, ["doc_id"], remainder("doc_id", 7) != 2, text_of())
    assert lm_rows(edge) == base_scores(ROWS)
    assert lm.score(no_docs, ["doc_id"], F.lit(True), text_of()).count() == 0
    untaught = lm.score(docs, ["doc_id"], F.lit(False), text_of()).collect()
    assert all(r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in untaught)


def test_lm_beats_the_unigrams_on_held_out_texts(spark):
    found = queries.QUERIES["op3_lm_scores"](spark, BIG).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_lm_learns_alike_from_any_files(spark, monkeypatch):
    """Many small partitions teach as much as one, and a table beyond one round is learned from in several."""
    if hasattr(lm, "ROUND_TOKENS"):
        monkeypatch.setattr(lm, "ROUND_TOKENS", 60_000)
    docs = spark.read.parquet(f"{BIG}/documents.parquet").where("doc_id % 8 = 0").select("doc_id", "text")
    docs = docs.where("text IS NOT NULL")

    def gain(parts):
        found = lm.score(docs.repartition(parts, "doc_id"), ["doc_id"], remainder("doc_id", 7) != 2, text_of())
        return found.where("held_out").agg(F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).first()[0]

    one, many = gain(1), gain(96)
    assert abs(one - many) < 1e-4 and one > 0


def test_lm_is_normalised():
    rng = np.random.default_rng(1)
    model = lm.start_model(np.full(30, 1 / 30))
    model.target += rng.normal(size=model.target.shape).astype(np.float32)
    ids = np.arange(30, dtype=np.int32)
    around = np.tile(np.array([[4, 30]], np.int32), (30, 1))
    assert abs((10 ** lm.log10_probabilities(model, ids, around)).sum() - 1) < 1e-5


def test_quality_on_held_out_rows(spark, no_docs):
    found = queries.QUERIES["op5_line_quality"](spark, BIG)
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    joined = found.where("held_out").join(labels, "doc_id")
    right = joined.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95
    bounds = found.agg(F.min("score"), F.max("score"), F.count("*")).first()
    assert bounds[0] >= 0 and bounds[1] <= 1 and bounds[2] == 10_000
    assert crf.score(no_docs, ["doc_id"], crf.Crf(np.zeros(crf.FEATURES), np.zeros((2, 2)), np.zeros(2))).count() == 0


def test_quality_of_edges(spark, docs):
    labels = docs.select("doc_id", (F.length(text_of()) % 2).cast("int").alias("quality"))
    model = crf.learn(docs, labels)
    found = crf.score(docs, ["doc_id"], model).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    nothing = crf.learn(docs, labels.limit(0))
    assert {r.score for r in crf.score(docs, ["doc_id"], nothing).collect()} == {0.5} or nothing.rate == 0.5


def test_training_sample_is_bounded_and_carries_no_other_texts(spark, monkeypatch):
    """Ids by hash, one text and the least label an id, lines in all and of a text within the bounds."""
    monkeypatch.setattr(crf, "SAMPLE_ROWS", 50)
    monkeypatch.setattr(crf, "SAMPLE_LINES", 300)
    texts = [(n, "line\n" * (n % 7) + f"end {n}") for n in range(400)] + [(5, "other of 5"), (6, None), (None, "x"), (900, "\n" * 31)]
    labels = [(n, n % 2) for n in range(400)] + [(5, 1), (5, 0), (7, None), (None, 1), (900, 1), (901, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    drawn = crf._drawn(frame, "doc_id", "quality").collect()
    ids = spark.createDataFrame([(n,) for n in sorted({d for d, q in labels if d is not None and q is not None})], "id long")
    first = [r["id"] for r in ids.orderBy(F.xxhash64("id"), "id").limit(50).collect()]
    assert [r["id"] for r in drawn] == first and {r["id"]: r["label"] for r in drawn}.get(5, 0) == 0
    found = [(r["label"], r["body"]) for r in crf.training_texts(docs, frame).collect()]
    own, expected, lines = dict((d, t) for d, t in texts[:400]), [], 0
    for n in first:
        size = own[n].count("\n") + 1 if n in own else 31
        if n in own and size <= 30:
            lines += size
            if lines <= 300:
                expected.append(n)
    assert len(found) == len(expected) and sum(t.count("\n") + 1 for _, t in found) <= 300
    assert [label for label, _ in found] == [n % 2 for n in expected]


def test_chain_equals_all_paths():
    rng = np.random.default_rng(2)
    model = crf.Crf(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2))
    sizes = np.array([3, 1, 4])
    scores = rng.normal(size=8)
    marginal, _, total = crf.forward_backward(model, scores, sizes)
    at = 0
    for n, size in enumerate(sizes):
        weights = defaultdict(float)
        for path in np.ndindex(*[2] * size):
            value = model.start[path[0]] + sum(scores[at + k] * s for k, s in enumerate(path))
            value += sum(model.move[a, b] for a, b in zip(path, path[1:]))
            weights[path] = math.exp(value)
        whole = sum(weights.values())
        assert abs(math.log(whole) - total[n]) < 1e-9
        for k in range(size):
            good = sum(w for p, w in weights.items() if p[k]) / whole
            assert abs(good - marginal[at + k, 1]) < 1e-9
        at += size


def removed(pairs, length=400):
    places = Counter(t[i : i + length] for t in (((t or "").encode()) for _, t in pairs) for i in range(len(t) - length + 1))
    out = Counter()
    for d, t in pairs:
        data = (t or "").encode()
        gone = bytearray(len(data))
        end = 0
        for i in range(len(data) - length + 1):
            if places[data[i : i + length]] > 1:
                for k in range(max(i, end), i + length):
                    gone[k] = 1
                end = i + length
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def planted():
    """Passages of near the critical length, cut at all offsets, and periodic texts."""
    rng = np.random.default_rng(3)

    def prose(n):
        return "".join(chr(97 + c) for c in rng.integers(0, 26, n))

    passage = prose(900)
    out = []
    for k, (start, size) in enumerate([(0, 900), (100, 500), (3, 399), (5, 400), (50, 401), (200, 640), (499, 401)]):
        out.append((k, prose(137 + 61 * k) + passage[start : start + size] + prose(90 + 13 * k)))
    out += [(20, "ab" * 500), (21, "x" * 399), (22, "x" * 400), (23, "x" * 401), (24, prose(700) + "é" * 450)]
    twice = prose(450)
    return [*out, (30, twice + prose(20) + twice), (31, twice[30:440]), (32, prose(450))]


def test_repeats(spark, docs, no_docs, sf_texts, sf_dir):
    texts = planted()
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert rows(remove_repeats(df)) == removed(texts)
    few = [(d, t if t is None else t[:9000]) for d, t in ROWS]
    edge = docs.withColumn("text", F.substring("text", 1, 9000))
    assert rows(remove_repeats(edge)) == removed(few)
    assert remove_repeats(no_docs).count() == 0
    assert rows(queries.QUERIES["op8_repeated_strings"](spark, sf_dir)) == removed(sf_texts)


@pytest.mark.parametrize("way", ["broadcast", "split"])
def test_repeats_of_a_hot_core(spark, monkeypatch, way):
    """One core with nearly all samples: its rows are not left to one task, and the result is that of all windows."""
    texts = planted() + [(100 + k, "x" * 3000 + f" {k} " + planted()[k % 7][1]) for k in range(40)]
    plans, write = {}, repeats.materialize

    def recorded(df, name="table"):
        if name == "live":
            df._jdf.queryExecution().toRdd().count()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(repeats, "materialize", recorded)
    if way == "split":
        monkeypatch.setattr(repeats, "broadcast_if_small", lambda df, rows: df, raising=False)
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        df = spark.createDataFrame(texts, "doc_id long, text string").repartition(8)
        assert rows(remove_repeats(df)) == removed(texts)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert ("BroadcastHashJoin" if way == "broadcast" else "skew=true") in plans["live"]


def test_repeats_of_many_copies(spark, monkeypatch):
    """A text's copies are made one in the tasks that read them, before texts are shuffled by their key."""
    texts = planted() + [(100 + k, planted()[0][1]) for k in range(300)] + [(500 + k, "short") for k in range(300)]
    plans, write = {}, repeats.materialize

    def recorded(df, name="table"):
        if name == "bodies":
            df._jdf.queryExecution().toRdd().count()
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(repeats, "materialize", recorded)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert rows(remove_repeats(df)) == removed(texts)
    final = plans["bodies"].split("Initial Plan")[0]
    assert final.index("Join") < final.index("partial_min(body")


def nearest_of(pairs, asked, count=10):
    ids = np.array([i for i, _ in pairs])
    held = np.array([v for _, v in pairs], np.float64)
    out = {}
    for i, v in pairs:
        if asked(i):
            distance = np.sqrt(((held - np.array(v, np.float64)) ** 2).sum(axis=1))
            order = [n for n in np.lexsort((ids, distance)) if ids[n] != i][:count]
            out[i] = [(int(ids[n]), float(distance[n])) for n in order]
    return out


def test_nearest_recall(spark):
    base = spark.read.parquet(f"{BIG}/embeddings.parquet")
    want = nearest_of([(r.vec_id, r.embedding) for r in base.collect()], lambda i: i % 100 == 0)
    got = defaultdict(list)
    for r in queries.QUERIES["op10_nearest_vectors"](spark, BIG).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score, r.rank))
    assert set(got) == set(want) and all([k for _, _, k in v] == [*range(1, 11)] for v in got.values())
    hits = sum(len({i for i, _, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_nearest_bounds_both_sides_of_a_task(spark, monkeypatch):
    """No task gets more than about a shard of vectors and a block of queries, and no pair is missed."""
    monkeypatch.setattr(ann, "SHARD_ROWS", 200)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    meetings, dealt = ann._meetings, []
    monkeypatch.setattr(ann, "_meetings", lambda *a: dealt.append(meetings(*a)) or dealt[-1])
    rng = np.random.default_rng(4)
    pairs = [(n, [float(x) for x in v]) for n, v in enumerate(rng.normal(size=(1000, 8)))]
    df = spark.createDataFrame(pairs, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 2 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = nearest_of(pairs, lambda i: i % 2 == 0)
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.99 * 10 * len(want)
    sizes = [{(r.shard, r.block): r["count"] for r in side.groupBy("shard", "block").count().collect()} for side in dealt[0]]
    assert sizes[0].keys() == sizes[1].keys() and len(sizes[0]) == 5 * 10
    assert max(sizes[0].values()) < 2 * 200 and max(sizes[1].values()) < 2 * 50


def far_and_near_vectors(kind, dim, count, rng):
    """Rows with ties and copies, far from zero, or with squares beyond or below what a double holds."""
    some = rng.normal(size=(count, dim))
    if kind == "ties":
        return rng.integers(-1, 2, size=(count, dim)).astype(float)
    if kind == "copies":
        return np.repeat(some[: count // 8], 8, axis=0)
    if kind == "far":
        return some * 1e-3 + 1e8
    if kind == "huge and tiny":
        return some * 10.0 ** rng.integers(-160, 160, size=(count, 1))
    return some * 10.0 ** rng.uniform(-162, -150)


def plain_within(codes, query, enough):
    """Rows within the least radius of the steps that holds enough, by comparing all."""
    bits = np.unpackbits(codes ^ query, axis=1).sum(axis=1)
    for step in range(8):
        rows = np.flatnonzero(bits <= codes.shape[1] * (step + 1) - 1)
        if len(rows) >= min(enough, len(codes)):
            return rows
    return np.arange(len(codes))


@pytest.mark.parametrize("dim, count", [(8, 1), (8, 300), (24, 300), (64, 700)])
def test_search_probes_each_substring_once(monkeypatch, dim, count):
    """A step probes for what no step before it did, and finds all that is within its radius."""
    rng = np.random.default_rng(dim)
    codes = np.packbits(rng.integers(0, 2, size=(count, dim), dtype=np.uint8), axis=1)
    codes[: count // 3] = codes[0]
    index, probed = ann.MultiIndex(codes), []
    probe = index.probe
    monkeypatch.setattr(index, "probe", lambda query, flips: probed.append(flips) or probe(query, flips))
    for query in [*codes[:: max(1, count // 7)], ~codes[0]]:
        for enough in (1, 40, 400):
            probed.clear()
            assert index.search(query, enough).tolist() == plain_within(codes, query, enough).tolist()
            assert probed == list(range(len(probed)))
        assert sorted(np.concatenate([probe(query, k) for k in range(9)]).tolist()) == sorted([*range(count)] * (dim // 8))


@pytest.mark.parametrize("kind", ["ties", "copies", "far", "huge and tiny", "tiny"])
def test_nearest_by_products_equals_all_distances(monkeypatch, kind):
    rng = np.random.default_rng(7)
    monkeypatch.setattr(ann, "ENOUGH", 100)
    vectors = far_and_near_vectors(kind, 16, 400, rng)
    ids = rng.integers(0, 300, size=len(vectors))
    codes = ann.learn_codes(rng.normal(size=(50, 16)), 16)
    index = ann.MultiIndex(codes.encode(vectors))
    got = ann._best(ids[:20], vectors[:20], ids, vectors, index, codes, 10)
    want = []
    with np.errstate(all="ignore"):
        for own, vector, code in zip(ids[:20].tolist(), vectors[:20], codes.encode(vectors[:20])):
            rows = plain_within(index.columns.T, code, 100)
            rows = rows[ids[rows] != own]
            distance = np.sqrt(((vectors[rows] - vector) ** 2).sum(axis=1))
            want += [(own, ids[rows[n]], distance[n]) for n in np.lexsort((ids[rows], distance))[:10]]
    assert list(zip(*got)) == want


def test_few_of_what_is_retrieved_are_compared_exactly():
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3000, 32))
    squares = (vectors**2).sum(axis=1)
    for vector in vectors[:20]:
        kept = ann._may_be_nearest(np.arange(1, 3000, 2), vectors, squares, vector, 10)
        distance = ((vectors[1::2] - vector) ** 2).sum(axis=1)
        assert set(1 + 2 * np.argsort(distance)[:10]) <= set(kept) and len(kept) <= 11


@pytest.mark.parametrize("ids", ["all different", "some twice", "one for most rows", "one null"])
def test_sample_is_the_rows_of_least_hash(spark, monkeypatch, ids):
    """And few more rows than the sample has are sorted for it, whatever the number of all."""
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 300)
    of = {"all different": lambda n: n, "some twice": lambda n: n // 2, "one for most rows": lambda n: max(n, 3900), "one null": lambda n: n or None}[ids]
    # Rows of one id are alike, so that the sample does not hang on which of them are taken.
    pairs = [(of(n), [float(of(n) or 0), 1.0]) for n in range(4000)]
    base = spark.createDataFrame(pairs, "id long, v array<double>")
    want = base.orderBy(F.xxhash64("id"), "id").limit(300).collect()
    assert ann._sample(base, 4000).tolist() == [r.v for r in want]
    assert ann._sample(base.limit(100), 100).shape == (100, 2)
    if ids == "all different":
        assert 300 <= ann._likely_sample(base, 4000).count() < 400


def test_nearest_of_edges(spark):
    nan = float("nan")
    vectors = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [None, 1.0]),
               (7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (200, [0.0, 1.0]), (None, [1.0, 1.0]), (9, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    assert [(q, k, i) for q, k, i, _ in got] == [(100, 1, 1), (100, 2, 2), (100, 3, 200), (200, 1, 1), (200, 2, 2), (200, 3, 100)]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_pipeline(spark, sf_texts, sf_dir, docs):
    """The first stages and the last one against their plain versions; the mix has SQL of its own."""
    from varve.llm.rules import measure

    good = [(d, t) for d, t in sf_texts if measure([t or ""])[6][0]]
    classes = brute.near_duplicates(good)
    one = {d: t for (d, t), (_, root, _, _) in zip(good, classes) if d == root}
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    first = stages[0](spark, table, sf_dir)
    assert {r.doc_id for r in first.collect()} == {d for d, _ in good} and first.columns == table.columns
    second = stages[1](spark, first, sf_dir)
    assert {r.doc_id: r.text for r in second.collect()} == one and second.columns == table.columns
    third = stages[2](spark, second, sf_dir)
    clean = {r.doc_id: r.text for r in third.collect()}
    assert clean.keys() == one.keys() and all(brute.secrets(t)[:3] == (0, 0, 0) for t in clean.values())
    assert all(clean[d] == t for d, t in one.items() if brute.secrets(t)[:3] == (0, 0, 0))
    last = corpus_pipeline.run(spark, sf_dir).collect()
    tool = library(None)
    assert last and all(np.frombuffer(r.ids, "<u4").tolist() == tool.encode_ordinary(clean[r.doc_id]) for r in last)
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, sf_dir)
        assert frame.count() >= 0, name


def test_stages_of_an_empty_table(spark, sf_dir, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, no_docs, sf_dir)
        assert made.collect() == [], name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == no_docs.columns, name


def test_stages_of_a_text_of_some_megabytes(spark, sf_dir):
    """A long text with a secret and its near copy: one stays, whole but for the secret, and round-trips."""
    words = " ".join(f"word{n * 7919 % 999_983}" for n in range(250_000))
    rows = [(1, words + " password = hunter2hunter2hunter2 end", "en", "src1", None), (2, words + " end", "en", "src1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
    (kept,) = docs.collect()
    assert kept["doc_id"] == 1 and kept["text"].startswith(words) and "hunter2" not in kept["text"] and kept["text"].endswith("end")
    (ids,) = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).collect()
    assert ids["decoded_sha256"] == hashlib.sha256(kept["text"].encode()).hexdigest()
