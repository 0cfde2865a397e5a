"""Vector codes and centroids against plain versions, SQL, and tables with every kind of row."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from compare import assert_equal, connect

from varve.llm import centroids, lloyd, queries, vectors

MID = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int, __id int, entry string, position int, code string, part int, salt int, ints string"


def plain_rows(rows, dims):
    return [(i, v, lab) for i, v, lab in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def nearest(x, book):
    found = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
    return found.index(min(found)), min(found)


def lloyd_rounds(xs, book, rounds):
    for _ in range(rounds):
        held = {}
        for x in xs:
            held.setdefault(nearest(x, book)[0], []).append(x)
        book = [[sum(c) // len(held[n]) for c in zip(*held[n])] if n in held else c for n, c in enumerate(book)]
    return book


def plain_codes(rows, dims, parts, entries, rounds, scale):
    width = dims // parts
    kept = by_id([(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in plain_rows(rows, dims)])
    books = []
    for p in range(parts):
        xs = [v[p * width : (p + 1) * width] for _, v, _ in kept]
        books.append(lloyd_rounds(xs, xs[:entries], rounds))
    out, errors = [], Counter()
    for i, v, lab in kept:
        found = [nearest(v[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab))
        errors[lab] += out[-1][2]
    return Counter((i, code, error, errors[lab]) for i, code, error, lab in out), ",".join(str(c) for b in books for e in b for c in e)


def plain_clusters(rows, dims, count, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in plain_rows(rows, dims)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    book = lloyd_rounds([v for _, v in kept], [v for _, v in first[:count]], rounds)
    found = [(i, *nearest(v, book)) for i, v in kept]
    sums = Counter()
    for _, k, d in found:
        sums[k] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in book]
    return Counter((i, k, d, sums[k], sum(sums.values()), digests[k]) for i, k, d in found)


def table(spark, rows):
    extra = (3, "e", 5, "c", 1, 2, "i")
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)


def odd_rows(dims, seed=5):
    """Skewed, repeated, tied, null and broken rows."""
    rng = random.Random(seed)

    def some():
        return [round(rng.uniform(-2, 2), 2) for _ in range(dims)]

    common = some()
    rows = [(n, some(), rng.choice([None, 1, 2])) for n in range(60)] + [(100 + n, common, 7) for n in range(40)]
    rows += [(5, some(), None), (5, common, None), (None, some(), 1), (None, common, None), (-9, [0.0] * dims, 3), (-8, [-1e-9] * dims, 3)]
    rows += [(n, [float(x)] * dims, 4) for n, x in ((300, 1), (301, -1), (302, 3))]
    rows += [(400, None, 1), (401, [None] * dims, 1), (402, [math.nan] + [0.0] * (dims - 1), 1), (403, [math.inf] * dims, 2)]
    rows += [(404, [], None), (405, [1.0] * (dims - 1), None), (406, [1.0] * (dims + 4), None)]
    return rows


@pytest.mark.parametrize("entries, rounds, owner", [(16, 4, 100_000), (5, 2, 30), (256, 4, 50), (1, 1, 100_000), (4, 0, 100_000)])
def test_codes_equal_a_plain_version(spark, monkeypatch, entries, rounds, owner):
    monkeypatch.setattr(lloyd, "OWNER_ROWS", owner)
    rows = odd_rows(8)
    coded, books = lloyd.compress(table(spark, rows), dims=8, parts=4, entries=entries, rounds=rounds)
    expected, text = plain_codes(rows, 8, 4, entries, rounds, 1024)
    assert coded.columns == ["vec_id", "code", "error", "label_error"]
    assert Counter(tuple(r) for r in coded.collect()) == expected
    assert books.text() == text


def test_only_parts_that_change_entry_are_shuffled(spark, monkeypatch):
    """The arrivals written in a round are those whose nearest entry is another one, far fewer than all."""
    rng = np.random.default_rng(3)
    values = rng.normal(size=(3000, 8)) + rng.integers(0, 9, size=(3000, 1))
    rows = [(n, v.tolist(), 1) for n, v in enumerate(values)]
    seen = []
    was = lloyd.staged

    def watched(df, name, *parted):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((name, "REPARTITION_BY_NUM" in plan))
        return was(df, name, *parted)

    monkeypatch.setattr(lloyd, "staged", watched)
    _, books = lloyd.compress(table(spark, rows), dims=8, entries=32, rounds=4)
    assert seen == [("members", True)] + [("members", False), ("arrivals", True)] * 3
    ints = [[math.floor(1024 * x) for x in v] for _, v, _ in rows]
    for n, moved in enumerate(books.moved):
        changed = 0
        for p in range(4):
            xs = np.array([v[2 * p : 2 * p + 2] for v in ints])
            before = lloyd_np(xs, xs[:32], n)
            changed += int((assign_np(xs, before) != assign_np(xs, lloyd_np(xs, xs[:32], n + 1))).sum())
        assert moved == changed
    assert books.moved[-1] < books.moved[0] < 4 * len(rows) // 2


def assign_np(xs, book):
    return ((xs[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)


def lloyd_np(xs, book, rounds):
    for _ in range(rounds):
        a = assign_np(xs, book)
        book = np.array([xs[a == k].sum(axis=0) // (a == k).sum() if (a == k).any() else book[k] for k in range(len(book))])
    return book


def test_hot_entries_have_several_owners(spark, monkeypatch):
    """A third of all rows is one vector: its members are dealt to owners of bounded size."""
    monkeypatch.setattr(lloyd, "OWNER_ROWS", 100)
    rows = [(n, [0.25] * 8 if n % 3 == 0 else [(n * k % 97) / 9.0 for k in range(1, 9)], 1) for n in range(3000)]
    ints, path, count, _ = vectors.staged_integers(table(spark, rows), {"__id": queries.F.col("vec_id")}, "embedding", 1024, 8)
    books = lloyd.learn_codebooks(ints, count, "__id", dims=8, rounds=0)
    salts = -(-count // 100)
    owned = lloyd._members(ints, books.entries, salts).groupBy("position", "entry", "salt").count()
    assert owned.agg(queries.F.max("count")).first()[0] <= 100


def test_codes_decode_to_their_entries(spark):
    rows = plain_rows(odd_rows(8), 8)
    coded, books = lloyd.compress(table(spark, rows), dims=8, parts=2, entries=16)
    for r in lloyd.decode(coded, books).collect():
        expected = [c for p in range(2) for c in books.entries[p][int(r["code"][2 * p : 2 * p + 2], 16)].tolist()]
        assert r["ints"] == expected


def test_large_components_are_exact_or_refused(spark):
    rng = random.Random(1)
    rows = [(n, [rng.uniform(-40_000, 40_000) for _ in range(8)], 1) for n in range(50)]
    coded, _ = lloyd.compress(table(spark, rows), dims=8, entries=4, rounds=2)
    assert Counter(tuple(r) for r in coded.collect()) == plain_codes(rows, 8, 4, 4, 2, 1024)[0]
    for function in (lloyd.compress, centroids.cluster):
        with pytest.raises(ValueError, match="exact"):
            function(table(spark, [(1, [1e300] * 8, 1)]), dims=8)


@pytest.mark.parametrize("count, rounds", [(16, 3), (3, 5), (1, 1), (200, 2), (4, 0)])
def test_clusters_equal_a_plain_version(spark, count, rounds):
    rows = odd_rows(8)
    found, made = centroids.cluster(table(spark, rows), dims=8, clusters=count, rounds=rounds)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == plain_clusters(rows, 8, count, rounds, 64)
    assert sum(made.members) == len(plain_rows(rows, 8)) and len(made.changed) <= rounds


def test_products_are_updated_by_changed_components(spark, monkeypatch):
    """After the first round only components in which a centroid changed are multiplied."""
    calls = []
    monkeypatch.setattr(centroids, "products", lambda a, b: calls.append(b.shape) or vectors.products(a, b))
    ints = np.array([[1, 2, 3], [4, 5, 6]])
    before, after = np.array([[1, 0, 2], [7, 7, 7]]), np.array([[1, 0, 5], [7, 7, 7]])
    batch = vectors.pa.RecordBatch.from_arrays([vectors.pa.array([1, 2]), vectors.lists(ints), vectors.lists(ints @ before.T)], names=["__id", "ints", "dots"])

    class Frame:
        schema = spark.createDataFrame([], "__id long").schema

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return next(run([batch]))

    made = centroids._state(Frame(), ["__id"], after, before)
    assert calls == [(1, 1)]
    assert vectors.matrix(made.column(2), 2).tolist() == (ints @ after.T).tolist()


def test_empty_and_unfit_tables(spark):
    for rows in ([], [(1, None, 1), (2, [1.0], None)]):
        coded, books = lloyd.compress(table(spark, rows))
        assert coded.count() == 0 and books.text() == ""
        assert centroids.cluster(table(spark, rows))[0].count() == 0


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_centroids"])
def test_vector_queries_match_their_sql(spark, name):
    assert assert_equal(queries.QUERIES[name](spark, MID), queries.SQL[name], connect(MID)) == 500
