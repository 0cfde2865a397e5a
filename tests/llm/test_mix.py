"""The source mix against SQL, its budgets against a plain version."""

from __future__ import annotations

from compare import assert_equal, connect
from pyspark.sql import functions as F

from varve.llm import queries
from varve.llm.mixing import MIX_WEIGHTS, budgets, domain_of, mix


def test_mix_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert assert_equal(queries.QUERIES["op2_source_mix"](spark, folder), queries.SQL["op2_source_mix"], connect(folder)) > 0


def plain(tree, budget, epochs):
    """Deal a budget to the children of a node: fill the full ones, share the rest anew."""
    if not isinstance(tree, dict):
        return budget

    def room(node):
        return sum(map(room, node.values())) if isinstance(node, dict) else node * epochs

    left, open_children, out = budget, dict(tree), {}
    while open_children:
        part = left / len(open_children)
        full = {k for k, v in open_children.items() if room(v) <= part}
        if not full:
            break
        for k in full:
            out[k] = room(open_children.pop(k))
            left -= out[k]
    for k in open_children:
        out[k] = left // len(open_children)
    return {k: plain(v, out[k], epochs) for k, v in tree.items()}


def test_shortage_goes_to_siblings_first(spark):
    tree = {"a": {"x": {"s": 10, "t": 1000}, "y": {"u": 400}}, "b": {"x": {"v": 50}, "z": {"w": 3000, "r": 7}}}
    leaves = [(0, d, la, s, n) for d, x in tree.items() for la, y in x.items() for s, n in y.items()]
    df = spark.createDataFrame(leaves, "all int, domain string, lang string, source string, tokens long")
    want = plain(tree, int(sum(x[-1] for x in leaves) * 0.5), 2)
    got = {(r.domain, r.lang, r.source): r.quota for r in budgets(df, 0.5, {}, 2).collect()}
    assert got == {(d, la, s): want[d][la][s] for _, d, la, s, _ in leaves}


def test_mix_of_edges(spark, docs, no_docs):
    found = mix(docs, 0.9, MIX_WEIGHTS, domain=domain_of(), out=("t", "c"))
    assert found.columns == [*docs.columns, "t", "c"]
    total = docs.select(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).alias("n")).agg(F.sum("n")).first()[0]
    assert found.agg(F.sum(F.col("t") * F.col("c"))).first()[0] <= 0.9 * total
    assert found.where("c < 1 OR c > 2").count() == 0
    assert mix(no_docs, 0.9, {}, domain=domain_of(), out=("t", "c")).count() == 0
    whole = mix(docs, 2.0, {}, domain=domain_of(), out=("t", "c"))
    assert whole.count() == docs.count() and whole.where("c <> 2").count() == 0
