"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

import re
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import WORD, chunks, spare, text_of
from varve.llm.links import components
from varve.session import materialize

WORDS = 5
THRESHOLD = 0.8
# 28 bands of 5 values: a pair at the threshold shares a band but for a chance of 2e-5.
BANDS, ROWS = 28, 5
HASHES = BANDS * ROWS
# A pair is dropped when its chance of reaching the threshold falls below this.
TOLERANCE = 1e-4
# Values compared in each step of the pruning.
STEP = 20
# Texts of one bucket, and shingles of these, that meet in one task.
BLOCK, BLOCK_ITEMS = 1000, 2_000_000
# Shingles of a text's partners that are compared with it at once, unless one partner alone has more.
TOGETHER = 1 << 18

_words = re.compile(WORD).findall
_random = np.random.default_rng(20_240_201)
_FACTORS = _random.integers(1, 1 << 32, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(word: str, memory: dict[str, int]) -> int:
    from xxhash import xxh3_64_intdigest

    if len(memory) > 200_000:
        memory.clear()
    made = memory[word] = xxh3_64_intdigest(word.encode())
    return made


_memory: dict[str, int] = {}


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit fingerprints of a text's distinct windows of five words.

    A text of one to four words has one shingle, all its words; a text without words has none.
    """
    found = _words(text)
    if not found:
        return np.zeros(0, np.uint64)
    known = _memory
    hashes = np.array([known.get(w) or _word_hash(w, known) for w in found], np.uint64)
    width = min(WORDS, len(found))
    rolled = np.zeros(len(found) - width + 1, np.uint64)
    for k in range(width):
        rolled = _mixed(rolled + hashes[k : k + len(rolled)] + np.uint64(k + 1))
    return np.unique(rolled)


def signature(items: np.ndarray) -> np.ndarray:
    """MinHash values: the least of each hash function over the set, 32 bits each."""
    best = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(items), 4096):
        part = items[start : start + 4096]
        hashed = (part[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]) >> np.uint64(32)
        best = np.minimum(best, hashed.min(axis=1))
    return best.astype(np.uint32)


def fingerprint(items: np.ndarray) -> int:
    """One 64-bit name for a set: equal sets, equal names."""
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(items.tobytes())).view(np.int64))


@cache
def least_matches(compared: int) -> int:
    """Matches among ``compared`` values below which a pair is dropped.

    With a uniform prior, the similarity after m matches of n follows Beta(m + 1, n - m + 1), and
    the chance that it is at least t is the binomial sum below.
    """
    for matches in range(compared + 1):
        n = compared + 1
        chance = sum(comb(n, j) * THRESHOLD**j * (1 - THRESHOLD) ** (n - j) for j in range(matches + 1))
        if chance >= TOLERANCE:
            return matches
    return compared


def _signed(docs: DataFrame) -> DataFrame:
    """(key, node, items, sig) of each text that has words; ``key`` is a 64-bit hash of the text, ``items`` the size of its set."""

    def run(batches):
        for piece, texts in chunks(batches, "body"):
            keys, nodes, counts, sigs = [], [], [], []
            for key, text in zip(piece.column(0).to_pylist(), texts):
                items = shingles(text)
                if len(items):
                    keys.append(key)
                    nodes.append(fingerprint(items))
                    counts.append(len(items))
                    sigs.append(signature(items).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(nodes, pa.int64()), pa.array(counts, pa.int32()), pa.array(sigs, pa.binary())],
                names=["key", "node", "items", "sig"],
            )

    return docs.mapInArrow(run, "key long, node long, items int, sig binary")


def _banded(signed: DataFrame) -> DataFrame:
    """(bucket, band, node, items): the bucket of each band of a signature; ``items`` is the size of the set."""

    def run(batches):
        bands = np.arange(BANDS, dtype=np.int32)
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
            buckets = np.zeros(sigs.shape[:2], np.uint64)
            for k in range(ROWS):
                buckets = _mixed(buckets + sigs[:, :, k] + np.uint64(1))
            buckets = _mixed(buckets + bands.astype(np.uint64)[None, :])
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            items = np.repeat(batch.column(1).to_numpy(), BANDS)
            made = [pa.array(buckets.reshape(-1).view(np.int64)), pa.array(np.tile(bands, len(sigs))), pa.array(nodes), pa.array(items)]
            yield pa.RecordBatch.from_arrays(made, names=["bucket", "band", "node", "items"])

    return signed.select("node", "items", "sig").mapInArrow(run, "bucket long, band int, node long, items int")


def prune(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Rows of ``others``, signatures, that stay candidates for ``one`` through all steps of the pruning."""
    alive = np.arange(len(others))
    matches = np.zeros(len(alive), np.int64)
    for at in range(0, HASHES, STEP):
        if not len(alive):
            break
        stop = min(at + STEP, HASHES)
        matches += (others[alive, at:stop] == one[at:stop]).sum(axis=1)
        fit = matches >= least_matches(stop)
        alive, matches = alive[fit], matches[fit]
    return alive


def _first_shared(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The first band that a signature shares with each of the others; ``BANDS`` if none."""
    same = (others.reshape(-1, BANDS, ROWS) == one.reshape(BANDS, ROWS)).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), BANDS)


def _survivors(table: pa.Table):
    """(row, rows): each row of a group with those it makes surviving pairs with, in the first band they share.

    One row meets the others at a time, so memory stays near one block, however many pairs survive.
    """
    side = table.column("side").to_numpy()
    band = table.column("band")[0].as_py()
    sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
    alone = bool((side == 2).all())
    left = np.flatnonzero(side != 1)
    right = left if alone else np.flatnonzero(side == 1)
    held = sigs[right]
    for n, row in enumerate(left):
        after = n + 1 if alone else 0
        rest = held[after:]
        alive = prune(sigs[row], rest)
        if len(alive):
            alive = alive[_first_shared(sigs[row], rest[alive]) == band]
        if len(alive):
            yield int(row), right[after + alive]


def _by_group(body):
    """A function of Arrow batches that runs ``body`` on each group of rows that lie together.

    Groups are (bucket, lo, hi); what is held at a time is one group and one batch.
    """

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            if not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in KEYS])
            starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            for i, j in zip(starts, starts[1:]):
                yield from body(table.slice(i, j - i))
            held = table.slice(starts[-1])
        if held is not None:
            yield from body(held)

    return run


KEYS = ["bucket", "lo", "hi"]
GROUP = "bucket long, lo int, hi int, band int, side int, node long"
FOUND = "a long, b long, n long"


def _hopeful(table: pa.Table):
    """The rows of a group that are in a surviving pair."""
    held = np.zeros(table.num_rows, bool)
    for row, others in _survivors(table):
        held[row] = True
        held[others] = True
    if held.any():
        yield table.select([*KEYS, "band", "side", "node"]).filter(pa.array(held)).combine_chunks().to_batches()[0]


def _linked(table: pa.Table):
    """Verified links of a group: (a, null, n), n links of set a, and (a, b, null), links that span it.

    A group gives no more rows than it has, however many of its pairs are links. The whole sets of
    one row and of ``TOGETHER`` shingles of its partners are compared at a time.
    """
    sets = [np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()]
    sizes = np.array([len(x) for x in sets], np.int64)
    nodes = table.column("node").to_numpy()
    degree = np.zeros(len(sets), np.int64)
    parent = list(range(len(sets)))

    def root(n):
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    tree = []
    for row, others in _survivors(table):
        for some in np.split(others, np.flatnonzero(np.diff(np.cumsum(sizes[others]) // TOGETHER)) + 1):
            flat = np.concatenate([sets[o] for o in some])
            place = np.minimum(np.searchsorted(sets[row], flat), sizes[row] - 1)
            ends = np.cumsum(sizes[some]) - sizes[some]
            both = np.add.reduceat((sets[row][place] == flat).astype(np.int64), ends)
            fits = some[10 * both >= round(10 * THRESHOLD) * (sizes[row] + sizes[some] - both)]
            degree[row] += len(fits)
            degree[fits] += 1
            for other in fits.tolist():
                x, y = root(row), root(other)
                if x != y:
                    parent[x] = y
                    tree.append((row, other))
    held = np.flatnonzero(degree)
    if not len(held):
        return
    tied = np.array(tree)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([nodes[held], nodes[tied[:, 0]]])),
            pa.array([None] * len(held) + nodes[tied[:, 1]].tolist(), pa.int64()),
            pa.array(degree[held].tolist() + [None] * len(tied), pa.int64()),
        ],
        names=["a", "b", "n"],
    )


def _crowds(banded: DataFrame) -> DataFrame:
    """(bucket, band, size, blocks) of the buckets in which pairs can be new.

    A bucket of two sets or more whose members are just those of a bucket of an earlier band holds no
    pair that meets there first, so only the first of such buckets stays. Members are told by their
    number, their shingles and two 64-bit combinations of their names.
    """
    full = banded.groupBy("bucket", "band").agg(
        F.count("*").alias("size"),
        F.sum("items").alias("items"),
        F.bit_xor("node").alias("one"),
        F.bit_xor(F.xxhash64("node")).alias("two"),
    )
    full = full.where("size > 1")
    first = full.groupBy("size", "items", "one", "two").agg(F.min(F.struct("band", "bucket")).alias("least"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("items") / BLOCK_ITEMS)).cast("int")
    return first.select("least.bucket", "least.band", "size", blocks.alias("blocks"))


def meetings(signed: DataFrame) -> DataFrame:
    """(bucket, lo, hi, band, side, node): the sets that meet others with a chance, by group.

    A bucket of up to ``BLOCK`` sets and ``BLOCK_ITEMS`` shingles is one group. A larger one is cut into
    blocks by a hash, and every two blocks meet in a group of their own, so no group is unbounded and
    no pair is left out. A pair counts in the first band it shares, so most groups of near copies end
    up empty.
    """
    rows = _banded(signed)
    members = rows.select("bucket", "node").join(_crowds(rows), "bucket")
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")
    dealt = members.withColumn("own", own)
    # A member of block i is the left side of (i, j) for j > i, the right of (j, i) for j < i, and both of (i, i).
    dealt = dealt.select("bucket", "band", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") < F.col("other"), 0).when(F.col("own") > F.col("other"), 1).otherwise(2)
    dealt = dealt.select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "band", side.alias("side"), "node")
    together = dealt.join(signed.select("node", "sig"), "node").repartition(*KEYS).sortWithinPartitions(*KEYS)
    return together.mapInArrow(_by_group(_hopeful), GROUP)


def _sets(texts: DataFrame) -> DataFrame:
    """(node, items): the shingle set of each text, as sorted 64-bit numbers."""

    def run(batches):
        for piece, bodies in chunks(batches, "body"):
            items = [shingles(t).tobytes() for t in bodies]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(items, pa.binary())], names=["node", "items"])

    return texts.mapInArrow(run, "node long, items binary")


def jaccard_links(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (key, node), degrees (node, n_links) and ties (a, b) of the verified links.

    ``key`` is xxhash64 of the text. A node stands for all texts with one shingle set, so copies
    are one node and make no pairs; texts without words have none. Every link is verified on the
    whole sets and counted; of a group's links only so many are listed as tie it together, so a
    large group of near copies makes no list of all its pairs.
    """
    texts = docs.select(F.xxhash64(text_of(text)).alias("key"), text_of(text).alias("body"))
    signed = materialize(_signed(texts), "signed")
    nodes = signed.groupBy("node").agg(F.min("key").alias("key"), F.min("items").alias("items"), F.min("sig").alias("sig"))
    nodes = materialize(nodes, "nodes")
    hopeful = materialize(meetings(nodes.select("node", "items", "sig")), "hopeful")
    chosen = nodes.select("node", "key").join(hopeful.select("node").distinct(), "node")
    # Equal texts share a key: one of them gives the set.
    found = texts.join(chosen, "key").select("node", "body")
    sets = materialize(_sets(found).groupBy("node").agg(F.min("items").alias("items")), "sets")
    full = hopeful.join(nodes.select("node", "sig"), "node").join(sets, "node")
    together = full.repartition(*KEYS).sortWithinPartitions(*KEYS)
    facts = materialize(together.mapInArrow(_by_group(_linked), FOUND), "facts")
    degrees = facts.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n_links"))
    return signed.select("key", "node").distinct(), degrees, facts.where("b IS NOT NULL").select("a", "b")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``class_id``, ``copy_id`` and ``n_links``.

    Documents are linked when the sets of their windows of five words have a Jaccard similarity
    of 0.8 or more. ``class_id`` is the least id of all documents joined by links, ``copy_id``
    the least of those with the same set, ``n_links`` the number of other sets that the
    document's set is linked with.

    A text of one to four words is one shingle. Null, empty and blank texts are linked with
    nothing: their own id is class and copy. A null id gives a null there unless another document
    of the group has one. Repeated rows come back as often as they are there. Other columns are
    ignored, whatever their names. An empty table gives none.
    """
    nodes, degrees, ties = jaccard_links(docs, text)
    known = nodes.join(components(ties).join(degrees, "node"), "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    known = materialize(known, "known")
    ids = docs.select(F.col(f"`{id_column}`").alias("id"), F.xxhash64(text_of(text)).alias("key"))
    first = ids.groupBy("key").agg(F.min("id").alias("id")).join(known, "key")
    copies = first.groupBy("node").agg(F.min("id").alias("copy_id"))
    classes = first.groupBy("root").agg(F.min("id").alias("class_id"))
    by_key = known.join(copies, "node").join(classes, "root").select("key", "class_id", "copy_id", "n_links")
    return ids.join(by_key, "key", "left").select(
        F.col("id").alias(id_column),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near duplicates, of least id, then text hash.

    Documents without words all stay. Among repeated rows with the least id one stays.
    """
    key, picked = spare(docs, "__key", "__picked")
    nodes, _, ties = jaccard_links(docs, text)
    groups = nodes.join(components(ties), "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    own = F.col(f"`{id_column}`")
    ids = docs.select(own.alias("id"), F.xxhash64(text_of(text)).alias("key"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    best = ids.join(groups, "key").groupBy("root").agg(F.min(order).alias("best"))
    best = best.select(F.col("best.key").alias(key), F.col("best.id").alias(picked))
    worded = docs.where(F.regexp_like(text_of(text), F.lit(WORD))).withColumn(key, F.xxhash64(text_of(text)))
    one = worded.join(best, (worded[key] == best[key]) & own.eqNullSafe(best[picked]), "left_semi")
    one = one.dropDuplicates([key, id_column])
    blank = docs.where(~F.regexp_like(text_of(text), F.lit(WORD)))
    return one.select(*[f"`{c}`" for c in docs.columns]).union(blank)
