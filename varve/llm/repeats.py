"""Removal of long repeated byte strings, by sampled suffixes, their names and the suffixes between."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import chunks, text_of
from varve.session import broadcast_if_small, materialize, materialize_counted

# Length of the repeated strings, in bytes.
LENGTH = 400
# A sample lies in every stretch of so many bytes, chosen by the content around it.
SPREAD = 128
# Bytes that the choice of a sample looks at.
GRAM = 16

_rng = np.random.default_rng(20_240_204)
_TABLE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1
# Starts of one part of a sample's range.
PART = 32
# Bytes whose prefix sums are held at once.
WINDOW = 1 << 21


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count - 1), modulo 2**64, by doubling."""
    out = np.ones(count, np.uint64)
    done, step = 1, base
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done += more
        step = step * step & _MASK
    return out


_held: dict[str, np.ndarray] = {}


def _tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers up to ``count`` places; a worker keeps those of the common size only."""
    if count > WINDOW + 1:
        return _powers(_BASE, count), _powers(_UNBASE, count)
    if not _held:
        _held["up"], _held["down"] = _powers(_BASE, WINDOW + 1), _powers(_UNBASE, WINDOW + 1)
    return _held["up"][:count], _held["down"][:count]


class Prints:
    """Fingerprints of any stretch of a byte string: a polynomial hash from prefix sums."""

    def __init__(self, raw: np.ndarray):
        up, self.down = _tables(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_TABLE[raw] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return _mixed(value + np.asarray(end - start).astype(np.uint64))


def samples(prints: Prints, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, first, last): the samples of a string and the starts that each one stands for.

    Start i has the sample of least gram among i .. i + SPREAD - 1, the rightmost if equal. So
    equal strings of LENGTH bytes have their sample at the same offset. The starts of a sample
    are a range without gaps, from ``first`` to ``last``.
    """
    starts = n - LENGTH + 1
    if starts <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    places = np.arange(starts + SPREAD - 1)
    value = prints.of(places, places + GRAM)
    # The least of each window of SPREAD: the least so far in blocks, from both sides. The low bits
    # hold the place in the block, so that the rightmost of equal values is the least.
    blocks = -(-len(value) // SPREAD)
    padded = np.full(blocks * SPREAD, np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64(SPREAD - 1)
    padded[: len(value)] = (value & ~low) | (low - (places % SPREAD).astype(np.uint64))
    grid = padded.reshape(blocks, SPREAD)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:starts]
    behind = np.minimum.accumulate(grid, axis=1).reshape(-1)[SPREAD - 1 : SPREAD - 1 + starts]
    later = (behind & ~low) <= (ahead & ~low)
    block = np.where(later, places[SPREAD - 1 :], places[:starts]) // SPREAD
    at = block * SPREAD + (low - (np.where(later, behind, ahead) & low)).astype(np.int64)
    edges = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at[edges], edges, np.append(edges[1:], starts) - 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


CORE = LENGTH - SPREAD + 1


def _sampled(docs: DataFrame) -> DataFrame:
    """(key, at, core, whole, n_bytes, digest) of every sample of every text.

    ``core`` names the bytes that all strings with this sample share: the CORE ones from the
    sample on. ``whole`` names all of them together, with the offsets. A text without samples
    has one row, with a null ``at``; the first row of a text has its size and digest.
    """

    def run(batches):
        for piece, texts in chunks(batches, "body"):
            keys, ats, cores, wholes, sizes, digests = [], [], [], [], [], []
            for key, text in zip(piece.column(0).to_pylist(), texts):
                data = text.encode()
                n = len(data)
                digest = hashlib.sha256(data).hexdigest()
                if n < LENGTH:
                    keys.append(np.array([key]))
                    ats.append(np.array([-1]))
                    cores.append(np.zeros(1, np.uint64))
                    wholes.append(np.zeros(1, np.uint64))
                    sizes.append(n)
                    digests.append(digest)
                    continue
                prints = Prints(np.frombuffer(data, np.uint8))
                at, first, last = samples(prints, n)
                whole = prints.of(first, last + LENGTH)
                whole = _mixed(whole + _mixed((at - first).astype(np.uint64) * np.uint64(1 << 20) + (last - first).astype(np.uint64)))
                keys.append(np.full(len(at), key))
                ats.append(at)
                cores.append(prints.of(at, at + CORE))
                wholes.append(whole)
                sizes += [n] + [None] * (len(at) - 1)
                digests += [digest] + [None] * (len(at) - 1)
            if keys:
                at = np.concatenate(ats)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys), pa.int64()),
                        pa.array(at, pa.int64(), mask=at < 0),
                        _signed(np.concatenate(cores)),
                        _signed(np.concatenate(wholes)),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.string()),
                    ],
                    names=["key", "at", "core", "whole", "n_bytes", "digest"],
                )

    return docs.mapInArrow(run, "key long, at long, core long, whole long, n_bytes long, digest string")


def _parts(texts: DataFrame) -> DataFrame:
    """(key, at, part, name, weight, asked): parts of PART starts of the samples in ``asks``.

    A part holds the starts whose offset to the sample has the same quotient by PART; its name is
    that of the bytes all its strings share, so a part found once is done with.
    """

    def run(batches):
        for piece, bodies in chunks(batches, "body"):
            for key, text, asks in zip(piece.column(0).to_pylist(), bodies, piece.column(2).to_pylist()):
                data = text.encode()
                prints = Prints(np.frombuffer(data, np.uint8))
                at, first, last = samples(prints, len(data))
                rows = np.searchsorted(at, [a["at"] for a in asks])
                low, high = (at - last)[rows] // PART, (at - first)[rows] // PART
                count = high - low + 1
                part = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                place = np.repeat(at[rows], count)
                latest = place - PART * part
                name = prints.of(latest, latest - PART + 1 + LENGTH)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), key), pa.int64()),
                        pa.array(place, pa.int64()),
                        pa.array(part, pa.int32()),
                        _signed(_mixed(name + part.astype(np.uint64))),
                        pa.array(np.repeat([a["weight"] for a in asks], count), pa.int64()),
                        pa.array(np.repeat([a["asked"] for a in asks], count), pa.bool_()),
                    ],
                    names=["key", "at", "part", "name", "weight", "asked"],
                )

    return texts.mapInArrow(run, "key long, at long, part int, name long, weight long, asked boolean")


def _between(texts: DataFrame) -> DataFrame:
    """(key, start, name, weight, asked) of the strings of the parts listed in ``parts``.

    These are the suffixes between samples that the names of samples and parts do not settle; each
    is named by its own LENGTH bytes.
    """

    def run(batches):
        for piece, bodies in chunks(batches, "body"):
            for key, text, parts in zip(piece.column(0).to_pylist(), bodies, piece.column(2).to_pylist()):
                data = text.encode()
                prints = Prints(np.frombuffer(data, np.uint8))
                at, first, last = samples(prints, len(data))
                place = np.array([p["at"] for p in parts])
                part = np.array([p["part"] for p in parts])
                rows = np.searchsorted(at, place)
                low = np.maximum(first[rows], place - PART * (part + 1) + 1)
                high = np.minimum(last[rows], place - PART * part)
                count = high - low + 1
                start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(start), key), pa.int64()),
                        pa.array(start, pa.int64()),
                        _signed(prints.of(start, start + LENGTH)),
                        pa.array(np.repeat([p["weight"] for p in parts], count), pa.int64()),
                        pa.array(np.repeat([p["asked"] for p in parts], count), pa.bool_()),
                    ],
                    names=["key", "start", "name", "weight", "asked"],
                )

    return texts.mapInArrow(run, "key long, start long, name long, weight long, asked boolean")


def _ranges(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive numbers: (first, last)."""
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]


def _cut(texts: DataFrame) -> DataFrame:
    """What is left of each text when the strings of settled samples and single starts are removed."""

    def run(batches):
        for piece, bodies in chunks(batches, "body"):
            out = []
            for key, text, held, single in zip(
                piece.column(0).to_pylist(), bodies, piece.column(2).to_pylist(), piece.column(3).to_pylist()
            ):
                data = text.encode()
                n = len(data)
                edges = np.zeros(n + 1, np.int64)
                if held:
                    at, first, last = samples(Prints(np.frombuffer(data, np.uint8)), n)
                    chosen = np.isin(at, np.array(held))
                    np.add.at(edges, first[chosen], 1)
                    np.add.at(edges, last[chosen] + LENGTH, -1)
                if single:
                    first, last = _ranges(np.array(single))
                    np.add.at(edges, first, 1)
                    np.add.at(edges, last + LENGTH, -1)
                gone = np.cumsum(edges[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((key, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3])],
                    names=["key", "n_removed", "n_spans", "kept_sha256"],
                )

    return texts.mapInArrow(run, "key long, n_removed long, n_spans long, kept_sha256 string")


def _among(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is one of ``names``, which differ from each other.

    The names are written first. Joined as the aggregate that they come from, they leave all rows of
    a hot name in one task, since Spark splits no join beside an aggregate by the same column.
    """
    found, counted = materialize_counted(names, "names")
    return rows.join(broadcast_if_small(found, counted["rows"]), column)


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Every byte is removed that a string of LENGTH bytes covers which starts anywhere else too, in
    any document or the same; overlaps count. Texts are UTF-8; strings never cross documents.

    Samples stand for the suffixes around them, as a difference cover does: equal strings have
    their sample at the same offset, so a string is repeated only if its sample's core is. Samples
    whose core is found once are done with. Of the others, one whose whole surroundings are found
    twice settles all its strings. The rest, and one copy of each settled sample with the same
    core, which they may equal, are cut into parts that are named in the same way; where a part is
    found twice its strings are named one by one.

    Null and empty texts have no bytes. Texts under LENGTH bytes lose none. Repeated rows are
    repeats of each other and come back one by one. Other columns are ignored. An empty table
    gives none. Names are 64-bit fingerprints. Hot strings are counted before the shuffle, and
    their rows are found by a broadcast, or by a join whose hot partitions Spark splits; no group
    of equal strings is ever gathered.
    """
    texts = docs.select(F.xxhash64(text_of(text)).alias("key"), text_of(text).alias("body"))
    sampled = materialize(_sampled(texts), "sampled")
    named = sampled.where("at IS NOT NULL").select("key", "at", "core", "whole")
    twice = named.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    live = materialize(_among(named, twice, "core"), "live")
    # One row for each different surroundings; copies of a text share a key and are counted here.
    kinds = live.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("key", "at")).alias("one"))
    kinds = materialize(kinds, "kinds")
    settled = kinds.where("n > 1").select("core", "whole")
    doubtful = kinds.where("n = 1")
    open_cores = doubtful.select("core").distinct()
    asks = _among(kinds, open_cores, "core").select(
        F.col("one.key").alias("key"),
        F.struct(F.col("one.at").alias("at"), F.col("n").alias("weight"), (F.col("n") == 1).alias("asked")).alias("ask"),
    )
    asks = asks.groupBy("key").agg(F.collect_list("ask").alias("asks"))
    held = live.join(settled, ["core", "whole"]).select("key", "at").distinct()
    held = held.groupBy("key").agg(F.collect_list("at").alias("held"))
    concerned = materialize(held.join(asks, "key", "full"), "concerned")
    # Copies of a text are made one before the shuffle.
    different = texts.where(F.octet_length("body") >= LENGTH).groupBy("key").agg(F.min("body").alias("body"))
    bodies = materialize(different.join(concerned, "key"), "bodies")
    parts = materialize(_parts(bodies.where("asks IS NOT NULL").select("key", "body", "asks")), "parts")
    shared = parts.groupBy("name").agg(F.sum("weight").alias("n"), F.max("asked").alias("any")).where("n > 1 AND any")
    listed = _among(parts, shared.select("name"), "name").groupBy("key").agg(
        F.collect_list(F.struct("at", "part", "weight", "asked")).alias("parts")
    )
    between = materialize(_between(bodies.join(listed, "key").select("key", "body", "parts")), "between")
    names = between.groupBy("name").agg(F.sum("weight").alias("n")).where("n > 1").select("name")
    single = _among(between.where("asked"), names, "name").groupBy("key").agg(F.collect_list("start").alias("single"))
    cut = _cut(bodies.join(single, "key", "left").select("key", "body", "held", "single"))
    sizes = sampled.where("digest IS NOT NULL").select("key", "n_bytes", "digest").distinct()
    by_key = materialize(
        sizes.join(cut, "key", "left").select(
            "key",
            "n_bytes",
            F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
            F.coalesce("kept_sha256", "digest").alias("kept_sha256"),
        ),
        "removed",
    )
    ids = docs.select(F.col(f"`{id_column}`").alias(id_column), F.xxhash64(text_of(text)).alias("__key"))
    joined = ids.join(by_key, ids["__key"] == by_key["key"])
    return joined.select(id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256")
