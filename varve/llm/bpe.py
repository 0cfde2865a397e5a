"""Byte-level BPE: encoding by a rank queue over a hierarchical bitmap, and decoding."""

from __future__ import annotations

import base64
import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from varve.llm.common import CHUNK_CHARS, map_texts, text_of

# Pre-tokens a worker remembers, and the longest of them in characters: the bound of its memory.
REMEMBERED = 400_000
REMEMBERED_CHARS = 64

# Pre-tokens merged in one queue: so many that the lists stay in a processor's cache.
TOGETHER = 2000

WORD_BITS = 6


class RankQueue:
    """Positions by merge rank; the least rank is found by find-first-set, level by level.

    Level 0 has a bit for each rank, each further level a bit for each word of the level below.
    A rank's bucket lists the positions that wait for it, in any order.
    """

    def __init__(self, ranks: int):
        self.levels: list[list[int]] = []
        size = max(ranks, 1)
        while True:
            size = (size + 63) >> WORD_BITS
            self.levels.append([0] * size)
            if size == 1:
                break
        self.buckets: dict[int, list[int]] = {}

    def put(self, rank: int, positions: list[int]) -> None:
        """Open a bucket; a rank that has one already gets the positions added."""
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        at = rank
        for level in self.levels:
            word, was = at >> WORD_BITS, level[at >> WORD_BITS]
            level[word] = was | 1 << (at & 63)
            if was:
                return
            at = word

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank that has a bucket, and its positions from left to right."""
        if not self.levels[-1][0]:
            return None
        at = 0
        for level in reversed(self.levels):
            bits = level[at]
            at = at << WORD_BITS | ((bits & -bits).bit_length() - 1)
        up = at
        for level in self.levels:
            word = up >> WORD_BITS
            level[word] &= ~(1 << (up & 63))
            if level[word]:
                break
            up = word
        bucket = self.buckets.pop(at)
        bucket.sort()
        return at, bucket


class Codec:
    """Encoder and decoder for one table of ranks. A token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        compiled = regex.compile(pattern)
        self.find, self.find_each = compiled.findall, compiled.finditer
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.single = np.array([ranks[bytes([n])] for n in range(256)], np.uint32)
        self.double = np.full(1 << 16, -1, np.int64)
        for piece, rank in ranks.items():
            if len(piece) == 2:
                self.double[piece[0] << 8 | piece[1]] = rank
        # Rank of two adjacent ids, under left id * (wall + 1) + right id; the wall pairs with nothing.
        self.wall = len(self.pieces)
        self.pairs = {
            a * (self.wall + 1) + b: rank
            for piece, rank in ranks.items()
            for cut in range(1, len(piece))
            if (a := ranks.get(piece[:cut])) is not None and (b := ranks.get(piece[cut:])) is not None
        }
        self.queue = RankQueue(len(self.pieces))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, as little-endian unsigned 32-bit integers.

        All pre-tokens lie in one linked list, with a part between them that pairs with nothing,
        and share the queue. The least rank of all is the least of its pre-token too, so the pairs
        of a popped bucket merge from left to right. Where a merge makes a pair of a lower rank,
        the rest of the bucket goes back and waits for it.
        """
        text = b"\0" + b"\0".join(pieces) + b"\0"
        n = len(text)
        stops = np.cumsum([0, *[len(p) + 1 for p in pieces]])
        raw = np.frombuffer(text, np.uint8)
        pairs = np.full(n, -1, np.int64)
        pairs[:-1] = self.double[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        pairs[stops] = -1
        pairs[stops[1:] - 1] = -1
        order = np.argsort(pairs, kind="stable")
        order = order[np.searchsorted(pairs[order], 0) :]
        first, starts = np.unique(pairs[order], return_index=True)
        queue = self.queue
        for rank, positions in zip(first.tolist(), np.split(order, starts[1:])):
            queue.put(rank, positions.tolist())
        start_ids = self.single[raw]
        start_ids[stops] = wall = self.wall
        ids = start_ids.tolist()
        due = pairs.tolist()  # rank of the pair whose left part starts at a position
        ends = list(range(1, n + 1))  # where the part that starts at a position ends
        before = list(range(-1, n - 1))
        base = wall + 1
        get, buckets, put, pop = self.pairs.get, queue.buckets, queue.put, queue.pop
        while (least := pop()) is not None:
            rank, bucket = least
            scaled = rank * base
            for k, at in enumerate(bucket):
                if due[at] != rank:
                    continue  # stale: a part of that pair has changed since
                right = ends[at]
                ends[at] = end = ends[right]
                before[end] = at
                ids[at] = rank
                ids[right] = due[right] = -1
                new = get(scaled + ids[end], -1)
                due[at] = new
                lower = -1 < new < rank
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(at)
                    else:
                        put(new, [at])
                left = before[at]
                new = get(ids[left] * base + rank, -1)
                if new != due[left]:
                    due[left] = new
                    if new >= 0:
                        lower |= new < rank
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            put(new, [left])
                if lower and k + 1 < len(bucket):
                    put(rank, bucket[k + 1 :])
                    break
        left = np.array(ids, np.int64)
        left[stops] = -1
        alive = left >= 0
        made = left[alive].astype("<u4").tobytes()
        cuts = (np.cumsum(alive)[stops] * 4).tolist()
        return [made[a:b] for a, b in zip(cuts, cuts[1:])]

    def _ids(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of each list of pre-tokens. The new ones are merged at once and remembered.

        The memory has two generations: when the younger is full it becomes the older, and what
        is met again moves up, so frequent pre-tokens stay.
        """
        known, older = self.known, self.older
        new = set().union(*lists).difference(known)
        fresh, rest = {}, []
        for piece in new:
            if (ids := older.get(piece)) is not None:
                fresh[piece] = ids
            elif (whole := self.ranks.get(piece.encode())) is not None:
                fresh[piece] = whole.to_bytes(4, "little")
            else:
                rest.append(piece)
        for at in range(0, len(rest), TOGETHER):
            some = rest[at : at + TOGETHER]
            fresh.update(zip(some, self.merge([p.encode() for p in some])))
        known.update(fresh)
        made = [b"".join(map(known.__getitem__, found)) for found in lists]
        for piece in [p for p in fresh if len(p) > REMEMBERED_CHARS]:
            del known[piece]
        if len(known) > REMEMBERED // 2:
            self.known, self.older = {}, known
        return made

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Texts that are short together are worked on at once, others in blocks."""
        if sum(map(len, texts)) <= 2 * CHUNK_CHARS:
            return self._ids([self.find(t) for t in texts])
        made = []
        for text in texts:
            out, matches = [], (m.group() for m in self.find_each(text))
            while block := list(islice(matches, 1 << 17)):
                out += self._ids([block])
            made.append(b"".join(out))
        return made

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, memoryview(ids).cast("I")))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


_codecs: dict[tuple, Codec] = {}


def codec(ranks, pattern: str) -> Codec:
    """The codec of a broadcast rank table; a worker process builds it once."""
    key = (ranks.id if hasattr(ranks, "id") else id(ranks), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks.value, pattern)
    return _codecs[key]


SCHEMA = "n_tokens long, ids binary, decoded binary"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _run(docs: DataFrame, keep: list[str], text: str, ranks: dict[bytes, int], pattern: str, schema: str, out):
    """Send the rank table, whose size the vocabulary bounds, to the workers and encode there."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def body(texts):
        tool = codec(_Named(shared), pattern)
        return out([(ids, tool.decode(ids)) for ids in tool.encode_all(texts)])

    return map_texts(docs, keep, text_of(text), body, schema)


class _Named:
    """A broadcast's value under a key that stays the same in a worker."""

    def __init__(self, shared):
        self.value = shared.value
        self.id = id(self.value)


def encode(docs: DataFrame, keep: list[str], ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``keep``, the number of tokens, the ids (32-bit little-endian) and the decoded bytes.

    Every match of ``pattern`` is encoded by itself, without special tokens. Pre-tokens may be of
    any length: a merge costs the logarithm of a bucket. Null and empty texts have no ids. Repeated
    rows get equal results; other columns are ignored, whatever their names; an empty table gives
    none.
    """

    def out(pairs):
        return [
            [len(i) // 4 for i, _ in pairs],
            pa.array([i for i, _ in pairs], pa.binary()),
            pa.array([d for _, d in pairs], pa.binary()),
        ]

    return _run(docs, keep, text, ranks, pattern, SCHEMA, out)


def encode_digests(
    docs: DataFrame, keep: list[str], ranks: dict[bytes, int], pattern: str, text: str = "text"
) -> DataFrame:
    """As :func:`encode`, with SHA-256 digests in place of ids and bytes."""

    def out(pairs):
        return [
            [len(i) // 4 for i, _ in pairs],
            [hashlib.sha256(i).hexdigest() for i, _ in pairs],
            [hashlib.sha256(d).hexdigest() for _, d in pairs],
        ]

    return _run(docs, keep, text, ranks, pattern, DIGESTS, out)
