"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame

from varve.llm.common import map_texts, text_of

# Fixed value: the published pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LIMIT = 512
# Pre-tokens a worker remembers in each of two generations, and the longest of them.
REMEMBERED = 200_000
REMEMBERED_CHARS = 64
# Bytes of new pre-tokens merged at once, unless one alone is longer.
TOGETHER = 1 << 19

NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Merges:
    """A byte-level merge table: ids of the 256 bytes, sorted pair keys with rank and new id."""

    single: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    base: int
    special: tuple[str, ...]


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def read_merges(path: str) -> Merges:
    """The merge table of a tokenizer file with a byte-level BPE model."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    base = max(vocab.values()) + 1
    single = np.zeros(256, np.int64)
    for sign, byte in _byte_signs().items():
        single[byte] = vocab[sign]
    rows = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        rows[vocab[left] * base + vocab[right]] = (rank, vocab[left + right])
    keys = np.array(sorted(rows), np.int64)
    special = tuple(t["content"] for t in spec.get("added_tokens", ()))
    return Merges(
        single,
        keys,
        np.array([rows[k][0] for k in keys.tolist()], np.int64),
        np.array([rows[k][1] for k in keys.tolist()], np.int64),
        base,
        special,
    )


def merged_counts(table: Merges, pieces: list[bytes]) -> np.ndarray:
    """Symbols that are left of each piece when no pair can be merged.

    All pieces lie in one array. A round looks up the rank of every adjacent pair, takes the
    least of each piece, and merges all its places there at once; of overlapping ones every
    second, from the left. Pieces without a pair leave the array.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    counts = sizes.copy()
    symbols = table.single[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), sizes)
    while len(symbols) > 1:
        keys = symbols[:-1] * table.base + symbols[1:]
        found = np.searchsorted(table.keys, keys)
        found[found == len(table.keys)] = 0
        hit = (table.keys[found] == keys) & (owner[:-1] == owner[1:]) if len(table.keys) else np.zeros(len(keys), bool)
        ranks = np.append(np.where(hit, table.ranks[found] if len(table.keys) else NEVER, NEVER), NEVER)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        least = np.minimum.reduceat(ranks, starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        live = least < NEVER
        counts[owner[starts]] = lengths
        take = (ranks == np.repeat(least, lengths)) & (ranks < NEVER)
        at = np.flatnonzero(take)
        if not len(at):
            break
        # Runs of adjacent places overlap: of each run, take the first, third and so on.
        fresh = np.append(True, np.diff(at) != 1)
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        symbols[at] = table.made[found[at]]
        keep = np.repeat(live, lengths)
        keep[at + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    if len(symbols) == 1:
        counts[owner[0]] = 1
    return counts


class Counter:
    """Counts tokens of texts; remembers the counts of pre-tokens."""

    def __init__(self, table: Merges):
        self.table = table
        self.find = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, table.special))) if table.special else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _learn(self, pieces: set[str]) -> dict[str, int]:
        out, rest, held = {}, [], 0
        for piece in pieces:
            if (count := self.older.get(piece)) is not None:
                out[piece] = count
                continue
            rest.append(piece)
            held += len(piece)
            if held > TOGETHER:
                out.update(zip(rest, merged_counts(self.table, [p.encode() for p in rest]).tolist()))
                rest, held = [], 0
        if rest:
            out.update(zip(rest, merged_counts(self.table, [p.encode() for p in rest]).tolist()))
        return out

    def count(self, texts: list[str]) -> list[int]:
        lists, extra = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            lists.append([p for part in parts for p in self.find(part)])
            extra.append(len(parts) - 1)
        known = self.known
        fresh = self._learn(set().union(*lists).difference(known))
        known.update(fresh)
        made = [n + sum(map(known.__getitem__, found)) for found, n in zip(lists, extra)]
        for piece in [p for p in fresh if len(p) > REMEMBERED_CHARS]:
            del known[piece]
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return made


SCHEMA = "n_bytes long, n_tokens long, over_limit boolean"

_counters: dict[int, Counter] = {}


def count_tokens(docs: DataFrame, keep: list[str], table: Merges, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """``keep``, the bytes and tokens of each text, and whether these exceed ``limit``.

    Special strings of the tokenizer count as one token each wherever a text holds them. Null and
    empty texts have none. Repeated rows count alike, other columns are ignored, whatever their
    names; an empty table gives none. A pre-token of any length is merged whole, in rounds of one
    pass each. One pass over the table, no shuffle; the merge table is bounded by the vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def body(texts):
        value = shared.value
        if id(value) not in _counters:
            _counters.clear()
            _counters[id(value)] = Counter(value)
        counts = _counters[id(value)].count(texts)
        return [[len(t.encode()) for t in texts], counts, [c > limit for c in counts]]

    return map_texts(docs, keep, text_of(text), body, SCHEMA)
