"""Quality rules: how much of a text lies inside its own repetitions."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from varve.llm.common import WORD, map_texts, spare, text_of

MIN_WORDS = 10
# Share of words, in per cent, that windows of five words found twice may cover.
MAX_REPEAT_WORDS = 20
SYMBOLS = "#*$%&|<>"
BASE_WINDOW = 5
# Shares of a long text's characters: those that all repeated windows of so many words may cover, those that
# the one window of so many words that covers most may, and those in lines equal to an earlier one.
COVERAGE = {4: 0.16, 5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
PHRASE = {2: 0.20, 3: 0.18, 4: 0.16}
LINES = 0.20
# A quotation or phrase that comes twice in a short text must pass, so each limit is raised by the share that
# so many words are of the text, up to a most. Set so that labelled clean texts stay.
QUOTED, PHRASED = 20, 9
MOST_QUOTED, MOST_PHRASED = 0.15, 0.45

SCHEMA = """n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
    base_failed boolean, kept boolean, worst_coverage double, line_coverage double,
    phrase_coverage double"""

_words = re.compile(WORD).findall


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, so that sums of them tell windows apart."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def found_twice(keys: np.ndarray) -> np.ndarray:
    """Which keys occur at least twice."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Mask of the positions inside windows of ``length`` at ``starts``."""
    edges = np.zeros(total + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def most_covering(keys: np.ndarray, starts: np.ndarray, length: int, upto: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """For each text, the characters that the windows of one key cover, for the key where these are most.

    ``starts`` ascends, ``upto`` has the characters before each word. Overlaps count once.
    """
    most = np.zeros(texts, np.int64)
    if len(starts):
        order = np.argsort(keys, kind="stable")
        ranked, at = keys[order], starts[order]
        same = ranked[1:] == ranked[:-1]
        fresh = at.copy()
        fresh[1:][same] = np.maximum(at[1:], at[:-1] + length)[same]
        first = np.flatnonzero(np.append(True, ~same))
        np.maximum.at(most, owner[at[first]], np.add.reduceat(upto[at + length] - upto[fresh], first))
    return most


def line_repeats(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the word characters in them."""
    seen: set[str] = set()
    count = chars = 0
    for line in text.split("\n"):
        if line in seen:
            found = _words(line)
            count += bool(found)
            chars += sum(map(len, found))
        else:
            seen.add(line)
    return count, chars


def measure(texts: list[str]) -> list:
    """The columns of ``SCHEMA`` for each text.

    Word hashes of all texts lie in one array. A window's rolling hash is the sum of its words'
    hashes times a power of an odd number, mixed with the number of its text, so one sort finds
    the windows that repeat within a text. A window of n + 1 words repeats only where one of n
    words does, so each longer length looks at what the shorter one left.
    """
    lists = [_words(t) for t in texts]
    n_words = np.array([len(w) for w in lists], np.int64)
    total = int(n_words.sum())
    owner = np.repeat(np.arange(len(texts)), n_words)
    ends = np.cumsum(n_words)[owner] if total else np.zeros(0, np.int64)
    chars = np.fromiter((len(w) for ws in lists for w in ws), np.int64, total)
    hashes = np.fromiter((hash(w) for ws in lists for w in ws), np.int64, total).view(np.uint64)
    hashes = mixed(hashes + np.uint64(0x9E3779B97F4A7C15))
    word_chars = np.bincount(owner, chars, len(texts)).astype(np.int64)
    salt = mixed(np.arange(len(texts), dtype=np.uint64) + np.uint64(1))[owner]

    base = np.zeros(len(texts), np.int64)
    worst, phrase = np.zeros(len(texts)), np.zeros(len(texts))
    failed = np.zeros(len(texts), bool)
    upto = np.append(0, np.cumsum(chars))
    sizes = np.maximum(n_words, 1)
    phrased = np.minimum(MOST_PHRASED, PHRASED / sizes)
    quoted = np.minimum(MOST_QUOTED, QUOTED / sizes)
    short = np.minimum(MOST_PHRASED, QUOTED / sizes)
    at = np.arange(total)
    rolling = np.zeros(total, np.uint64)
    factor, width = np.uint64(1), 0
    for length in sorted({*PHRASE, *COVERAGE}):
        at = at[at + length <= ends[at]]
        for k in range(width, length):
            rolling[: max(total - k, 0)] += hashes[k:] * factor
            factor = np.uint64(int(factor) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        width = length
        keys = mixed(rolling[at]) ^ salt[at]
        twice = found_twice(keys)
        at = at[twice]
        if length in PHRASE:
            share = most_covering(keys[twice], at, length, upto, owner, len(texts)) / np.maximum(word_chars, 1)
            phrase = np.maximum(phrase, share)
            failed |= share > PHRASE[length] + phrased
        if length in COVERAGE:
            mask = covered(at, length, total)
            share = np.bincount(owner[mask], chars[mask], len(texts)) / np.maximum(word_chars, 1)
            if length == BASE_WINDOW:
                base = np.bincount(owner[mask], minlength=len(texts)).astype(np.int64)
            worst = np.maximum(worst, share)
            failed |= share > COVERAGE[length] + (short if length < BASE_WINDOW else quoted)
    lines = [line_repeats(t) for t in texts]
    dup_lines = np.array([n for n, _ in lines], np.int64)
    in_lines = np.array([c for _, c in lines]) / np.maximum(word_chars, 1)
    failed |= in_lines > LINES + quoted
    base_failed = (n_words < MIN_WORDS) | (100 * base > MAX_REPEAT_WORDS * n_words)
    symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)
    return [n_words, word_chars, symbols, dup_lines, base, base_failed, ~base_failed & ~failed, worst, in_lines, phrase]


def quality_rules(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the measures of each text, in one pass without a shuffle.

    ``kept`` is false for texts that fail the base rules, and for those of whose characters too
    many lie inside repeated windows of four to ten words, inside one phrase of two to four
    words that recurs, or in repeated lines.

    A null or empty text has no words and fails. Repeated rows are measured alike, each on its
    own; other columns of ``docs`` are ignored, whatever their names. An empty table gives none.
    """
    return map_texts(docs, keep, text_of(text), measure, SCHEMA)


def reject_bad(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text :func:`quality_rules` keeps, with all their columns."""
    verdict = spare(docs, "__kept")[0]
    judged = map_texts(docs, docs.columns, text_of(text), lambda texts: [measure(texts)[6]], f"`{verdict}` boolean")
    return judged.where(f"`{verdict}`").drop(verdict)
