"""Plain versions of the operators, written from their definitions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

BASE = {
    "assign": (re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def secrets(text):
    """Counts of the base kinds and their digest."""
    text = text or ""
    spans = [
        (m.start(), k, kind, m.end())
        for k, (kind, (pattern, group, least)) in enumerate(BASE.items())
        for m in pattern.finditer(text)
        if len(m.group(group)) >= least
    ]
    line = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))
    counts = Counter(kind for _, _, kind, _ in spans)
    return counts["assign"], counts["access"], counts["hex"], hashlib.sha256(line.encode()).hexdigest()


def shingle_set(text):
    words = WORDS.findall(text or "")
    if not words:
        return None
    width = min(5, len(words))
    return frozenset(tuple(words[n : n + width]) for n in range(len(words) - width + 1))


def near_duplicates(rows):
    """{row number: (class id, copy id, links)} of (id, text) rows, by all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    different = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    number = {s: n for n, s in enumerate(different)}
    holders = defaultdict(list)
    for n, s in enumerate(different):
        for item in s:
            holders[item].append(n)
    common = Counter()
    for held in holders.values():
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                common[a, b] += 1
    links, parent = Counter(), list(range(len(different)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for (a, b), both in common.items():
        if 10 * both >= 8 * (len(different[a]) + len(different[b]) - both):
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    ids = defaultdict(list)
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            ids["copy", number[s]].append(doc)
            ids["class", root(number[s])].append(doc)
    least = {k: min(v) for k, v in ids.items()}
    out = []
    for (doc, _), s in zip(rows, sets):
        if s:
            n = number[s]
            out.append((doc, least.get(("class", root(n))), least.get(("copy", n)), links[n]))
        else:
            out.append((doc, doc, doc, 0))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[n : n + 5]) for n in range(len(words) - 4))
    inside = {n + k for n in range(len(words) - 4) if windows[tuple(words[n : n + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(WORDS.search(line))
        seen.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), failed
