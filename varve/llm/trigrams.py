"""Boolean trigram queries that a regular expression implies."""

from __future__ import annotations

import re._constants as ops
import re._parser as parser

# Strings that one run of a pattern may stand for before the run is given up.
MOST_STRINGS = 64
FEW_CHARACTERS = 6

# A query is a list of clauses that must all hold; a clause is a list of trigram sets of which
# one must be contained whole. The empty list asks for nothing.
Query = list[list[frozenset[str]]]


def _grams(text: str) -> frozenset[str]:
    text = text.lower()
    return frozenset(text[n : n + 3] for n in range(len(text) - 2))


def _clause(strings: set[str]) -> Query:
    """The clause for "one of these strings occurs", if each of them has a trigram."""
    sets = {_grams(s) for s in strings}
    if not strings or frozenset() in sets:
        return []
    least = [s for s in sets if not any(o < s for o in sets)]
    return [sorted(least, key=sorted)]


def _exact(nodes) -> set[str] | None:
    """All strings the nodes stand for, if these are few."""
    strings = {""}
    for op, arg in nodes:
        if op is ops.LITERAL:
            step = {chr(arg)}
        elif op is ops.IN and all(o in (ops.LITERAL, ops.RANGE) for o, _ in arg):
            step = set()
            for o, a in arg:
                step |= {chr(a)} if o is ops.LITERAL else {chr(c) for c in range(a[0], a[1] + 1)}
            if len(step) > FEW_CHARACTERS:
                return None
        elif op is ops.SUBPATTERN:
            step = _exact(arg[3])
        elif op is ops.BRANCH:
            parts = [_exact(branch) for branch in arg[1]]
            step = None if None in parts else set().union(*parts)
        elif op is ops.MAX_REPEAT and arg[1] is not ops.MAXREPEAT and arg[1] <= 8:
            once = _exact(arg[2])
            step = once and {""} if arg[0] == 0 else once
            for n in range(1, arg[1] + 1) if once else ():
                strings_n = {""}
                for _ in range(n):
                    strings_n = {a + b for a in strings_n for b in once}
                    if len(strings_n) > MOST_STRINGS:
                        return None
                step = (step | strings_n) if n >= max(1, arg[0]) and (arg[0] == 0 or n > arg[0]) else strings_n
        else:
            return None
        if step is None:
            return None
        strings = {a + b for a in strings for b in step}
        if len(strings) > MOST_STRINGS:
            return None
    return strings


def _walk(nodes) -> Query:
    query: Query = []
    run: set[str] = {""}
    for node in nodes:
        op, arg = node
        step = _exact([node])
        longer = {a + b for a in run for b in step} if step is not None else set()
        if step is not None and len(longer) <= MOST_STRINGS:
            run = longer
            continue
        query += _clause(run)
        run = step if step is not None else {""}
        if step is not None:
            continue
        if op is ops.SUBPATTERN:
            query += _walk(arg[3])
        elif op is ops.MAX_REPEAT and arg[0] >= 1:
            query += _walk(arg[2])
        elif op is ops.BRANCH:
            parts = [_walk(branch) for branch in arg[1]]
            if all(parts):  # each branch asks for something: one of their first clauses' sets must hold
                query.append([s for part in parts for s in part[0]])
    return query + _clause(run)


def trigram_query(pattern: str) -> Query:
    """What lower-case trigrams a text must hold for ``pattern`` to match in it.

    The empty query means that the pattern has no mandatory trigram. Case is ignored, which can
    only let more texts through.
    """
    return _walk(parser.parse(pattern))
