"""Small column helpers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as one identifier, so that dots and back-ticks in it survive."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def same(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """Null-safe equality of all pairs, as a join condition."""
    return reduce(and_, [left.eqNullSafe(right) for left, right in pairs])
