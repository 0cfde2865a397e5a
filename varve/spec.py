"""Table settings and zone paths (K8, F8)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql.types import StructType

ZONES = ("landing", "control", "bronze", "silver", "gold")


def one_of(value: str, allowed: Iterable[str], what: str) -> str:
    allowed = list(allowed)
    if value not in allowed:
        raise ValueError(f"invalid {what} {value!r}, expected one of {allowed}")
    return value


def plain_name(value: str, what: str) -> str:
    """A name that is used as one path segment."""
    if not value or "/" in value:
        raise ValueError(f"{what} {value!r} must be non-empty and hold no '/'")
    return value


@dataclass(frozen=True)
class Zones:
    """The zone folders of one source below a root."""

    root: str
    source: str

    def __post_init__(self) -> None:
        plain_name(self.source, "source")

    def path(self, zone: str) -> str:
        one_of(zone, ZONES, "zone")
        return f"{self.root.rstrip('/')}/{zone}/{self.source}"

    @property
    def landing(self) -> str:
        return self.path("landing")

    @property
    def control(self) -> str:
        return self.path("control")

    @property
    def bronze(self) -> str:
        return self.path("bronze")

    @property
    def silver(self) -> str:
        return self.path("silver")

    @property
    def gold(self) -> str:
        return self.path("gold")


@dataclass(frozen=True)
class TableSpec:
    """How one landing table is read and versioned.

    ``key`` is the logical key the versions are kept by; it need not be unique in a
    batch. A ``schema`` saves the inference pass and keeps the row hash independent of
    what a batch happens to hold. ``where`` is the extra silver predicate.
    """

    name: str
    key: str | Sequence[str]
    schema: StructType | str | None = None
    quote_escape: str = "\\"
    multiline: bool = False
    where: str | None = None
    hash_mode: str = "compat"
    drift: str = "fail"

    def __post_init__(self) -> None:
        plain_name(self.name, "table")
        object.__setattr__(self, "key", key_columns(self.key))
        one_of(self.hash_mode, ("compat", "strict"), "hash_mode")
        one_of(self.drift, ("fail", "string"), "drift")


def key_columns(key: str | Sequence[str]) -> tuple[str, ...]:
    columns = (key,) if isinstance(key, str) else tuple(key)
    if not columns:
        raise ValueError("a key needs at least one column")
    return columns
