"""Registered queries over the test tables, with the SQL that checks them."""

from varve.catalog import (  # noqa: F401  (importing a module registers its queries)
    checks,
    jobs,
    landing,
    rows,
    streams,
    tables,
    versions,
)
from varve.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
