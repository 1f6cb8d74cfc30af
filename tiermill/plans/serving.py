"""Serving reads of the marts: projection plus the order the consumer sees.
Sorting happens here, at read time; a stored table keeps no order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.snapshots import StoredTable

QUARTERLY_COLUMNS = ["department", "job", "Q1", "Q2", "Q3", "Q4", "total_hires"]
PERFORMANCE_COLUMNS = ["id", "department", "hired", "mean_hired", "diff_from_mean"]


def quarterly_hires(mart: DataFrame) -> DataFrame:
    return mart.select(*QUARTERLY_COLUMNS).orderBy("department", "job")


def dept_performance(mart: DataFrame) -> DataFrame:
    """Most hires first; ``id`` breaks ties so the order is total."""
    return mart.select(*PERFORMANCE_COLUMNS).orderBy(F.desc("hired"), "id")


def preview(ordered: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows of an ordered read (a top-n, not a full sort)."""
    return ordered.limit(n)


def store_in_order(table: StoredTable, mart: DataFrame, keys: list[str]) -> None:
    """Store a mart in files that are ranges of its keys, each in key order, so
    that the minima and maxima of files and row groups tell which a page needs."""
    table.replace(mart.repartitionByRange(*keys).sortWithinPartitions(*keys))


def page(mart: DataFrame, keys: list[str], n: int, after: tuple | None = None) -> DataFrame:
    """The first ``n`` rows in key order whose keys come after ``after``, the keys
    of the last row of the page before.

    The keys are unique and not null.  The condition on the first key reaches the
    scan, and a row's page does not depend on the rows before it, as it would with
    an offset.  ``n`` bounds what is kept (a top-n, not a full sort)."""
    if after is not None:
        beyond, equal = F.lit(False), F.lit(True)
        for key, value in zip(keys, after, strict=True):
            beyond = beyond | (equal & (F.col(key) > F.lit(value)))
            equal = equal & (F.col(key) == F.lit(value))
        mart = mart.filter(F.col(keys[0]) >= F.lit(after[0])).filter(beyond)
    return mart.orderBy(*keys).limit(n)


def last_keys(rows: DataFrame, keys: list[str]) -> tuple | None:
    """Keys of the last row of a page; None for an empty one."""
    last = rows.agg(F.max(F.struct(*keys)).alias("last")).first()["last"]
    return None if last is None else tuple(last)
