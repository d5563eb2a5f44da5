"""C12 data-quality gate: every check runs, failures are logged, one error at the end.

A check is a name, a frame of one row and one number, and the least value that passes: row counts,
orphans, duplicates or any other scalar that a query can give.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circulation.constants import QUALITY_MINIMUM_ROWS

log = logging.getLogger(__name__)


class QualityError(Exception):
    pass


@dataclass(frozen=True)
class Check:
    name: str
    scalar: DataFrame
    minimum: int = QUALITY_MINIMUM_ROWS


def no_rows(name: str, offending: DataFrame) -> Check:
    """Passes (value 1) if ``offending`` is empty, fails with 0 or less: 1 minus its rows."""
    return Check(name, offending.agg((F.lit(1) - F.count(F.lit(1))).alias("value")), 1)


def scalar_checks(checks: Sequence[Check]) -> DataFrame:
    """One row per check: (check, value, passed); a NULL value fails. One job for all of them."""
    parts = [c.scalar.select(F.lit(c.name).alias("check"), F.col(f"`{c.scalar.columns[0]}`").cast("long").alias("value"),
                             F.lit(c.minimum).alias("minimum")) for c in checks]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select("check", "value", F.coalesce(F.col("value") >= F.col("minimum"), F.lit(False)).alias("passed"))


def orphan_check(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, name: str) -> Check:
    """No row of ``fact`` without its row in ``dim``; the fact's keys are made distinct first."""
    keys = fact.select(F.col(fact_key).alias("k")).distinct()
    return no_rows(name, keys.join(dim.select(F.col(dim_key).alias("k")), "k", "left_anti"))


def duplicate_check(table: DataFrame, key: str, name: str) -> Check:
    return no_rows(name, table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def row_count_checks(tables: Mapping[str, DataFrame], minimum: int = QUALITY_MINIMUM_ROWS) -> DataFrame:
    """One row per table: (check, value, passed) with value = row count, passed = value >= minimum.

    Each count is a partial + final aggregate; the union is one job with one row per check.
    """
    return scalar_checks([Check(name, df.agg(F.count(F.lit(1)).alias("value")), minimum) for name, df in tables.items()])


def enforce(checks: DataFrame) -> list[tuple[str, int, bool]]:
    """Run every check (one row each), log each failure, raise once if any failed."""
    rows = [(r["check"], int(r["value"] or 0), bool(r["passed"])) for r in checks.collect()]
    failed = [r for r in rows if not r[2]]
    for name, value, _ in failed:
        log.warning("data check %s failed: value %d below the minimum", name, value)
    if failed:
        raise QualityError("data checks below their minimum: " + ", ".join(f"{r[0]} = {r[1]}" for r in failed))
    return rows
