"""Calendar spine and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_spine(bounds: DataFrame, lo: str = "lo", hi: str = "hi", out: str = "date") -> DataFrame:
    """One row per day from ``lo`` to ``hi`` inclusive, for each row of ``bounds``.

    ``bounds`` is normally a one-row aggregate; the spine grows with the number of days,
    never with the number of rows behind the bounds.
    """
    return bounds.select(
        F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"), F.expr("INTERVAL 1 DAY"))).alias(out)
    )


def align_to_calendar(spine: DataFrame, values: DataFrame, on: str, fill: Sequence[str]) -> DataFrame:
    """Left join of the spine and fill missing values with 0."""
    joined = spine.join(values, on, "left")
    return joined.select(on, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in fill])
