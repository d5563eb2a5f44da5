"""Top-k (K1, K2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows under ``order``. Planned as ``TakeOrderedAndProject``: each task keeps
    its own best k, so only k rows per task reach the final merge. ``order`` should be total
    (tie-break on the key) so the cut at k is stable."""
    return df.orderBy(*order).limit(k)
