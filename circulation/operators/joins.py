"""Lookup joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Join ``big`` to a lookup side without a hint or a count of its own.

    Both sides are shuffled on the key unless adaptive execution has measured the lookup side's bytes
    under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and broadcasts it; a key with a large share
    of ``big`` is split, as long as neither side is read in a bucketed layout.
    """
    return big.join(small, on, how)
