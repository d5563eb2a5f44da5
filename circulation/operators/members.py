"""Insert-only dimensions: new-member detection (J2) and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from circulation.session import materialise


def only_new(candidates: DataFrame, existing: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows of ``candidates`` whose key is not yet in ``existing`` (left anti join).

    Written as ``left_anti`` because Catalyst keeps the outer-join-plus-IS-NULL form as a
    LeftOuter join followed by a filter. NULL keys never match, as in the outer form.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return candidates.join(existing.select(*keys), keys, "left_anti")


def assign_ids(new_members: DataFrame, key: str, id_col: str, existing: DataFrame | None = None) -> DataFrame:
    """Give each row of ``new_members`` (unique on ``key``) an id max(existing)+1, +2, ... in
    ascending ``key`` order, without a global window.

    The members are range-partitioned and sorted by ``key``; each row's partition and its index
    inside it are written with the row to the shared scratch folder, so both uses below
    read the same numbers and an executor loss does not re-sample the range bounds. Per-partition counts (one row per partition)
    and per-partition maxima of the existing ids become running offsets in the only
    single-partition step, then are broadcast back; that side is bounded by partition counts.
    """
    ranged = (
        new_members.repartitionByRange(F.col(key).asc_nulls_first())
        .sortWithinPartitions(F.col(key).asc_nulls_first())
        .withColumn("_pid", F.spark_partition_id().cast("long"))
        .withColumn("_index", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid"), 33))
    )
    ranged = materialise(ranged, "new-members")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.lit(None).cast("long").alias("_base"))
    if existing is not None:
        # The existing maximum enters as one row per existing partition (partial max per task).
        base = (
            existing.select(F.spark_partition_id().alias("_xp"), F.col(id_col).cast("long").alias("_id"))
            .groupBy("_xp")
            .agg(F.max("_id").alias("_base"))
            .select(F.lit(-1).cast("long").alias("_pid"), F.lit(0).cast("long").alias("_n"), "_base")
        )
        counts = counts.unionByName(base)
    # One ordered window over these few rows (the only single-partition step): the existing
    # maximum over all of them, plus the rows of every earlier partition.
    ordered = Window.orderBy("_pid")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        (F.coalesce(F.max("_base").over(everything), F.lit(0)) + F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .alias("_offset"),
    ).where(F.col("_pid") >= 0)
    return ranged.join(F.broadcast(offsets), "_pid").select(
        *[c for c in new_members.columns],
        (F.col("_offset") + F.col("_index") + 1).cast("long").alias(id_col),
    )
