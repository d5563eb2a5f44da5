"""Contiguous shards of equal bytes from global prefix sums of row sizes.

Rows are put in one global order; the bytes before a row decide its shard: the total is cut at
equal targets and a row goes to the shard that its midpoint falls into, so shard sizes differ
from the target by less than the largest row.

Defined results: a null text counts no bytes, an empty table gives no rows, equal ids are ordered
by the other order columns and then by their place in the input (repeated rows all stay), a null
id sorts first. ``shard`` and ``slot`` replace input columns of the same name in any case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circulation.llm.common import global_prefix, without

ROW_OVERHEAD = 16


def row_size(text: str = "text", overhead: int = ROW_OVERHEAD) -> Column:
    """UTF-8 bytes of the text plus a fixed overhead for the row's other fields."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(overhead)).cast("long")


def shard_by_bytes(df: DataFrame, size: str, order: Sequence[str], n_shards: int) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 .. n_shards-1) and ``slot`` (gapless from 0).

    ``size`` names a column of non-negative bytes, ``order`` the columns whose order the shards follow.
    """
    df = without(df, ["shard", "slot"])
    # The row goes along as one value, so that no column of its can clash with those that are added on the way.
    keys = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)]
    slim = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), F.col(f"`{size}`").cast("long").alias("size"), *keys)
    placed = global_prefix(slim, [F.col(f"k{i}").asc_nulls_first() for i in range(len(keys))], ["size"], "shards")
    mid = F.col("size_before") * 2 + F.coalesce(F.col("size"), F.lit(0))
    twice = F.greatest(F.col("size_total") * 2, F.lit(1))
    shard = F.least(F.expr(f"{n_shards}L - 1"), F.floor((mid.cast("decimal(38,0)") * n_shards) / twice)).cast("int")
    placed = placed.withColumn("shard", shard)
    # One row per shard: its first rank.
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))
    return placed.join(F.broadcast(first), "shard").select("row.*", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def write_shards(df: DataFrame, path: str, n_shards: int, files_per_shard: int = 1) -> None:
    """Write a sharded table as ``path/shard=<k>`` folders, rows in slot order inside each file."""
    dealt = df.repartitionByRange(n_shards * max(1, files_per_shard), "shard", "slot")
    dealt.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
