"""Helpers shared by the training-data operators: written intermediates and global prefix sums.

Intermediates are Parquet tables below the shared checkpoint folder
(``circulation.session.scratch_path``), so a lost executor costs the tasks it ran and no
plan has to be computed twice with a chance to differ.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from circulation.session import scratch_path

# Bytes of one Arrow batch handed to Python: bounds a worker's memory whatever the texts' lengths.
BATCH_BYTES = 8 << 20


# What adaptive execution may broadcast once it has measured a side's shuffled bytes: packed rows of
# arrays and digests take several times that in the driver's and the executors' memory.
MEASURED_BROADCAST = 4 << 20


def bound_memory(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as rows of text differ in size by orders of magnitude, and broadcasts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(MEASURED_BROADCAST))


def written(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage durably."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(_nullable(df.schema)).parquet(path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``taken`` has it (in any case)."""
    low = {t.lower() for t in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add (compared in any case): its own win."""
    low = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in low])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def global_prefix(df: DataFrame, order: Sequence[Column], measures: Sequence[str], label: str,
                  rank: str = "rank", before: str = "_before") -> DataFrame:
    """Number all rows in ``order`` and give each the sums of ``measures`` over the rows before it.

    Adds ``rank`` (0, 1, ...), ``<measure>_before`` and, alike on every row, ``rows_total`` and
    ``<measure>_total``. Rows are range-partitioned and sorted, running sums are taken inside
    each partition, and one row of totals per partition is summed to offsets: no task sees more
    than its partition. Rows equal in ``order`` are told apart by their place in the input, so
    a key that a third of all rows share is dealt over many partitions. Null measures count 0.
    """
    spark = df.sparkSession
    tie, pid, pos = (free_name(df.columns, c) for c in ("gp_tie", "gp_part", "gp_pos"))
    keys = [*order, F.col(tie).asc()]
    # Written first: the range exchange reads its input twice, once to sample the bounds.
    df = written(df.withColumn(tie, F.monotonically_increasing_id()), label + "-rows")
    dealt = df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).drop(tie)
    added = [T.StructField(pid, T.IntegerType()), T.StructField(pos, T.LongType())]
    added += [T.StructField(m + before, T.LongType()) for m in measures]
    schema = T.StructType(list(_nullable(dealt.schema)) + added)
    names = list(measures)

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, sums = TaskContext.get().partitionId(), 0, [0] * len(names)
        for b in batches:
            n = b.num_rows
            cols = list(b.columns) + [pa.array(np.full(n, part, np.int32)),
                                      pa.array(np.arange(seen, seen + n, dtype=np.int64))]
            for i, m in enumerate(names):
                v = b.column(b.schema.get_field_index(m)).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(v, dtype=np.int64) + sums[i]
                cols.append(pa.array(ends - v))
                if n:
                    sums[i] = int(ends[-1])
            seen += n
            yield pa.RecordBatch.from_arrays(cols, names=list(b.schema.names) + [f.name for f in added])

    placed = written(dealt.mapInArrow(running, schema), label)
    totals = placed.groupBy(pid).agg(F.count(F.lit(1)).alias("n"), *[
        F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(f"t{i}") for i, m in enumerate(names)])
    # One row per partition of the exchange above, whatever the data: one task, and a bounded broadcast.
    ahead, whole = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    offsets = totals.select(
        pid, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("gp_n"), F.sum("n").over(whole).alias("rows_total"),
        *[F.coalesce(F.sum(f"t{i}").over(ahead), F.lit(0)).alias(f"gp_t{i}") for i in range(len(names))],
        *[F.sum(f"t{i}").over(whole).alias(m + "_total") for i, m in enumerate(names)])
    joined = placed.join(F.broadcast(offsets), pid)
    for i, m in enumerate(names):
        joined = joined.withColumn(m + before, F.col(m + before) + F.col(f"gp_t{i}"))
    return (joined.withColumn(rank, F.col(pos) + F.col("gp_n"))
            .drop(pid, pos, "gp_n", *[f"gp_t{i}" for i in range(len(names))]))
