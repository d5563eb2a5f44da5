"""Additive roll-ups over dyadic intervals of days, and an exact top-k over them.

Level L, node N is the days D (since 1970) with ``D >> L == N``. Any range of days is the disjoint union of at most two
nodes a level, so a range's counts are sums of O(log days) stored rows per key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from circulation.operators.topk import top_k

LEVELS = 13  # nodes of 1 to 4,096 days
UNDATED = (-1, 0)  # the node of rows without a day: in no range, but in the whole
_EPOCH = dt.date(1970, 1, 1)
# Candidates of a top-k that are broadcast at most; more are joined.
BROADCAST_CANDIDATES = 100_000

Node = tuple[int, int]


def day_number(day: dt.date) -> int:
    return (day - _EPOCH).days


def cover(lo: int, hi: int) -> list[Node]:
    """The fewest nodes whose days are exactly ``lo`` to ``hi``."""
    out = []
    while lo <= hi:
        level = 0
        while level + 1 < LEVELS and lo & ((1 << (level + 1)) - 1) == 0 and lo + (1 << (level + 1)) - 1 <= hi:
            level += 1
        out.append((level, lo >> level))
        lo += 1 << level
    return out


def holding(days: Iterable[dt.date | None]) -> list[Node]:
    """Every node that holds one of the days."""
    found = {UNDATED if d is None else (level, day_number(d) >> level) for d in days for level in range(1 if d is None else LEVELS)}
    return sorted(found)


def node_sums(counts: DataFrame, keys: Sequence[str], count: str, tasks: int, day: str = "day") -> DataFrame:
    """(``keys``, ``count``, level, node): the sums of every node, from rows of a key and a day.

    The rows are shuffled once, by key, before they grow: a key's days in order give running sums, a row that is the last of
    its key in some nodes gives those, and a node's sum is the running sum there less that at the end of its key's node before."""
    number = F.datediff(F.col(day), F.lit(_EPOCH))
    dealt = counts.select(*keys, number.alias("_day"), F.col(count).alias("_n")).repartition(tasks, *keys)
    dealt = dealt.groupBy(*keys, "_day").agg(F.sum("_n").alias("_n"))  # in place, as all rows of a key are in one task
    own = Window.partitionBy(*keys).orderBy("_day")
    so_far, ahead = own.rowsBetween(Window.unboundedPreceding, Window.currentRow), own.rowsBetween(Window.unboundedPreceding, -1)
    dated = F.col("_day").isNotNull()
    run = dealt.withColumns({"_sum": F.sum(F.when(dated, F.col("_n"))).over(so_far), "_next": F.lead("_day").over(own)})
    # The highest level at which the next day is in another node.
    differ = F.col("_day").bitwiseXOR(F.col("_next"))
    level = reduce(Column.__add__, [(differ >= F.lit(1 << x)).cast("int") for x in range(1, LEVELS)])
    run = run.withColumn("_top", F.when(F.col("_next").isNull() | (differ < 0), F.lit(LEVELS - 1)).otherwise(level))
    ends = run.withColumns({f"_end{x}": F.last(F.when(F.col("_top") >= x, F.col("_sum")), ignorenulls=True).over(ahead) for x in range(LEVELS)})
    ended = F.slice(F.array(*[F.coalesce(f"_end{x}", F.lit(0)) for x in range(LEVELS)]), F.lit(1), F.col("_top") + 1)
    rows = ends.select(*keys, "_day", "_n", "_sum", F.posexplode(F.when(dated, ended).otherwise(F.array(F.lit(0).cast("long")))).alias("_level", "_end"))
    return rows.select(
        *keys, F.when(dated, F.col("_sum") - F.col("_end")).otherwise(F.col("_n")).alias(count),
        F.when(dated, F.col("_level")).otherwise(F.lit(UNDATED[0])).alias("level"),
        F.when(dated, F.expr("shiftright(_day, _level)")).otherwise(F.lit(UNDATED[1])).alias("node"))


def node_order(count: str) -> Column:
    """Level, node, then ``count`` downwards, in one number, which Spark sorts by its bits; counts from 2^31 are alike in it."""
    node = (F.col("level") + 1).cast("long") * (1 << 26) + F.col("node") + (1 << 25)
    return node * (1 << 31) - F.least(F.col(count), F.lit((1 << 31) - 1))


def spread(counts: DataFrame, nodes: Iterable[Node], day: str = "day") -> DataFrame:
    """Each row once for each of some ``nodes`` that holds its day, with columns ``level`` and ``node`` in place of the day."""
    of: dict[int, list[int]] = {}
    for level, node in nodes:
        of.setdefault(level, []).append(node)
    number = F.datediff(F.col(day), F.lit(_EPOCH))
    place = lambda level: F.shiftright(number, level) if level >= 0 else F.when(number.isNull(), F.lit(UNDATED[1]))
    levels = [F.when(place(level).isin(held), F.lit(level)) for level, held in sorted(of.items())]
    out = counts.withColumn("level", F.explode(F.array_compact(F.array(*levels))))
    shifted = F.expr(f"shiftright(datediff(`{day}`, DATE'1970-01-01'), level)")
    return out.withColumn("node", F.when(F.col("level") < 0, F.lit(UNDATED[1])).otherwise(shifted)).drop(day)


def three_phase_top_k(rows: DataFrame, key: str, count: str, part: list[str], n_parts: int, k: int) -> DataFrame:
    """The ``k`` keys of greatest sum of ``count``, ties by key (nulls first), as (key, count); exact.

    ``rows`` has each key at most once in each of ``n_parts`` parts (columns ``part``). 1: each part's own best ``k`` give
    a sum that at least ``k`` keys reach. 2: a key with less than an ``n_parts``-th of it in every part cannot reach it,
    so only rows from there up are gathered; what a key may have in parts it was not gathered from bounds its sum, and
    those that cannot come up to the k-th best sum so far go. 3: the rest are summed exactly. What is shuffled is each
    task's best rows, rows above the threshold and rows of candidates: the tail of small keys is only scanned.
    """
    slim = rows.select(F.col(key).alias("key"), F.col(count).alias("n"), *part)
    if n_parts <= 0:
        return slim.groupBy("key").agg(F.sum("n").alias("n")).limit(0).select(F.col("key").alias(key), F.col("n").cast("long").alias(count))
    own = Window.partitionBy(*part).orderBy(F.col("n").desc(), F.col("key"))
    tops = slim.withColumn("r", F.row_number().over(own)).where(F.col("r") <= k)  # a partial limit in every task
    order = [F.col("n").desc(), F.col("key").asc_nulls_first()]
    first = [r["n"] for r in top_k(tops.groupBy("key").agg(F.sum("n").alias("n")), k, order).collect()]
    least = first[-1] if len(first) == k else 0
    high = slim.where(F.col("n") * n_parts >= least)
    seen = high.groupBy("key").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
    best = [r["n"] for r in top_k(seen.select("key", "n"), k, order).collect()]
    bar = best[-1] if len(best) == k else 0
    chosen = seen.where(F.col("n") + (n_parts - F.col("parts")) * (F.lit(least) / n_parts) >= bar).select("key")
    known = chosen.count()
    chosen = F.broadcast(chosen) if known <= BROADCAST_CANDIDATES else chosen
    exact = slim.join(chosen.withColumnRenamed("key", "wanted"), F.col("key").eqNullSafe(F.col("wanted")), "left_semi")
    sums = exact.groupBy("key").agg(F.sum("n").cast("long").alias("n"))
    return top_k(sums, k, order).select(F.col("key").alias(key), F.col("n").alias(count))
