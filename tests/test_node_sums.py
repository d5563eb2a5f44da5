"""Node sums from one shuffle by key: against brute force, and the plan that a run writes."""

from __future__ import annotations

import datetime as dt
import random
import uuid
from collections import Counter

from pyspark.sql import functions as F

from circulation import schemas
from circulation.operators import dyadic
from circulation.session import scratch_path
from circulation.sinks import Warehouse

from conftest import plan_text

EPOCH = dt.date(1970, 1, 1)


def _counts(rng):
    days = [None, *(EPOCH + dt.timedelta(days=d) for d in (-5000, -4097, -3, -1, 0, 1, 2, 7, 8, 4095, 4096, 12000, 12001, 12063, 12064))]
    return [(k, d, rng.randrange(1, 9)) for k in ("a", "b", None, "only") for d in (days if k != "only" else [days[3]]) if rng.random() < 0.9]


def _brute(data, wanted=None):
    sums = Counter()
    for key, day, n in data:
        for node in dyadic.holding([day]):
            if wanted is None or node in wanted:
                sums[(key, *node)] += n
    return dict(sums)


def test_node_sums_are_those_of_every_day_of_a_node(spark):
    rng = random.Random(4)
    for tasks in (1, 3):
        data = _counts(rng)
        got = dyadic.node_sums(spark.createDataFrame(data, "k string, day date, n long"), ["k"], "n", tasks).collect()
        found = {(r["k"], r["level"], r["node"]): r["n"] for r in got}
        assert len(found) == len(got) and found == _brute(data)


def test_spread_gives_the_asked_nodes_only(spark):
    data = _counts(random.Random(6))
    wanted = [dyadic.UNDATED, (0, 0), (0, 12000), (3, -1), (6, 187), (12, 0), (12, 2)]
    got = dyadic.spread(spark.createDataFrame(data, "k string, day date, n long"), wanted)
    found = {(r["k"], r["level"], r["node"]): r["n"] for r in got.groupBy("k", "level", "node").agg(F.sum("n").alias("n")).collect()}
    assert found == _brute(data, set(wanted))


def test_order_is_by_node_then_greatest_count(spark):
    data = [(level, node, n) for level, node in [(-1, 0), (0, -5000), (0, 12000), (12, -2), (12, 2)] for n in (1, 7, 2 ** 30)]
    random.Random(2).shuffle(data)
    got = spark.createDataFrame(data, "level int, node int, n long").coalesce(1).sortWithinPartitions(dyadic.node_order("n")).collect()
    assert [tuple(r) for r in got] == sorted(data, key=lambda x: (x[0], x[1], -x[2]))


def test_rows_of_nodes_are_not_shuffled(spark, monkeypatch):
    """A run's loans are shuffled before they become rows of thirteen levels, never after."""
    plans, concrete = [], type(spark.range(1))
    sort = concrete.sortWithinPartitions

    def seen(self, *cols, **kwargs):
        out = sort(self, *cols, **kwargs)
        if "level" in out.columns:
            plans.append(plan_text(out))
        return out

    monkeypatch.setattr(concrete, "sortWithinPartitions", seen)
    wh = Warehouse(spark, f"circ_nodes_{uuid.uuid4().hex[:10]}", scratch_path(spark, "nodes"))
    wh.append("dim_books", spark.createDataFrame([(1, "T", "p", "a"), (2, "U", "p", "a")], schemas.DIM_BOOKS))
    facts = [(f"x{i}", dt.datetime(2018, 5, 1 + i % 9), "t", "c", i % 3, f"g{i % 2}") for i in range(30)]
    wh.replace_run("2018-05-31", spark.createDataFrame(facts, schemas.FACT_LOANS))
    assert len(plans) == 2
    for text in plans:
        above = text[:text.index("Generate")]
        assert "Exchange" not in above, text


def test_both_months_come_from_one_join(spark, tmp_path):
    """The dated inventory source reads the line items once and gives the rows of both months."""
    from circulation.plans import fixtures as fx

    items = [(i, i % 4 if i % 7 else None, i % 3, 1 + i % 7, float(i), None if i % 5 == 0 else dt.datetime(1998, 5 + i % 4, 2), "R", "O") for i in range(40)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz, "
                          "l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(k, f"big ring {k}", None if k == 2 else f"Brand#{k}5", "TYPE", 10 + k * 20) for k in range(4)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    source = fx.inventory_source(spark, str(tmp_path))
    months = fx.inventory(spark, str(tmp_path), 1).unionByName(fx.inventory(spark, str(tmp_path), 2))
    got, want = (sorted((tuple(r) for r in df.collect()), key=repr) for df in (source, months))
    assert got == want and len(got) > 20
    assert source._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1
