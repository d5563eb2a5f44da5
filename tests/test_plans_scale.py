"""Plan shapes that matter at scale, and a hot-key fixture checked against brute force."""

from __future__ import annotations

import datetime as dt
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from circulation import schemas
from circulation.plans import jobs, marts, model
from circulation.session import scratch_path
from circulation.sinks import CANONICAL, Warehouse
from circulation.sources import extract_window, land_typed, read_landed
from circulation.sources.landing import StampAfterRunError

from conftest import plan_text


def _final(df) -> str:
    df.collect()
    return plan_text(df).split("== Initial Plan ==")[0]


_SAVED: dict[str, str] = {}
_KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def _no_broadcast(spark):
    for k in _KEYS:
        _SAVED[k] = spark.conf.get(k)
        spark.conf.set(k, "-1")


def _restore_broadcast(spark):
    for k in _KEYS:
        spark.conf.set(k, _SAVED[k])


def _hot_inventory(spark, n_books=60, hot_copies=120):
    """Book 0 holds a third of all rows; a third of the subjects strings are one string."""
    rows = []
    for i in range(hot_copies):
        rows.append((0, f"Hot {i % 3}", None, None, "p", None, None, None, None, "2018-05-01T00:00:00.000",
                     (i % 5) or None, "a", "Fiction,Drama"))
    for b in range(1, n_books):
        for c in range(4):
            subjects = "Fiction,Drama" if b % 3 == 0 else f"S{b % 7},T{c % 2}"
            rows.append((b, f"Book {b}", None, None, "p", None, None, None, None, "2018-05-01T00:00:00.000",
                         c + 1, "a", subjects if b % 11 else ""))
    return spark.createDataFrame(rows, schemas.STAGING_INVENTORY)


def _hot_loans(spark, n=900):
    rows = []
    for i in range(n):
        book = 0 if i % 3 == 0 else (i % 70)  # a third of all loans on book 0; books >= 60 unheld
        day = dt.datetime(2018, 5, 1) + dt.timedelta(days=i % 20)
        rows.append((f"l{i}", 2018, book, None, "t", "c", None, None, None, day.strftime("%Y-%m-%dT%H:%M:%S.000")))
    return spark.createDataFrame(rows, schemas.STAGING_LOANS)


def test_hot_keys_against_brute_force(spark):
    inv, loans = _hot_inventory(spark), _hot_loans(spark)
    canonical = model.canonical_inventory(inv)
    fact = model.fact_rows(loans, canonical)
    tokens = model.subject_tokens(inv)
    dim_subject = model.new_dim_subject(tokens, spark.createDataFrame([], schemas.DIM_SUBJECT))
    bridge = model.new_bridge(inv, dim_subject, spark.createDataFrame([], schemas.BRIDGE_SUBJECT))

    # Brute force in Python over the same rows.
    inv_rows = inv.collect()
    best = {}
    for r in inv_rows:
        key = (r.itemcount is None, r.itemcount or 0, r.title, r.publisher, r.author, r.subjects)
        if r.bibnum not in best or key < best[r.bibnum][0]:
            best[r.bibnum] = (key, r)
    held = {b: v[1] for b, v in best.items()}
    expected = Counter()
    for l in loans.collect():
        if l.bibnumber in held:
            subjects = held[l.bibnumber].subjects
            for token in (subjects.split(",") if subjects else [None]):
                expected[token] += 1
    got = {r.subject: r["count"] for r in marts.popular_subjects(fact, bridge, dim_subject, k=1000).collect()}
    assert got == dict(expected)
    assert fact.count() == sum(1 for l in loans.collect() if l.bibnumber in held)


def test_popular_subjects_aggregates_before_bridge_join(spark):
    fact = spark.createDataFrame(
        [(str(i), dt.datetime(2020, 1, 1 + i % 5), "t", "c", i % 4, f"g{i % 3}") for i in range(50)],
        schemas.FACT_LOANS)
    bridge = spark.createDataFrame([("g0", 1, "x"), ("g1", 2, "y")], schemas.BRIDGE_SUBJECT)
    subjects = spark.createDataFrame([("A", 1), ("B", 2)], schemas.DIM_SUBJECT)
    final = _final(marts.popular_subjects(fact, bridge, subjects))
    join_at = final.find("Join")
    # The per-group partial aggregate sits below (printed after) the first join.
    assert "partial_count" in final[join_at:]
    assert "TakeOrderedAndProject" in final


def _loaded(spark):
    wh = Warehouse(spark, f"circ_p_{uuid.uuid4().hex[:10]}", scratch_path(spark, "plans"))
    inv, loans = _hot_inventory(spark), _hot_loans(spark)
    codes = spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES)
    jobs.run_monthly(wh, inv, codes, "2018-04-30", "2018-05-31")
    for day in range(1, 7):  # runs (04-30, 05-01] ... (05-05, 05-06]
        hi = dt.date(2018, 5, day)
        jobs.run_daily(wh, loans, hi - dt.timedelta(days=1), hi)
    return wh


def test_stored_marts_prune_and_read_buckets(spark):
    wh = _loaded(spark)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    fact, days = wh.scan("fact_loans"), wh.load_days()
    plan = _final(marts.in_range(fact, "2018-05-02", "2018-05-03", days))
    assert "load_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [IsNotNull(time_key), GreaterThanOrEqual(time_key" in plan
    # The calendar and the daily counts come from the summary: the fact is not scanned.
    for df in (marts.loans_per_day(fact, "2018-05-02", "2018-05-03", days), marts.date_bounds(fact, days)):
        assert "fact_loans/" not in _final(df) and "fact_load_days" in _final(df)

    _no_broadcast(spark)
    try:
        plan = _final(marts.popular_subjects(fact, wh.scan("bridge_subject"), wh.scan("dim_subject"), k=5))
    finally:
        _restore_broadcast(spark)
    # No exchange directly above the bucketed bridge scan.
    lines = plan.splitlines()
    i = next(k for k, line in enumerate(lines) if "bridge_subject" in line and "FileScan" in line)
    assert "Bucketed: true" in lines[i]
    assert "Exchange" not in lines[i - 1] and "Exchange" not in lines[i - 2]


def test_fact_join_on_the_stored_table_splits_a_hot_book(spark):
    wh = Warehouse(spark, f"circ_p_{uuid.uuid4().hex[:10]}", scratch_path(spark, "skew"))
    books = spark.range(2000).selectExpr("id AS bibnum", "'t' AS title", "'p' AS publisher", "'a' AS author", "'s' AS subjects")
    wh.replace(CANONICAL, books)
    loans = spark.range(0, 400_000, 1, 8).selectExpr(
        "cast(id AS string) AS id", "2018 AS checkoutyear", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 2000 END AS bibnumber",
        "uuid() AS itemtype", "'c' AS collection", "'2018-05-01T00:00:00.000' AS checkoutdatetime")
    wanted = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    _no_broadcast(spark)
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        fact = model.fact_rows(loans, wh.scan(CANONICAL))
        n = fact.groupBy("subject_group_id").count()
        assert n.collect()[0]["count"] == 400_000
        plan = plan_text(n)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        _restore_broadcast(spark)
    assert "SortMergeJoin(skew=true)" in plan


def test_bridge_drops_known_groups_before_it_explodes(spark):
    inv = _hot_inventory(spark)
    dim = spark.createDataFrame([("Fiction", 1)], schemas.DIM_SUBJECT)
    bridge = spark.createDataFrame([("g0", 1, "x")], schemas.BRIDGE_SUBJECT)
    plan = _final(model.new_bridge(inv, dim, bridge))
    # Children are printed after their parents: the anti join lies under the explode.
    assert plan.index("Generate explode") < plan.index("LeftAnti")


def test_daily_extract_prunes_the_typed_landing(spark):
    root, loans = scratch_path(spark, "typed"), _hot_loans(spark)
    blank = loans.limit(1).withColumn("id", F.lit("blank")).withColumn("checkoutdatetime", F.lit(""))
    for lo, hi in (("2018-04-30", "2018-05-10"), ("2018-05-10", "2018-05-20")):
        land_typed(extract_window(loans, "checkoutdatetime", lo, hi).unionByName(blank), root, "loans", hi, "checkoutdatetime")
    landed = read_landed(spark, root, "loans", schemas.STAGING_LOANS, "checkoutdatetime")
    part = extract_window(landed, "checkoutdatetime", "2018-05-12", "2018-05-14", schemas.STAGING_LOANS.fieldNames())
    plan = _final(part)
    assert "run_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThan(checkoutdatetime_ts" in pushed and "LessThanOrEqu" in pushed  # the plan text is cut here
    want = extract_window(loans, "checkoutdatetime", "2018-05-12", "2018-05-14")
    assert part.count() == want.count() > 0
    with pytest.raises(StampAfterRunError, match="stamped after"):
        land_typed(loans, root, "loans", "2018-05-02", "checkoutdatetime")
