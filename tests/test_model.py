"""Builders C1-C7 and the two-batch state rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from circulation import schemas
from circulation.functions import EMPTY_GROUP_ID, day_of_week_sunday0
from circulation.plans import model
from circulation.plans.star import Star, apply_day, apply_month

from conftest import rows


def _inv(spark, data):
    """data: (bibnum, title, itemcount, subjects[, reportdate])"""
    full = []
    for r in data:
        bib, title, count, subjects = r[:4]
        report = r[4] if len(r) > 4 else "2018-05-01T00:00:00.000"
        full.append((bib, title, None, None, "pub", None, None, None, None, report, count, "auth", subjects))
    return spark.createDataFrame(full, schemas.STAGING_INVENTORY)


def _loans(spark, data):
    """data: (id, bibnumber, checkoutdatetime)"""
    return spark.createDataFrame(
        [(i, None, b, None, "t", "c", None, None, None, ts) for i, b, ts in data], schemas.STAGING_LOANS
    )


def test_day_of_week_sunday_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2018, 5, 27),), (dt.date(2018, 5, 28),)], "d date")
    from circulation.constants import FIRST_WEEKDAY_NUMBER

    got = [r[0] for r in df.select(day_of_week_sunday0(F.col("d"))).collect()]
    assert got == [FIRST_WEEKDAY_NUMBER, FIRST_WEEKDAY_NUMBER + 1] == [0, 1]


def test_dim_time_parts(spark):
    loans = _loans(spark, [("1", 1, "2018-05-27T13:00:00.000"), ("2", 1, "2018-05-27T00:00:00.000")])
    out = model.new_dim_time(loans).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.time_key, r.quarter_of_year, r.day_of_week, r.day, r.month, r.year) == (
        dt.datetime(2018, 5, 27), 2, 0, 27, 5, 2018)


def test_dim_time_skips_existing_days(spark):
    loans = _loans(spark, [("1", 1, "2018-05-27T13:00:00.000"), ("2", 1, "2018-05-28T01:00:00.000")])
    first = model.new_dim_time(loans.limit(1))
    again = model.new_dim_time(loans, first)
    assert [r.time_key for r in again.collect()] == [dt.datetime(2018, 5, 28)]


def test_collections_drop_empty_and_null(spark):
    codes = spark.createDataFrame(
        [("a", None, None, None, None, "", None, None), ("b", None, None, None, None, None, None, None),
         ("c", None, None, None, None, "Fiction", None, None)], schemas.STAGING_CODES)
    assert rows(model.dim_collections(codes)) == [("c", "Fiction")]


def test_group_key_of_empty_subjects_and_order(spark):
    inv = _inv(spark, [(1, "t1", 1, ""), (2, "t2", 1, "A,B"), (3, "t3", 1, "B,A")])
    canon = model.canonical_inventory(inv)
    loans = _loans(spark, [("l1", 1, "2018-05-02T10:00:00.000"), ("l2", 2, "2018-05-02T10:00:00.000"),
                           ("l3", 3, "2018-05-02T10:00:00.000"), ("l4", 99, "2018-05-02T10:00:00.000")])
    fact = {r.id: r.subject_group_id for r in model.fact_rows(loans, canon).collect()}
    assert set(fact) == {"l1", "l2", "l3"}  # l4 has no inventory row: dropped
    assert fact["l1"] == EMPTY_GROUP_ID
    assert fact["l2"] != fact["l3"]
    tokens = model.subject_tokens(inv)
    bridge = model.new_bridge(inv, model.new_dim_subject(tokens, spark.createDataFrame([], schemas.DIM_SUBJECT)),
                              spark.createDataFrame([], schemas.BRIDGE_SUBJECT))
    groups = {r.subject_group_id for r in bridge.collect()}
    assert EMPTY_GROUP_ID not in groups and len(groups) == 2


def test_fact_time_key_is_midnight_of_day(spark):
    inv = _inv(spark, [(1, "t", 1, "A")])
    loans = _loans(spark, [("x", 1, "2018-05-02T23:59:59.000")])
    r = model.fact_rows(loans, model.canonical_inventory(inv)).collect()[0]
    assert r.time_key == dt.datetime(2018, 5, 2)


def test_canonical_row_feeds_books_and_fact_alike(spark):
    # Tie on the smallest itemcount: the title tie-break decides, for both outputs.
    inv = _inv(spark, [(1, "Zeta", 2, "Z"), (1, "Alpha", 2, "A"), (1, "Null count", None, "N")])
    canon = model.canonical_inventory(inv)
    books = model.new_dim_books(canon, spark.createDataFrame([], schemas.DIM_BOOKS)).collect()
    assert [b.title for b in books] == ["Alpha"]
    loans = _loans(spark, [("l", 1, "2018-05-02T00:00:00.000")])
    fact = model.fact_rows(loans, canon).collect()[0]
    assert fact.subject_group_id == spark.range(1).select(F.md5(F.lit("A"))).first()[0]


def test_two_months_first_writer_wins_and_stable_ids(spark):
    star = Star.empty(spark)
    m1 = _inv(spark, [(1, "Old", 1, "A,B")])
    m2 = _inv(spark, [(1, "New", 1, "A,C"), (2, "Other", 1, "A,B")])
    star = apply_month(star, m1)
    ids_1 = dict(rows(star.dim_subject))
    star = apply_month(star, m2)
    ids_2 = dict(rows(star.dim_subject))
    assert ids_1 == {"A": 1, "B": 2}
    assert ids_2 == {"A": 1, "B": 2, "C": 3}
    assert rows(star.dim_books, "bibnum", "title") == [(1, "Old"), (2, "Other")]
    bridge = rows(star.bridge_subject, "subjects_string", "subject_id")
    # "A,B" bridged once (month 1), "A,C" added in month 2.
    assert bridge == [("A,B", 1), ("A,B", 2), ("A,C", 1), ("A,C", 3)]


def test_daily_loads_use_latest_month(spark):
    star = apply_month(Star.empty(spark), _inv(spark, [(1, "t", 1, "A")]))
    star = apply_day(star, _loans(spark, [("l1", 1, "2018-05-02T00:00:00.000"), ("l2", 2, "2018-05-02T00:00:00.000")]))
    star = apply_month(star, _inv(spark, [(2, "u", 1, "B")]))
    star = apply_day(star, _loans(spark, [("l3", 1, "2018-05-03T00:00:00.000"), ("l4", 2, "2018-05-03T00:00:00.000")]))
    assert sorted(r.id for r in star.fact_loans.collect()) == ["l1", "l4"]
    assert star.dim_time.count() == 2


def test_repeated_tokens_count_twice(spark):
    inv = _inv(spark, [(1, "t", 1, "A,A")])
    assert [r.subject for r in model.subject_tokens(inv).collect()] == ["A", "A"]
