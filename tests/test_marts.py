"""Marts C8-C11: range bounds, gap fill, NULL subject, pre-aggregation parity."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from circulation import schemas
from circulation.functions import EMPTY_GROUP_ID
from circulation.plans import marts

from conftest import rows


def _fact(spark, data):
    """data: (id, day, bibnumber, group)"""
    return spark.createDataFrame(
        [(i, dt.datetime(d.year, d.month, d.day), "t", "c", b, g) for i, d, b, g in data], schemas.FACT_LOANS
    )


D = dt.date


def test_range_is_inclusive_both_ends(spark):
    fact = _fact(spark, [("a", D(2020, 1, 1), 1, "g"), ("b", D(2020, 1, 2), 1, "g"),
                         ("c", D(2020, 1, 5), 1, "g"), ("d", D(2020, 1, 6), 1, "g")])
    assert marts.in_range(fact, "2020-01-02", "2020-01-05").count() == 2


def test_date_bounds(spark):
    fact = _fact(spark, [("a", D(2020, 1, 1), 1, "g"), ("b", D(2020, 3, 2), 1, "g")])
    r = marts.date_bounds(fact).first()
    assert (r.min_date, r.max_date) == (dt.datetime(2020, 1, 1), dt.datetime(2020, 3, 2))


def test_loans_per_day_fills_gaps_only_inside_data(spark):
    fact = _fact(spark, [("a", D(2020, 1, 1), 1, "g"), ("b", D(2020, 1, 1), 1, "g"), ("c", D(2020, 1, 3), 1, "g")])
    out = rows(marts.loans_per_day(fact, "2019-12-30", "2020-01-10"))
    assert out == [(D(2020, 1, 1), 2), (D(2020, 1, 2), 0), (D(2020, 1, 3), 1)]
    cut = rows(marts.loans_per_day(fact, "2020-01-02", "2020-01-03"))
    assert cut == [(D(2020, 1, 2), 0), (D(2020, 1, 3), 1)]


def _bridge(spark, data):
    return spark.createDataFrame(data, schemas.BRIDGE_SUBJECT)


def _subjects(spark, data):
    return spark.createDataFrame(data, schemas.DIM_SUBJECT)


def test_popular_subjects_counts_null_subject_for_groups_without_bridge(spark):
    fact = _fact(spark, [("a", D(2020, 1, 1), 1, "g1"), ("b", D(2020, 1, 1), 2, EMPTY_GROUP_ID),
                         ("c", D(2020, 1, 1), 3, EMPTY_GROUP_ID), ("d", D(2020, 1, 1), 4, "g2")])
    bridge = _bridge(spark, [("g1", 1, "A,B"), ("g1", 2, "A,B"), ("g2", 1, "A")])
    subjects = _subjects(spark, [("A", 1), ("B", 2)])
    for pre in (True, False):
        out = [tuple(r) for r in marts.popular_subjects(fact, bridge, subjects, preaggregate=pre).collect()]
        assert out == [(None, 2), ("A", 2), ("B", 1)]


def test_popular_titles_merge_books_with_one_title(spark):
    fact = _fact(spark, [("a", D(2020, 1, 1), 1, "g"), ("b", D(2020, 1, 1), 2, "g"), ("c", D(2020, 1, 1), 3, "g")])
    books = spark.createDataFrame([(1, "Same", "p", "a"), (2, "Same", "p", "a"), (3, "Other", "p", "a")],
                                  schemas.DIM_BOOKS)
    for pre in (True, False):
        assert [tuple(r) for r in marts.popular_titles(fact, books, preaggregate=pre).collect()] == [
            ("Same", 2), ("Other", 1)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["g1", "g2", "g3", None]), st.integers(1, 4)),
                min_size=1, max_size=30))
def test_preaggregated_marts_equal_plain(spark, data):
    fact = _fact(spark, [(str(i), D(2020, 1, 1 + d), b, g) for i, (d, g, b) in enumerate(data)])
    bridge = _bridge(spark, [("g1", 1, "x"), ("g1", 2, "x"), ("g2", 2, "y"), ("g2", 2, "y")])
    subjects = _subjects(spark, [("A", 1), ("B", 2)])
    books = spark.createDataFrame([(1, "T1", "p", "a"), (2, "T1", "p", "a"), (3, None, "p", "a")], schemas.DIM_BOOKS)
    lo, hi = "2020-01-02", "2020-01-08"
    assert rows(marts.popular_subjects(fact, bridge, subjects, lo, hi, k=3, preaggregate=True)) == rows(
        marts.popular_subjects(fact, bridge, subjects, lo, hi, k=3, preaggregate=False))
    assert rows(marts.popular_titles(fact, books, lo, hi, k=2, preaggregate=True)) == rows(
        marts.popular_titles(fact, books, lo, hi, k=2, preaggregate=False))
    in_range = sum(1 for d, _, _ in data if 1 <= d <= 7)
    daily = marts.loans_per_day(fact, lo, hi)
    assert sum(r["count"] for r in daily.collect()) == in_range


def test_empty_range_gives_empty_frames_with_schema(spark):
    fact = _fact(spark, [("a", D(2020, 1, 1), 1, "g")])
    bridge = _bridge(spark, [("g", 1, "A")])
    subjects = _subjects(spark, [("A", 1)])
    books = spark.createDataFrame([(1, "T", "p", "a")], schemas.DIM_BOOKS)
    lo, hi = "2021-01-01", "2021-12-31"
    per_day = marts.loans_per_day(fact, lo, hi)
    assert per_day.columns == ["date", "count"] and per_day.count() == 0
    top = marts.popular_subjects(fact, bridge, subjects, lo, hi)
    assert top.columns == ["subject", "count"] and top.count() == 0
    titles = marts.popular_titles(fact, books, lo, hi)
    assert titles.columns == ["title", "loan_numbers"] and titles.count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["g1", "g2", "g3", None]), st.integers(1, 4)),
                min_size=1, max_size=30))
def test_one_pass_refresh_equals_the_three_marts(spark, data):
    fact = _fact(spark, [(str(i), D(2020, 1, 1 + d), b, g) for i, (d, g, b) in enumerate(data)])
    bridge = _bridge(spark, [("g1", 1, "x"), ("g1", 2, "x"), ("g2", 2, "y")])
    subjects = _subjects(spark, [("A", 1), ("B", 2)])
    books = spark.createDataFrame([(1, "T1", "p", "a"), (2, "T1", "p", "a"), (3, None, "p", "a")], schemas.DIM_BOOKS)
    lo, hi = "2020-01-02", "2020-01-08"
    got = marts.refresh(fact, bridge, subjects, books, lo, hi)
    assert rows(got["loans_per_day"]) == rows(marts.loans_per_day(fact, lo, hi))
    assert rows(got["popular_subjects"]) == rows(marts.popular_subjects(fact, bridge, subjects, lo, hi))
    assert rows(got["popular_titles"]) == rows(marts.popular_titles(fact, books, lo, hi))
