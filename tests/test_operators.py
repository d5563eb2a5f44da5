"""Golden tests for the generic operators (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from circulation import schemas
from circulation.operators import align_to_calendar, assign_ids, date_spine, explode_tokens, first_per_key, only_new, top_k
from circulation.plans.model import canonical_order

from conftest import plan_text, rows


def _tokens(spark, values, keep=False, **kw):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    out = explode_tokens(df, "s", "t", keep=keep, **kw)
    return [(r.s, r.t) for r in out.collect()]


def test_split_docstring_example(spark):
    assert [t for _, t in _tokens(spark, ["A,B,C,D,E"])] == ["A", "B", "C", "D", "E"]


def test_split_keeps_blanks_empties_and_repeats(spark):
    assert [t for _, t in _tokens(spark, ["A, B"])] == ["A", " B"]
    assert [t for _, t in _tokens(spark, ["A,,A"])] == ["A", "", "A"]
    assert [t for _, t in _tokens(spark, ["A,"])] == ["A", ""]


def test_split_missing_values_give_no_rows(spark):
    assert _tokens(spark, [None, ""]) == []


def test_split_keep_emits_whole_value_first(spark):
    assert _tokens(spark, ["A,B"], keep=True) == [("A,B", "A,B"), ("A,B", "A"), ("A,B", "B")]
    assert _tokens(spark, ["A"], keep=True) == [("A", "A")]


def test_split_options(spark):
    assert [t for _, t in _tokens(spark, ["A, B,A"], trim=True, dedupe=True)] == ["A", "B"]
    assert _tokens(spark, ["NA", "x"], na_values=["NA"]) == [("x", "x")]


def test_split_separator_is_literal(spark):
    df = spark.createDataFrame([("a|b.c",)], "s string")
    assert [r.t for r in explode_tokens(df, "s", "t", sep="|").collect()] == ["a", "b.c"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab, ", max_size=8), max_size=6))
def test_explode_count_equals_sum_of_split_sizes(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    expected = sum(len(v.split(",")) for v in values if v)
    assert explode_tokens(df, "s", "t").count() == expected


def test_first_per_key_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, "n"), (1, 5, "five"), (1, 2, "two"), (2, None, "only")],
        "bibnum long, itemcount int, title string",
    )
    out = first_per_key(df, ["bibnum"], [F.col("itemcount").asc_nulls_last(), F.col("title").asc_nulls_first()])
    assert rows(out, "bibnum", "title") == [(1, "two"), (2, "only")]


def test_first_per_key_plans_partial_limit_before_shuffle(spark):
    df = spark.range(100).selectExpr("id % 7 AS bibnum", "CAST(id AS INT) AS itemcount", "'t' AS title",
                                     "'p' AS publisher", "'a' AS author", "'s' AS subjects")
    out = first_per_key(df, ["bibnum"], canonical_order())
    out.collect()
    plan = plan_text(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.count() == 7


def test_only_new_is_left_anti_and_ignores_null_keys(spark):
    cand = spark.createDataFrame([("A",), ("B",), (None,)], "subject string")
    existing = spark.createDataFrame([("A",)], "subject string")
    out = only_new(cand, existing, "subject")
    assert rows(out) == [("B",), (None,)]
    out.collect()
    assert "LeftAnti" in plan_text(out)


def test_assign_ids_dense_in_key_order_across_partitions(spark):
    members = spark.range(0, 500).selectExpr("concat('s', lpad(CAST(id AS STRING), 4, '0')) AS subject").repartition(7)
    out = assign_ids(members, "subject", "subject_id")
    got = sorted((r.subject, r.subject_id) for r in out.collect())
    assert got == [(f"s{i:04d}", i + 1) for i in range(500)]


def test_assign_ids_continue_after_existing_max(spark):
    existing = spark.createDataFrame([("A", 1), ("Z", 7)], schemas.DIM_SUBJECT)
    new = spark.createDataFrame([("C",), ("B",)], "subject string")
    out = assign_ids(new, "subject", "subject_id", existing)
    assert rows(out) == [("B", 8), ("C", 9)]


def test_assign_ids_empty(spark):
    existing = spark.createDataFrame([("A", 3)], schemas.DIM_SUBJECT)
    new = spark.createDataFrame([], "subject string")
    assert assign_ids(new, "subject", "subject_id", existing).count() == 0


def test_assign_ids_single_partition_step_is_only_the_offset_table(spark):
    members = spark.range(0, 300).selectExpr("CAST(id AS STRING) AS subject")
    existing = spark.createDataFrame([("x", 10)], schemas.DIM_SUBJECT)
    out = assign_ids(members, "subject", "subject_id", existing)
    out.collect()
    final = plan_text(out).split("== Initial Plan ==")[0]
    # One single-partition step, over one row per partition of the new members and of the
    # existing ids.
    assert final.count("Exchange SinglePartition") == 1
    assert "BroadcastHashJoin" in final


def test_date_spine_and_gap_fill(spark):
    bounds = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2020, 1, 3))], "lo date, hi date")
    spine = date_spine(bounds)
    counts = spark.createDataFrame([(dt.date(2020, 1, 1), 4), (dt.date(2020, 1, 3), 2)], "date date, count long")
    out = align_to_calendar(spine, counts, "date", ["count"])
    assert rows(out) == [(dt.date(2020, 1, 1), 4), (dt.date(2020, 1, 2), 0), (dt.date(2020, 1, 3), 2)]


def test_top_k_total_order_and_plan(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), (None, 3), ("c", 1)], "k string, n long")
    out = top_k(df, 2, [F.col("n").desc(), F.col("k").asc_nulls_first()])
    assert [tuple(r) for r in out.collect()] == [(None, 3), ("a", 3)]
    assert "TakeOrderedAndProject" in plan_text(out)


@settings(max_examples=12, deadline=None)
@given(st.sets(st.text(alphabet="abcXY ,", min_size=0, max_size=5), max_size=40),
       st.integers(0, 1000), st.integers(1, 9))
def test_assign_ids_property_dense_after_max(spark, members, base, parts):
    existing = spark.createDataFrame([("zz-existing", base)], schemas.DIM_SUBJECT)
    new = spark.createDataFrame([(m,) for m in members], "subject string").repartition(parts)
    got = sorted((r.subject_id, r.subject) for r in assign_ids(new, "subject", "subject_id", existing).collect())
    want = [(base + i + 1, m) for i, m in enumerate(sorted(members, key=lambda x: x.encode()))]
    assert got == want
