"""Sources, sinks, quality gate and the two jobs."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation import schemas
from circulation.plans import jobs, marts
from circulation.plans.quality import (
    Check,
    QualityError,
    duplicate_check,
    enforce,
    orphan_check,
    row_count_checks,
    scalar_checks,
)
from circulation.session import scratch_path
from circulation.sinks import Warehouse, write_delimited
from circulation.sources import EmptyExtractError, extract_size, extract_window, read_delimited, union_slices

from conftest import rows


def test_delimited_round_trip_awkward_text(spark):
    values = ['a|b "q" \\x', " B ", "line1\nline2", "cr\rhere", '"', "", None, "tail,"]
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    path = scratch_path(spark, "rt")
    write_delimited(df, path)
    back = dict(rows(read_delimited(spark, path, schema)))
    assert back == {i: ("" if v is None else v) for i, v in enumerate(values)}


def test_delimited_binds_columns_by_position(spark):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    df = spark.createDataFrame([("x", 1)], "other string, name long")
    path = scratch_path(spark, "pos")
    write_delimited(df, path)
    assert rows(read_delimited(spark, path, schema)) == [("x", 1)]


def test_window_is_left_open_right_closed(spark):
    d1, d2 = dt.datetime(2018, 5, 20), dt.datetime(2018, 5, 21)
    stamps = [d1, d1 + dt.timedelta(seconds=1), d2, d2 + dt.timedelta(seconds=1)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, ts timestamp_ntz")
    assert [r.i for r in extract_window(df, "ts", "2018-05-20", "2018-05-21").collect()] == [1, 2]
    text = spark.createDataFrame([(i, s.strftime("%Y-%m-%dT%H:%M:%S.000")) for i, s in enumerate(stamps)],
                                 "i int, ts string")
    assert [r.i for r in extract_window(text, "ts", "2018-05-20", "2018-05-21").collect()] == [1, 2]
    assert extract_size(text, "ts", "2018-05-20", "2018-05-21").first().rows == 2


def test_extract_declared_order_and_missing_column(spark):
    df = spark.createDataFrame([(1, dt.datetime(2018, 5, 21))], "a int, ts timestamp_ntz")
    assert extract_window(df, "ts", "2018-05-20", "2018-05-21", ["ts", "a"]).columns == ["ts", "a"]
    with pytest.raises(Exception):
        extract_window(df, "ts", "2018-05-20", "2018-05-21", ["nope"]).collect()


def test_union_slices_is_bag_union(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    assert union_slices([a, a]).count() == 4


def test_quality_gate_runs_all_then_raises(spark):
    full = spark.range(3)
    empty = spark.range(0)
    checks = row_count_checks({"a": full, "b": empty, "c": full, "d": full})
    got = rows(checks)
    assert got == [("a", 3, True), ("b", 0, False), ("c", 3, True), ("d", 3, True)]
    with pytest.raises(QualityError, match="b"):
        enforce(checks)


def _wh(spark):
    return Warehouse(spark, f"circ_t_{uuid.uuid4().hex[:10]}", scratch_path(spark, "wh"))


def test_warehouse_replace_append_drop(spark):
    wh = _wh(spark)
    wh.create_all()
    rows_a = spark.createDataFrame([("c1", "Fiction")], schemas.DIM_COLLECTIONS)
    assert wh.replace("dim_collections", rows_a) == 1
    assert wh.replace("dim_collections", rows_a) == 1
    assert wh.row_count("dim_collections") == 1
    assert wh.append("dim_collections", rows_a) == 1
    assert wh.row_count("dim_collections") == 2
    wh.drop("dim_collections")
    assert "dim_collections" not in wh.tables() and wh.row_count("dim_collections") == 0
    wh.drop_all()
    assert wh.tables() == []


def _inventory_rows(spark):
    data = [
        (1, "Book one", "2018-05-01T00:00:00.000", 3, "A,B"),
        (1, "Book one b", "2018-05-01T00:00:00.000", 1, "A, B"),
        (2, "Book two", "2018-05-15T00:00:00.000", None, ""),
        (3, "Book three", "2018-05-31T00:00:00.000", 2, "C"),
        (5, "Previous run", "2018-04-30T00:00:00.000", 1, "E"),
        (1, "Renamed", "2018-06-01T00:00:00.000", 1, "A,C"),
        (4, "Book four", "2018-06-01T00:00:00.000", 1, "C,D"),
    ]
    return spark.createDataFrame(
        [(b, t, None, "c. 2005", "pub", None, None, None, None, r, n, "auth", s) for b, t, r, n, s in data],
        schemas.STAGING_INVENTORY)


def _loan_rows(spark):
    data = [("l1", 1, "2018-05-31T00:00:00.000"), ("l2", 2, "2018-05-31T10:00:00.000"),
            ("l3", 9, "2018-05-31T11:00:00.000"), ("l4", 4, "2018-06-01T00:00:00.000"),
            ("l5", 1, "2018-06-01T09:00:00.000"), ("l6", 3, "2018-06-01T23:00:00.000")]
    return spark.createDataFrame([(i, 2018, b, None, "t", "c", None, None, None, ts) for i, b, ts in data],
                                 schemas.STAGING_LOANS)


def test_jobs_two_months_with_landing_and_rerun(spark):
    wh = _wh(spark)
    landing = scratch_path(spark, "landing")
    inv, loans = _inventory_rows(spark), _loan_rows(spark)
    codes = spark.createDataFrame([("a", None, None, None, None, "Fiction", None, None)], schemas.STAGING_CODES)

    checks = jobs.run_monthly(wh, inv, codes, "2018-04-30", "2018-05-31", landing=landing)
    assert all(p for _, _, p in checks)
    # May: books 1 (canonical "Book one b", itemcount 1), 2 and 3.
    assert rows(wh.scan("dim_books"), "bibnum", "title") == [(1, "Book one b"), (2, "Book two"), (3, "Book three")]
    assert rows(wh.scan("dim_subject")) == [(" B", 1), ("A", 2), ("B", 3), ("C", 4)]

    # Day window (05-30, 05-31]: l1 (midnight of 05-31) is in; l3 has no book.
    assert jobs.run_daily(wh, loans, "2018-05-30", "2018-05-31", landing=landing) == 1
    # Re-running the same day replaces its partition instead of duplicating it.
    assert jobs.run_daily(wh, loans, "2018-05-30", "2018-05-31", landing=landing) == 1
    assert wh.row_count("fact_loans") == 1

    jobs.run_monthly(wh, inv, codes, "2018-05-31", "2018-06-30", landing=landing)
    assert rows(wh.scan("dim_books"), "bibnum", "title")[0] == (1, "Book one b")  # first writer wins
    assert rows(wh.scan("dim_subject"))[-1] == ("D", 5)
    jobs.run_daily(wh, loans, "2018-05-31", "2018-06-30", landing=landing)
    # The June run sees l2, l3 (05-31 after midnight) and l4-l6; only books 1 and 4 are in
    # the June inventory, so l2 (book 2), l3 (book 9) and l6 (book 3) are dropped.
    assert sorted(r.id for r in wh.scan("fact_loans").collect()) == ["l1", "l4", "l5"]
    assert wh.row_count("dim_time") == 2
    assert "staging_loans" not in wh.tables()
    top = [tuple(r) for r in marts.popular_subjects(wh.scan("fact_loans"), wh.scan("bridge_subject"),
                                                      wh.scan("dim_subject")).collect()]
    # l1 -> "A, B" (May canonical), l4 -> "C,D", l5 -> "A,C" (June canonical).
    assert top[:2] == [("A", 2), ("C", 2)]


def test_empty_extract_raises_unless_allowed(spark):
    wh = _wh(spark)
    loans = _loan_rows(spark)
    with pytest.raises(EmptyExtractError):
        jobs.run_daily(wh, loans, "2019-01-01", "2019-01-02")
    inv = _inventory_rows(spark)
    codes = spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES)
    jobs.run_monthly(wh, inv, codes, "2018-04-30", "2018-05-31")
    assert jobs.run_daily(wh, loans, "2019-01-01", "2019-01-02", allow_empty=True) == 0


def test_daily_catchup_stream_loads_each_run_date_once(spark):
    from circulation.streaming import start_daily_catchup

    wh = _wh(spark)
    inv, loans = _inventory_rows(spark), _loan_rows(spark)
    codes = spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES)
    jobs.run_monthly(wh, inv, codes, "2018-05-31", "2018-06-30")  # June: books 1 and 4
    landing = scratch_path(spark, "stream-landing")
    for lo, hi in [("2018-05-30", "2018-05-31"), ("2018-05-31", "2018-06-01"), ("2018-06-01", "2018-06-02")]:
        write_delimited(extract_window(loans, "checkoutdatetime", lo, hi), f"{landing}/run_date={hi}")
    ckpt = scratch_path(spark, "stream-ckpt")
    q = start_daily_catchup(wh, landing, ckpt, max_files_per_trigger=1)
    q.awaitTermination(300)
    first = sorted((r.id, str(r.load_date)) for r in wh.scan("fact_loans").collect())
    # l1 at 05-31 00:00 belongs to run 05-31, l4 at 06-01 00:00 to run 06-01, l5 (06-01 09:00)
    # to run 06-02; l6's book 3 is not held in June.
    assert first == [("l1", "2018-05-31"), ("l4", "2018-06-01"), ("l5", "2018-06-02")]
    # Restarting finds nothing new; a replayed run date would rewrite, not duplicate.
    start_daily_catchup(wh, landing, ckpt).awaitTermination(300)
    assert wh.row_count("fact_loans") == 3
    assert wh.row_count("dim_time") == 2


def test_day_parse_strict_raises_and_lenient_gives_null(spark):
    from circulation.functions import day_of

    df = spark.createDataFrame([("2018-05-27T10:00:00.000",), ("not a date",)], "s string")
    lenient = [r[0] for r in df.select(day_of("s", strict=False)).collect()]
    assert lenient == [dt.date(2018, 5, 27), None]
    with pytest.raises(Exception):
        df.select(day_of("s")).collect()


def test_malformed_delimited_row_fails_the_read(spark):
    path = scratch_path(spark, "bad")
    spark.createDataFrame([("n|s",), ("1|ok",), ("x|bad",)], "line string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    with pytest.raises(Exception):
        read_delimited(spark, path, schema).collect()


def test_monthly_na_values_only_affect_the_split(spark):
    wh = _wh(spark)
    inv = spark.createDataFrame(
        [(1, "t", None, None, "p", None, None, None, None, "2018-05-01T00:00:00.000", 1, "a", "NA"),
         (2, "u", None, None, "p", None, None, None, None, "2018-05-01T00:00:00.000", 1, "a", "X")],
        schemas.STAGING_INVENTORY)
    codes = spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES)
    jobs.run_monthly(wh, inv, codes, "2018-04-30", "2018-05-31", na_values=["NA"])
    assert rows(wh.scan("dim_subject")) == [("X", 1)]
    assert wh.row_count("dim_books") == 2


def test_warehouse_reattaches_after_a_new_catalog_and_drop_deletes_rows(spark):
    location = scratch_path(spark, "attach")
    first = Warehouse(spark, f"circ_a_{uuid.uuid4().hex[:10]}", location)
    facts = spark.createDataFrame(
        [("a", dt.datetime(2020, 1, 1), "t", "c", 1, "g", dt.date(2020, 1, 1)),
         ("b", dt.datetime(2020, 1, 2), "t", "c", 1, "g", dt.date(2020, 1, 2))],
        first.schema_of("fact_loans"))
    for day in (1, 2):
        first.replace_run(f"2020-01-0{day}", facts.where(f"load_date = '2020-01-0{day}'"))
    first.append("dim_books", spark.createDataFrame([(1, "T", "p", "a")], schemas.DIM_BOOKS))
    # Another database name over the same files stands in for a fresh session's catalog.
    second = Warehouse(spark, f"circ_b_{uuid.uuid4().hex[:10]}", location)
    second.create_all()
    assert second.row_count("fact_loans") == 2 and second.row_count("dim_books") == 1
    redo = facts.where("id = 'b'").withColumn("itemtype", F.lit("u"))
    assert second.replace_run("2020-01-02", redo) == 1
    assert rows(second.scan("fact_loans"), "id", "itemtype") == [("a", "t"), ("b", "u")]
    # The first catalog sees what the second wrote, run dates it has never heard of included.
    second.replace_run("2020-01-03", facts.where("id = 'a'"))
    assert first.row_count("fact_loans") == 3
    assert rows(first.load_days(), "loans") == [(1,), (1,), (1,)]
    # A corrected run without facts leaves none; its summary says so.
    assert second.replace_run("2020-01-03", facts.where("false")) == 0
    assert first.row_count("fact_loans") == 2
    assert sorted((str(r.day), r.loans, str(r.load_date)) for r in second.load_days().collect()) == [
        ("2020-01-01", 1, "2020-01-01"), ("2020-01-02", 1, "2020-01-02"), ("None", 0, "2020-01-03")]
    second.drop_all()
    third = Warehouse(spark, f"circ_c_{uuid.uuid4().hex[:10]}", location)
    third.create_all()
    assert third.row_count("fact_loans") == 0 and third.row_count("dim_books") == 0


def test_attaching_never_deletes(spark):
    """Facts at a location without a layout record stay when a process attaches."""
    location = scratch_path(spark, "no-layout")
    day = spark.createDataFrame([("a", dt.datetime(2020, 1, 1), "t", "c", 1, "g")], schemas.FACT_LOANS)
    day.write.parquet(f"{location}/fact_loans/load_date=2020-01-01")
    wh = Warehouse(spark, f"circ_n_{uuid.uuid4().hex[:10]}", location)
    assert wh.row_count("fact_loans") == 1
    assert [tuple(r)[:2] for r in wh.load_days().collect()] == [(dt.date(2020, 1, 1), 1)]


def test_empty_extracts_change_nothing(spark):
    wh = _wh(spark)
    inv, loans = _inventory_rows(spark), _loan_rows(spark)
    codes = spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES)
    jobs.run_monthly(wh, inv, codes, "2018-04-30", "2018-05-31")
    for no_codes, window in ((codes.where("false"), ("2018-05-31", "2018-06-30")), (codes, ("2019-01-01", "2019-02-01"))):
        with pytest.raises(EmptyExtractError):
            jobs.run_monthly(wh, inv, no_codes, *window)
    jobs.run_monthly(wh, inv, codes.where("false"), "2019-01-01", "2019-02-01", allow_empty=True)
    assert wh.row_count("dim_collections") == 1 and wh.row_count("staging_canonical_inventory") == 3
    assert jobs.run_daily(wh, loans, "2018-05-30", "2018-05-31") == 1


def test_catchup_refuses_late_and_unplaced_files(spark):
    from circulation.streaming.daily_catchup import LateLoansError, load_run_date, start_daily_catchup

    wh = _wh(spark)
    codes = spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES)
    jobs.run_monthly(wh, _inventory_rows(spark), codes, "2018-05-31", "2018-06-30")
    landing = scratch_path(spark, "late")
    loans = _loan_rows(spark)
    blank = loans.limit(1).withColumn("checkoutdatetime", F.lit(""))
    write_delimited(loans.unionByName(blank), f"{landing}/run_date=2018-06-01")
    with pytest.raises(LateLoansError, match="2 loans"):
        load_run_date(wh, landing, "2018-06-01")
    write_delimited(loans.unionByName(blank), f"{landing}/run_date=2018-06-02")
    assert load_run_date(wh, landing, "2018-06-02") == 3  # l1, l4, l5 have June books; the blank stamp is in no window
    write_delimited(loans, f"{landing}/elsewhere")
    with pytest.raises(Exception, match="no run_date"):
        start_daily_catchup(wh, landing, scratch_path(spark, "late-ckpt")).awaitTermination(300)


def test_blank_stamps_are_outside_every_window(spark):
    df = spark.createDataFrame([(1, ""), (2, "2018-05-21T00:00:00.000"), (3, None)], "i int, ts string")
    assert [r.i for r in extract_window(df, "ts", "2018-05-20", "2018-05-21").collect()] == [2]
    with pytest.raises(Exception):
        extract_window(spark.createDataFrame([("x y",)], "ts string"), "ts", "2018-05-20", "2018-05-21").collect()


def test_rebucket_moves_to_a_new_generation(spark):
    location = scratch_path(spark, "rebucket")
    wh = Warehouse(spark, f"circ_r1_{uuid.uuid4().hex[:8]}", location, buckets=3)
    wh.append("dim_books", spark.createDataFrame([(i, f"t{i}", "p", "a") for i in range(50)], schemas.DIM_BOOKS))
    wh.rebucket(5)
    later = Warehouse(spark, f"circ_r2_{uuid.uuid4().hex[:8]}", location)
    assert later.buckets == 5 and later.row_count("dim_books") == wh.row_count("dim_books") == 50
    later.append("dim_books", spark.createDataFrame([(99, "t", "p", "a")], schemas.DIM_BOOKS))
    assert wh.row_count("dim_books") == 51


def test_checks_take_any_scalar(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,)], "b long")
    dim = spark.createDataFrame([(1,), (1,)], "k long")
    checks = scalar_checks([Check("total", fact.selectExpr("sum(b) AS s"), 5), Check("none", fact.where("false").selectExpr("max(b)")),
                            orphan_check(fact, dim, "b", "k", "orphans"), duplicate_check(dim, "k", "twice")])
    assert rows(checks) == [("none", None, False), ("orphans", 0, False), ("total", 5, True), ("twice", 0, False)]
    with pytest.raises(QualityError, match="orphans = 0"):
        enforce(checks)


def test_cli_monthly_daily_report(spark):
    from circulation import cli

    base = scratch_path(spark, "cli")
    _inventory_rows(spark).write.parquet(f"{base}/inventory")
    _loan_rows(spark).write.parquet(f"{base}/loans")
    spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES) \
        .write.parquet(f"{base}/codes")
    common = ["--warehouse", f"circ_cli_{uuid.uuid4().hex[:8]}", "--location", f"{base}/wh"]
    out = cli.run(["monthly", *common, "--inventory", f"{base}/inventory", "--codes", f"{base}/codes",
                   "--prev", "2018-04-30", "--run", "2018-05-31"], spark)
    assert all(c["passed"] for c in out["checks"])
    assert cli.run(["daily", *common, "--loans", f"{base}/loans", "--prev", "2018-05-30", "--run", "2018-05-31"],
                   spark) == {"fact_rows": 1}
    report = cli.run(["report", *common], spark)
    assert report["range"] == ["2018-05-31", "2018-05-31"]
    assert report["loans_per_day"] == [["2018-05-31", 1]]
    assert report["popular_titles"] == [["Book one b", 1]]


def test_catchup_progress_survives_a_new_process(spark):
    from circulation.streaming import default_checkpoint, start_daily_catchup

    location = scratch_path(spark, "stream-wh")
    wh = Warehouse(spark, f"circ_s1_{uuid.uuid4().hex[:8]}", location)
    inv, loans = _inventory_rows(spark), _loan_rows(spark)
    codes = spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES)
    jobs.run_monthly(wh, inv, codes, "2018-05-31", "2018-06-30")
    landing = scratch_path(spark, "stream-landing2")
    write_delimited(extract_window(loans, "checkoutdatetime", "2018-05-31", "2018-06-01"),
                    f"{landing}/run_date=2018-06-01")
    q = start_daily_catchup(wh, landing)
    q.awaitTermination(300)
    assert sum(p["numInputRows"] for p in q.recentProgress) > 0
    # A later process: same location, fresh catalog entry; the stream finds nothing new.
    later = Warehouse(spark, f"circ_s2_{uuid.uuid4().hex[:8]}", location)
    assert default_checkpoint(later) == default_checkpoint(wh)
    q2 = start_daily_catchup(later, landing)
    q2.awaitTermination(300)
    assert sum(p["numInputRows"] for p in q2.recentProgress) == 0
    # (05-31, 06-01] holds l2, l3, l4; only l4's book is held in June.
    assert later.row_count("fact_loans") == wh.row_count("fact_loans") == 1


def test_compact_keeps_rows_and_bucketing(spark):
    wh = Warehouse(spark, f"circ_k_{uuid.uuid4().hex[:8]}", scratch_path(spark, "compact"), buckets=4)
    for i in range(3):
        wh.append("dim_books", spark.createDataFrame([(i * 10 + j, f"t{j}", "p", "a") for j in range(10)],
                                                     schemas.DIM_BOOKS))
    before = rows(wh.scan("dim_books"))
    def files():
        return wh.scan("dim_books").select(F.input_file_name()).distinct().count()

    files_before = files()
    assert wh.compact("dim_books") == 30
    assert rows(wh.scan("dim_books")) == before
    assert files() <= 4 < files_before


def test_bucket_layout_is_recorded_and_adopted(spark):
    location = scratch_path(spark, "layout")
    first = Warehouse(spark, f"circ_l1_{uuid.uuid4().hex[:8]}", location, buckets=4)
    first.append("dim_books", spark.createDataFrame([(i, f"t{i}", "p", "a") for i in range(20)], schemas.DIM_BOOKS))
    later = Warehouse(spark, f"circ_l2_{uuid.uuid4().hex[:8]}", location)  # session default would be 8
    assert later.buckets == 4
    assert later.row_count("dim_books") == 20
    with pytest.raises(ValueError, match="bucketed 4 ways"):
        Warehouse(spark, f"circ_l3_{uuid.uuid4().hex[:8]}", location, buckets=8)


def test_cli_reads_delimited_landing_files(spark):
    from circulation import cli

    base = scratch_path(spark, "cli-text")
    write_delimited(_inventory_rows(spark), f"{base}/inventory")
    write_delimited(_loan_rows(spark), f"{base}/loans")
    write_delimited(spark.createDataFrame([("a", None, None, None, None, "F", None, None)], schemas.STAGING_CODES),
                    f"{base}/codes")
    common = ["--warehouse", f"circ_clt_{uuid.uuid4().hex[:8]}", "--location", f"{base}/wh", "--format", "delimited"]
    cli.run(["monthly", *common, "--inventory", f"{base}/inventory", "--codes", f"{base}/codes",
             "--prev", "2018-05-31", "--run", "2018-06-30"], spark)
    out = cli.run(["daily", *common, "--loans", f"{base}/loans", "--prev", "2018-05-31", "--run", "2018-06-01"], spark)
    assert out == {"fact_rows": 1}  # l4; the text " B" and blank fields survive the landing


def test_window_on_a_date_column(spark):
    df = spark.createDataFrame([(1, dt.date(2018, 5, 20)), (2, dt.date(2018, 5, 21)), (3, dt.date(2018, 5, 22))],
                               "i int, d date")
    assert [r.i for r in extract_window(df, "d", "2018-05-20", "2018-05-21").collect()] == [2]
