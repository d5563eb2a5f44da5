"""The file index opens the files that may matter and loses no row."""

from __future__ import annotations

import datetime as dt

import pytest

from circulation.session import scratch_path
from circulation.sources import extract_window, files_of_window, read_indexed, update_stamp_index
from conftest import rows

DAY = dt.date(2018, 5, 1)


def _stamp(day: int, time: str = "12:00:00.000") -> str:
    return f"{DAY + dt.timedelta(days=day)}T{time}"


def _land(spark, path: str, stamps: list) -> None:
    spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id long, ts string").coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def source(spark):
    path = scratch_path(spark, "stamps") + "/a b+c"
    for d in range(6):
        _land(spark, path, [_stamp(d), _stamp(d, "23:59:59.000"), "", None])
    _land(spark, path, [None, ""])
    _land(spark, path, [_stamp(3, "00:00:00.000"), _stamp(0)])
    return path


def _window(spark, df, lo, hi):
    return rows(extract_window(df, "ts", lo, hi))


def test_only_files_that_can_match_are_opened(spark, source):
    index, schema = scratch_path(spark, "idx"), spark.read.parquet(source).schema
    everything = spark.read.parquet(source)
    lo, hi = DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=3)
    assert len(files_of_window(spark, source, index, lo, hi)) == 8  # without an index every file
    assert update_stamp_index(spark, source, schema, "ts", index) == 8
    assert update_stamp_index(spark, source, schema, "ts", index) == 0
    # The day's own file, and the file that reaches its last instant.
    opened = read_indexed(spark, source, schema, index, lo, hi)
    assert len(opened.inputFiles()) == 2
    for a in (None, 0, 2, 5, 9):
        for b in (None, 0, 1, 3, 9):
            w = [x if x is None else DAY + dt.timedelta(days=x) for x in (a, b)]
            assert _window(spark, read_indexed(spark, source, schema, index, *w), *w) == _window(spark, everything, *w)


def test_late_and_replaced_files_are_opened(spark, source):
    index, schema = scratch_path(spark, "idx"), spark.read.parquet(source).schema
    update_stamp_index(spark, source, schema, "ts", index)
    lo, hi = DAY + dt.timedelta(days=20), DAY + dt.timedelta(days=21)
    assert files_of_window(spark, source, index, lo, hi) == []
    assert read_indexed(spark, source, schema, index, lo, hi).count() == 0
    _land(spark, source, [_stamp(20), _stamp(1)])  # a late file, not indexed yet
    assert len(files_of_window(spark, source, index, lo, hi)) == 1
    assert [r[1] for r in _window(spark, read_indexed(spark, source, schema, index, lo, hi), lo, hi)] == [_stamp(20)]
    _land(spark, source, [_stamp(2)])
    assert update_stamp_index(spark, source, schema, "ts", index) == 2
    assert len(files_of_window(spark, source, index, lo, hi)) == 1
    # A rewritten source: no old entry fits, so every file is opened.
    spark.createDataFrame([(1, _stamp(20))], schema).write.mode("overwrite").parquet(source)
    assert [r[1] for r in _window(spark, read_indexed(spark, source, schema, index, lo, hi), lo, hi)] == [_stamp(20)]


def test_daily_job_from_the_command_line_with_an_index(spark):
    from circulation import cli, schemas

    base = scratch_path(spark, "idx-cli")
    common = ["--warehouse", "circ_idx", "--location", f"{base}/wh"]
    blank = {f.name: None for f in schemas.STAGING_INVENTORY.fields}
    book = {**blank, "bibnum": 1, "title": "t", "subjects": "a", "reportdate": "2018-05-31T00:00:00.000"}
    spark.createDataFrame([book], schemas.STAGING_INVENTORY).write.parquet(f"{base}/inventory")
    code = {f.name: None for f in schemas.STAGING_CODES.fields}
    spark.createDataFrame([{**code, "code": "c", "category_group": "g"}], schemas.STAGING_CODES).write.parquet(f"{base}/codes")
    loan = {f.name: None for f in schemas.STAGING_LOANS.fields}
    for d in (30, 31):
        rows_ = [{**loan, "id": d, "bibnumber": 1, "checkoutdatetime": f"2018-05-{d}T10:00:00.000"}]
        spark.createDataFrame(rows_, schemas.STAGING_LOANS).coalesce(1).write.mode("append").parquet(f"{base}/loans")
    cli.run(["monthly", *common, "--inventory", f"{base}/inventory", "--codes", f"{base}/codes",
             "--prev", "2018-04-30", "--run", "2018-05-31"], spark)
    daily = ["daily", *common, "--loans", f"{base}/loans", "--prev", "2018-05-30", "--run", "2018-05-31"]
    assert cli.run([*daily, "--index", f"{base}/index"], spark) == cli.run(daily, spark) == {"fact_rows": 1}
    assert spark.read.parquet(f"{base}/index").count() == 2
    with pytest.raises(SystemExit):
        cli.run([*daily, "--index", f"{base}/index", "--format", "landed"], spark)
