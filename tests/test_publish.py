"""Consistent publish: a run's tables become visible together, after its checks, by one writer at a time."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from circulation import cli, schemas
from circulation.plans import jobs, marts, model
from circulation.plans.quality import Check, QualityError, duplicate_check, orphan_check
from circulation.session import scratch_path
from circulation.sinks import CANONICAL, ConcurrentRunError, Warehouse

from conftest import plan_text, rows
from test_io_jobs import _inventory_rows, _loan_rows

MONTHS = [("2018-04-30", "2018-05-31"), ("2018-05-31", "2018-06-30")]


def _codes(spark, name="Fiction"):
    return spark.createDataFrame([("a", None, None, None, None, name, None, None)], schemas.STAGING_CODES)


def _wh(spark, location=None):
    return Warehouse(spark, f"circ_pub_{uuid.uuid4().hex[:10]}", location or scratch_path(spark, "publish"))


STATE = ["dim_collections", CANONICAL, "dim_books", "dim_subject", "bridge_subject", "staging_inventory", "fact_loans", "dim_time"]


def _state(view):
    return {t: rows(view.scan(t)) for t in STATE}


@pytest.mark.parametrize("step", ["dim_collections", "canonical_inventory", "new_dim_books", "new_dim_subject", "new_bridge"])
def test_a_run_that_fails_between_steps_changes_nothing(spark, monkeypatch, step):
    wh = _wh(spark)
    inv = _inventory_rows(spark)
    jobs.run_monthly(wh, inv, _codes(spark), *MONTHS[0])
    before, number = _state(wh), wh.snapshot().record.number

    def killed(*_a, **_k):
        raise RuntimeError("killed here")

    with monkeypatch.context() as m:
        m.setattr(model, step, killed)
        with pytest.raises(RuntimeError, match="killed here"):
            jobs.run_monthly(wh, inv, _codes(spark, "Other"), *MONTHS[1])
    later = Warehouse(spark, f"circ_pub_{uuid.uuid4().hex[:10]}", wh.location)
    assert _state(later) == _state(wh) == before and later.snapshot().record.number == number
    # The run is simply made again.
    jobs.run_monthly(wh, inv, _codes(spark, "Other"), *MONTHS[1])
    assert rows(later.scan("dim_subject"))[-1] == ("D", 5)


def test_a_reader_in_the_middle_of_a_run_sees_all_old_then_all_new(spark, monkeypatch):
    wh = _wh(spark)
    inv = _inventory_rows(spark)
    jobs.run_monthly(wh, inv, _codes(spark), *MONTHS[0])
    reader = Warehouse(spark, f"circ_pub_{uuid.uuid4().hex[:10]}", wh.location)
    before, held, seen = _state(reader), reader.snapshot(), []
    plain = model.new_bridge

    def watched(*a, **k):
        seen.append(_state(reader) == before and len(rows(wh.scan("dim_subject"))) > len(before["dim_subject"]))
        return plain(*a, **k)

    monkeypatch.setattr(model, "new_bridge", watched)
    jobs.run_monthly(wh, inv, _codes(spark, "Other"), *MONTHS[1])
    assert seen == [True]
    after = _state(reader)
    assert all(after[t] != before[t] for t in ("dim_collections", CANONICAL, "dim_books", "dim_subject", "bridge_subject"))
    assert _state(held) == before  # what was read once stays readable


def test_failing_checks_leave_the_published_tables(spark):
    wh = _wh(spark)
    jobs.run_monthly(wh, _inventory_rows(spark), _codes(spark), *MONTHS[0])
    jobs.run_daily(wh, _loan_rows(spark), "2018-05-30", "2018-05-31")
    before = _state(wh)

    def orphans(view):
        return [orphan_check(view.scan("fact_loans"), view.scan("dim_books").where("bibnum != 1"), "bibnumber", "bibnum", "orphans")]

    with pytest.raises(QualityError, match="orphans"):
        jobs.run_daily(wh, _loan_rows(spark), "2018-05-31", "2018-06-30", checks=orphans)
    with pytest.raises(QualityError, match="titles = 4"):
        jobs.run_monthly(wh, _inventory_rows(spark), _codes(spark), *MONTHS[1], checks=lambda view: [
            Check("titles", view.scan("dim_books").agg(F.count_distinct("title")), 99)])
    assert _state(wh) == before and wh.frontier == {"monthly": "2018-05-31", "daily": "2018-05-31"}
    done = jobs.run_monthly(wh, _inventory_rows(spark), _codes(spark), *MONTHS[1], checks=lambda view: [
        duplicate_check(view.scan("dim_books"), "bibnum", "books")])
    assert ("books", 1, True) in done and ("repeated_subject_ids", 1, True) in done


def test_of_two_writers_one_is_published_and_ids_stay_unique(spark):
    first = _wh(spark)
    first.create_all()
    second = Warehouse(spark, f"circ_pub_{uuid.uuid4().hex[:10]}", first.location)

    def load(wh, names):
        tokens = spark.createDataFrame([(n,) for n in names], "subject string")
        wh.append("dim_subject", model.new_dim_subject(tokens, wh.scan("dim_subject")))

    with pytest.raises(ConcurrentRunError):
        with first.transaction():
            load(first, ["a", "b"])
            load(second, ["c"])  # published meanwhile
    assert rows(first.scan("dim_subject")) == [("c", 1)]
    load(first, ["a", "b"])
    assert rows(second.scan("dim_subject")) == [("a", 2), ("b", 3), ("c", 1)]
    assert first.vacuum() == 0  # the run that was refused took its files along


def test_vacuum_deletes_only_what_no_record_names(spark):
    wh = _wh(spark)
    wh.append("dim_books", spark.createDataFrame([(1, "T", "p", "a")], schemas.DIM_BOOKS))
    day = spark.createDataFrame([("a", dt.datetime(2020, 1, 1), "t", "c", 1, "g")], schemas.FACT_LOANS)
    wh.replace_run("2020-01-01", day)
    stem = f"{wh.location}/tables/fact_loans_parts/load_date=2020-01-01/part=left-behind"
    day.write.parquet(stem)
    assert wh.row_count("fact_loans") == wh.scan("fact_loans").count() == 1
    assert wh.vacuum() == 1 and wh.vacuum() == 0
    later = _wh(spark, wh.location)
    assert later.scan("fact_loans").count() == 1 and rows(later.scan("dim_books")) == [(1, "T", "p", "a")]


def test_replaced_parts_are_deleted_after_some_records(spark):
    wh = _wh(spark)
    for i in range(11):
        wh.replace("dim_collections", spark.createDataFrame([(f"c{i}", "x")], schemas.DIM_COLLECTIONS))
    left = wh.store.names(f"{wh.location}/tables/dim_collections_parts")
    assert 1 < len([n for n in left if n.startswith("part=")]) < 11
    assert rows(wh.scan("dim_collections")) == [("c10", "x")] and len(wh.store.names(wh.store.folder)) <= 10


def test_reading_writes_nothing_even_with_empty_runs(spark, monkeypatch):
    wh = _wh(spark)
    jobs.run_monthly(wh, _inventory_rows(spark), _codes(spark), *MONTHS[0])
    jobs.run_daily(wh, _loan_rows(spark), "2018-05-30", "2018-05-31")
    for day in ("2019-01-01", "2019-01-02"):
        jobs.run_daily(wh, _loan_rows(spark), day, day, allow_empty=True)
    later = _wh(spark, wh.location)
    monkeypatch.setattr(later.store, "publish", lambda record: pytest.fail("a reader published"))
    monkeypatch.setattr(Warehouse, "_write", lambda *a, **k: pytest.fail("a reader wrote"))
    plain, said = type(spark).sql, []
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), plain(self, text, *a, **k))[1])
    view = later.snapshot()
    for _ in range(2):
        days = view.load_days()
        assert rows(marts.loans_per_day(view.scan("fact_loans"), days=days)) == [(dt.date(2018, 5, 31), 1)]
        assert sorted(str(r.load_date) for r in days.collect()) == ["2018-05-31", "2019-01-01", "2019-01-02"]
    assert not [t for t in said if "INSERT" in t.upper() or "REPAIR" in t.upper()]
    assert "fact_loans" not in plan_text(marts.date_bounds(view.scan("fact_loans"), view.load_days()))


def test_catch_up_makes_missed_runs_in_order(spark):
    wh, straight = _wh(spark), _wh(spark)
    inv, loans, codes = _inventory_rows(spark), _loan_rows(spark), _codes(spark)
    months, days = ["2018-05-31", "2018-06-30"], ["2018-05-31", "2018-06-30"]
    for lo, hi in [("0001-01-01", "2018-05-31"), ("2018-05-31", "2018-06-30")]:
        jobs.run_monthly(straight, inv, codes, lo, hi)
        jobs.run_daily(straight, loans, lo, hi)
    jobs.run_monthly(wh, inv, codes, "0001-01-01", "2018-05-31")
    made = jobs.catch_up(wh, inv, codes, loans, months, days)
    assert made == [("daily", "2018-05-31"), ("monthly", "2018-06-30"), ("daily", "2018-06-30")]
    assert _state(wh) == _state(straight)
    assert jobs.catch_up(wh, inv, codes, loans, months, days) == []
    assert jobs.month_ends("2018-01-31", "2018-04-29") == ["2018-01-31", "2018-02-28", "2018-03-31"]


def test_command_line_catches_up_lands_drops_and_cleans(spark):
    base = scratch_path(spark, "cli-publish")
    for name, df in (("inventory", _inventory_rows(spark)), ("loans", _loan_rows(spark)), ("codes", _codes(spark))):
        df.write.parquet(f"{base}/{name}")
    common = ["--warehouse", f"circ_cli_{uuid.uuid4().hex[:8]}", "--location", f"{base}/wh"]
    for lo, hi in (("2018-05-30", "2018-05-31"), ("2018-05-31", "2018-06-30")):
        out = cli.run(["land", "--source", f"{base}/loans", "--dataset", "loans", "--landing", f"{base}/typed", "--prev", lo, "--run", hi], spark)
        assert out["run_date"] == hi
    cli.run(["monthly", *common, "--inventory", f"{base}/inventory", "--codes", f"{base}/codes", "--prev", "2018-04-30", "--run", "2018-05-31"], spark)
    out = cli.run(["catchup-months", *common, "--inventory", f"{base}/inventory", "--codes", f"{base}/codes", "--until", "2018-07-10"], spark)
    assert out["runs"] == [["monthly", "2018-06-30"]]
    out = cli.run(["catchup", *common, "--landing", f"{base}/typed/loans", "--format", "landed"], spark)
    assert out["fact_rows"] == 3  # l1, l4 and l5: both run dates meet June's inventory, which holds books 1 and 4
    assert cli.run(["drop", *common, "--table", "fact_loans"], spark)["tables"].count("fact_loans") == 0
    assert cli.run(["vacuum", *common], spark) == {"folders": 0}
    assert cli.run(["drop", *common, "--all"], spark) == {"tables": []}
