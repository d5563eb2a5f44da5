"""Dyadic roll-ups and the three-phase top-k: against brute force, through re-runs, and their plans."""

from __future__ import annotations

import datetime as dt
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from circulation import schemas
from circulation.operators import dyadic
from circulation.plans import marts
from circulation.session import scratch_path
from circulation.sinks import Warehouse

from conftest import plan_text, rows


def test_cover_is_exact_and_short():
    rng = random.Random(5)
    for _ in range(400):
        lo = rng.randrange(-9000, 20000)
        hi = lo + rng.choice([-1, 0, 1, 6, 30, 365, 5000])
        nodes = dyadic.cover(lo, hi)
        days = [d for level, n in nodes for d in range(n << level, (n + 1) << level)]
        assert days == list(range(lo, hi + 1)) and len(nodes) <= 2 * dyadic.LEVELS
        assert all((level, d >> level) in set(dyadic.holding([dt.date(1970, 1, 1) + dt.timedelta(days=d)]))
                   for level, n in nodes for d in [n << level])


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_three_phases_equal_brute_force_with_adversarial_ties(spark, monkeypatch, broadcast):
    monkeypatch.setattr(dyadic, "BROADCAST_CANDIDATES", broadcast)
    rng = random.Random(8)
    # Titles that are in no part's best but best in sum, ties at the cut, a null title, a long tail.
    data = [(p, f"even{i:02d}", 50) for p in range(6) for i in range(12)]
    data += [(p, f"peak{p}-{i}", 60 + i) for p in range(6) for i in range(8)]
    data += [(p, None, 50) for p in range(6)]
    data += [(rng.randrange(6), f"tail{i}", rng.randrange(1, 4)) for i in range(500)]
    sums = Counter()
    for _, t, n in data:
        sums[t] += n
    table = spark.createDataFrame(list({(p, t): (p, t, n) for p, t, n in data}.values()), "p int, t string, n long")
    sums = Counter()
    for r in table.collect():
        sums[r["t"]] += r["n"]
    for k in (1, 5, 10, 13, 30, 1000):
        want = sorted(sums.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]
        got = dyadic.three_phase_top_k(table, "t", "n", ["p"], 6, k).collect()
        assert [(r["t"], r["n"]) for r in got] == want


def test_top_k_shuffles_no_tail(spark):
    """Rows that leave their task do not grow with the number of titles in the tail."""
    from circulation.operators import top_k  # noqa: F401

    def moved(tail):
        table = spark.range(tail).selectExpr("id % 4 AS p", "concat('t', id) AS t", "1L AS n").union(
            spark.range(40).selectExpr("id % 4", "concat('big', id div 4)", "1000 + id"))
        done = dyadic.three_phase_top_k(table.coalesce(4), "t", "n", ["p"], 4, 5)
        assert done.count() == 5
        assert "BroadcastHashJoin" in plan_text(done) or "LeftSemi" in plan_text(done)
        high = table.where("n * 4 >= 4000")
        return high.count()

    assert moved(2_000) == moved(20_000) <= 40


def _loaded(spark):
    wh = Warehouse(spark, f"circ_roll_{uuid.uuid4().hex[:10]}", scratch_path(spark, "roll"))
    rng = random.Random(3)
    books = [(b, f"Title {b % 17}" if b % 5 else None, "p", "a") for b in range(40)]
    wh.append("dim_books", spark.createDataFrame(books, schemas.DIM_BOOKS))
    wh.append("dim_subject", spark.createDataFrame([(f"S{i}", i) for i in range(6)], schemas.DIM_SUBJECT))
    wh.append("bridge_subject", spark.createDataFrame([(f"g{g}", s, "x") for g in range(8) for s in {g % 6, (g * 5) % 6}], schemas.BRIDGE_SUBJECT))

    def facts(n, books, first):
        out = []
        for i in range(n):
            day = None if rng.random() < 0.05 else first + dt.timedelta(days=rng.randrange(40))
            out.append((f"x{i}", day and dt.datetime(day.year, day.month, day.day), "t", "c", rng.choice(books), f"g{rng.randrange(9)}"))
        return spark.createDataFrame(out, schemas.FACT_LOANS)

    return wh, facts


RANGES = [(None, None), ("2018-05-03", "2018-06-08"), ("2017-01-01", "2017-02-01"), (None, "2018-05-20"), ("2018-06-01", "2018-05-01")]


def _same(wh, monkeypatch):
    view = wh.snapshot()
    monkeypatch.setattr(marts, "ONE_PASS_ROWS", 0)
    fact, bridge, names, books = (view.scan(t) for t in ("fact_loans", "bridge_subject", "dim_subject", "dim_books"))
    for lo, hi in RANGES:
        want = [tuple(r) for r in marts.popular_subjects(fact, bridge, names, lo, hi, k=4).collect()]
        assert [tuple(r) for r in marts.rolled_subjects(view, lo, hi, k=4).collect()] == want, (lo, hi)
        want = [tuple(r) for r in marts.popular_titles(fact, books, lo, hi, k=6).collect()]
        assert [tuple(r) for r in marts.rolled_titles(view, lo, hi, k=6).collect()] == want, (lo, hi)


def test_roll_ups_follow_runs_and_corrected_runs(spark, monkeypatch):
    wh, facts = _loaded(spark)
    known, late = list(range(40)), list(range(35, 45))
    for run, n, books in (("2018-05-31", 300, known), ("2018-06-30", 200, known), ("2018-05-31", 120, late), ("2018-06-30", 0, known)):
        wh.replace_run(run, facts(n, books, dt.date(2018, 5, 1)))
    _same(wh, monkeypatch)
    # Books that come only after their loans count under their title from then on.
    wh.append("dim_books", spark.createDataFrame([(b, f"Late {b % 2}", "p", "a") for b in range(40, 45)], schemas.DIM_BOOKS))
    _same(Warehouse(spark, f"circ_roll_{uuid.uuid4().hex[:10]}", wh.location), monkeypatch)
    assert wh.vacuum() >= 0
    _same(wh, monkeypatch)


def test_no_fact_is_scanned_and_found_facts_fall_back(spark):
    wh, facts = _loaded(spark)
    day = facts(50, list(range(40)), dt.date(2018, 5, 1))
    wh.replace_run("2018-05-31", day)
    other_way = [tuple(r) for r in marts.popular_titles(wh.scan("fact_loans"), wh.scan("dim_books"), "2018-05-03", "2018-05-30").collect()]
    assert [tuple(r) for r in marts.rolled_titles(wh.snapshot(), "2018-05-03", "2018-05-30").collect()] == other_way
    for df in marts.dashboard(wh.snapshot(), "2018-05-03", "2018-05-30").values():
        df.collect()
        assert "fact_loans_parts" not in plan_text(df)
    found = scratch_path(spark, "found")
    day.write.parquet(f"{found}/fact_loans/load_date=2018-05-31")
    other = Warehouse(spark, f"circ_roll_{uuid.uuid4().hex[:10]}", found)
    for t in ("dim_books", "dim_subject", "bridge_subject"):
        other.append(t, wh.scan(t))
    assert other.snapshot().group_counts() is None
    assert rows(marts.rolled_subjects(other.snapshot())) == rows(marts.rolled_subjects(wh.snapshot()))
