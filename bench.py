"""Benchmark: the monthly and daily jobs into a fresh warehouse, then the dashboard marts.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. ``value`` is the mean warm time of the four marts (the dashboard
refresh the reference quotes as "a couple of seconds"); job times and the one-pass refresh of
all three dashboard results are listed alongside.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from circulation.plans import fixtures as fx  # noqa: E402
from circulation.plans import jobs, marts  # noqa: E402
from circulation.session import build_session, scratch_path  # noqa: E402
from circulation.sinks import Warehouse  # noqa: E402

RUNS = (("1900-01-01", "1998-06-30"), ("1998-06-30", "2100-01-01"))
LO, HI = "1995-01-15", "2001-10-15"
WARM_REPEATS = 3


def _timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="circulation-bench")
    wh = Warehouse(spark, f"circ_bench_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bench"))

    # Land the source data once (the reference downloads it in a separate stage), then time
    # the jobs reading the landed parquet.
    landing = scratch_path(spark, "bench-landing")
    times: dict[str, float] = {}

    def land():
        for name, df in (("inventory", fx.inventory_source(spark, sf_dir)), ("codes", fx.codes(spark, sf_dir)),
                         ("loans", fx.loans(spark, sf_dir))):
            df.write.mode("overwrite").parquet(f"{landing}/{name}")

    _, times["land_sources"] = _timed(land)
    inventory, codes, loans = (spark.read.parquet(f"{landing}/{n}") for n in ("inventory", "codes", "loans"))
    for i, (lo, hi) in enumerate(RUNS, start=1):
        _, times[f"monthly_job_{i}"] = _timed(lambda: jobs.run_monthly(wh, inventory, codes, lo, hi))
        _, times[f"daily_job_{i}"] = _timed(lambda: jobs.run_daily(wh, loans, lo, hi))

    view = wh.snapshot()
    fact, bridge, days = view.scan("fact_loans"), view.scan("bridge_subject"), view.load_days()
    dim_subject, dim_books = view.scan("dim_subject"), view.scan("dim_books")
    mart_queries = {
        "date_bounds": lambda: marts.date_bounds(fact, days),
        "loans_per_day": lambda: marts.loans_per_day(fact, LO, HI, days),
        "popular_subjects": lambda: marts.rolled_subjects(view, LO, HI),
        "popular_titles": lambda: marts.rolled_titles(view, LO, HI),
    }
    from_facts = {
        "popular_subjects_from_facts": lambda: marts.popular_subjects(fact, bridge, dim_subject, LO, HI, days=days),
        "popular_titles_from_facts": lambda: marts.popular_titles(fact, dim_books, LO, HI, days=days),
    }
    rows: dict[str, int] = {}
    for name, build in {**mart_queries, **from_facts}.items():
        rows[name] = len(build().collect())  # warm-up: plans, file listings, JIT
        runs = []
        for _ in range(WARM_REPEATS):
            _, sec = _timed(lambda: build().collect())
            runs.append(sec)
        times[name] = statistics.median(runs)

    def dashboard_refresh():
        out = marts.dashboard(wh.snapshot(), LO, HI)
        return [len(df.collect()) for df in out.values()]

    dashboard_refresh()  # warm-up
    times["dashboard_refresh_one_pass"] = statistics.median(_timed(dashboard_refresh)[1] for _ in range(WARM_REPEATS))

    mart_mean = statistics.mean(times[n] for n in mart_queries)
    print(json.dumps({
        "metric": "dashboard_mart_warm_mean",
        "value": round(mart_mean, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "rows": rows,
        "fact_rows": fact.count(),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
