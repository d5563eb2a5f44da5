"""The command line across separate processes: each run re-attaches the warehouse from disk."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from circulation.plans import fixtures as fx
from circulation.plans import marts
from circulation.session import scratch_path
from circulation.sinks import Warehouse

from conftest import ROOT, SF_SMALL


def _cli(*args: str) -> dict:
    out = subprocess.run([sys.executable, "-m", "circulation", *args], cwd=ROOT, capture_output=True, text=True,
                         timeout=600, env={**os.environ, "PYTHONPATH": ROOT})
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_jobs_and_report_in_separate_processes(spark):
    base = scratch_path(spark, "cli-proc")
    fx.inventory_source(spark, SF_SMALL).write.parquet(f"{base}/inventory")
    fx.codes(spark, SF_SMALL).write.parquet(f"{base}/codes")
    fx.loans(spark, SF_SMALL).write.parquet(f"{base}/loans")
    wh = ["--warehouse", "circ_proc", "--location", f"{base}/wh"]
    checks = _cli("monthly", *wh, "--inventory", f"{base}/inventory", "--codes", f"{base}/codes",
                  "--prev", "1900-01-01", "--run", "2100-01-01")
    assert all(c["passed"] for c in checks["checks"])
    daily = _cli("daily", *wh, "--loans", f"{base}/loans", "--prev", "1900-01-01", "--run", "2100-01-01")
    assert daily["fact_rows"] > 0
    report = _cli("report", *wh, "--lo", "1996-01-01", "--hi", "1996-12-31")

    here = Warehouse(spark, "circ_proc_check", f"{base}/wh")  # this process attaches the same files
    fact = here.scan("fact_loans")
    assert fact.count() == daily["fact_rows"]
    top = marts.popular_subjects(fact, here.scan("bridge_subject"), here.scan("dim_subject"), "1996-01-01", "1996-12-31")
    assert report["popular_subjects"] == [[r["subject"], r["count"]] for r in top.collect()]
    assert sum(n for _, n in report["loans_per_day"]) == marts.in_range(fact, "1996-01-01", "1996-12-31").count()
