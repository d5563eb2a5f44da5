"""Command line for the jobs and the dashboard marts (spark-submit friendly).

    python -m circulation monthly --warehouse W --location L --inventory P --codes P --prev D --run D
    python -m circulation daily   --warehouse W --location L --loans P --prev D --run D
    python -m circulation catchup --warehouse W --location L --landing DIR [--format delimited | landed]
    python -m circulation catchup-months --warehouse W --location L --inventory P --codes P --until D
    python -m circulation land    --source P --dataset loans | inventory --landing DIR --prev D --run D
    python -m circulation report  --warehouse W --location L [--lo D --hi D]
    python -m circulation drop    --warehouse W --location L --table T | --all
    python -m circulation vacuum  --warehouse W --location L

Sources are parquet by default (``--format delimited`` reads ``|`` text with a header into the
staging schema, ``--format split`` the same from few large files, each by many tasks, ``--format landed`` a dataset folder of the typed landing). ``report`` prints the dashboard's three results as JSON: the daily series, the
top 30 subjects and the top 20 titles; all three are bounded by days or k.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from circulation import schemas
from circulation.plans import jobs, marts
from circulation.session import apply_runtime_conf, ensure_checkpoint_dir
from circulation.sinks import Warehouse
from circulation.sources import extract_window, land_typed, read_delimited, read_indexed, read_landed, read_split_delimited, update_stamp_index


def _source(spark: SparkSession, path: str, fmt: str, schema, stamp: str | None = None) -> DataFrame:
    if fmt == "landed" and stamp is not None:
        root, _, dataset = path.rstrip("/").rpartition("/")
        return read_landed(spark, root, dataset, schema, stamp)
    if fmt == "delimited":
        return read_delimited(spark, path, schema)
    if fmt == "split":
        return read_split_delimited(spark, path, schema)
    return spark.read.parquet(path)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="circulation")
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp):
        sp.add_argument("--warehouse", required=True, help="database name")
        sp.add_argument("--location", help="directory of the warehouse tables")
        sp.add_argument("--buckets", type=int, help="bucket count of the join-side tables")

    m = sub.add_parser("monthly", help="codes and inventory -> dims and bridge (C13)")
    common(m)
    m.add_argument("--inventory", required=True)
    m.add_argument("--codes", required=True)
    m.add_argument("--prev", required=True)
    m.add_argument("--run", required=True)
    m.add_argument("--format", choices=["parquet", "delimited", "split", "landed"], default="parquet")
    m.add_argument("--allow-empty", action="store_true")

    d = sub.add_parser("daily", help="loans -> fact_loans and dim_time (C14)")
    common(d)
    d.add_argument("--loans", required=True)
    d.add_argument("--prev", required=True)
    d.add_argument("--run", required=True)
    d.add_argument("--format", choices=["parquet", "delimited", "split", "landed"], default="parquet")
    d.add_argument("--allow-empty", action="store_true")
    d.add_argument("--index", help="folder of the source's file index (parquet): updated, then used to skip files")

    c = sub.add_parser("catchup", help="load every landed run date not yet processed")
    common(c)
    c.add_argument("--landing", required=True, help="directory of run_date=YYYY-MM-DD loan folders")
    c.add_argument("--checkpoint", help="stream checkpoint (default: under the warehouse location)")

    c.add_argument("--format", choices=["delimited", "landed"], default="delimited")

    cm = sub.add_parser("catchup-months", help="every month that has ended and was not loaded, in order")
    common(cm)
    cm.add_argument("--inventory", required=True)
    cm.add_argument("--codes", required=True)
    cm.add_argument("--until", required=True)
    cm.add_argument("--since", help="first month, if none was loaded yet")
    cm.add_argument("--format", choices=["parquet", "delimited", "split", "landed"], default="parquet")

    ld = sub.add_parser("land", help="one run's window of a source -> the typed landing")
    ld.add_argument("--source", required=True)
    ld.add_argument("--dataset", choices=["loans", "inventory"], required=True)
    ld.add_argument("--landing", required=True)
    ld.add_argument("--prev", required=True)
    ld.add_argument("--run", required=True)
    ld.add_argument("--format", choices=["parquet", "delimited", "split"], default="parquet")

    dr = sub.add_parser("drop", help="drop one table or all")
    common(dr)
    dr.add_argument("--table")
    dr.add_argument("--all", action="store_true")

    common(sub.add_parser("vacuum", help="delete what killed runs left"))

    r = sub.add_parser("report", help="dashboard marts as JSON (C8-C11)")
    common(r)
    r.add_argument("--lo")
    r.add_argument("--hi")
    return p


def run(argv: Sequence[str], spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(list(argv))
    spark = spark or (
        SparkSession.builder.appName(f"circulation-{args.command}")
        .config("spark.ui.enabled", "false")  # batch jobs: no web UI
        .getOrCreate()
    )
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    if args.command == "land":
        schema, stamp = {"loans": (schemas.STAGING_LOANS, "checkoutdatetime"),
                         "inventory": (schemas.STAGING_INVENTORY, "reportdate")}[args.dataset]
        rows = extract_window(_source(spark, args.source, args.format, schema), stamp, args.prev, args.run, schema.fieldNames())
        land_typed(rows, args.landing, args.dataset, args.run, stamp)
        return {"dataset": args.dataset, "run_date": args.run}
    wh = Warehouse(spark, args.warehouse, args.location, buckets=args.buckets)

    if args.command == "drop":
        if args.all == bool(args.table):
            raise SystemExit("drop: name one --table, or --all")
        wh.drop_all() if args.all else wh.drop(args.table)
        return {"tables": wh.tables()}
    if args.command == "vacuum":
        return {"folders": wh.vacuum()}
    if args.command == "catchup-months":
        inventory = _source(spark, args.inventory, args.format, schemas.STAGING_INVENTORY, "reportdate")
        codes = _source(spark, args.codes, args.format, schemas.STAGING_CODES)
        first = args.since or wh.frontier.get("monthly")
        if first is None:
            raise SystemExit("catchup-months: no month was loaded yet, so name the first one with --since")
        none = spark.createDataFrame([], schemas.STAGING_LOANS)
        runs = jobs.catch_up(wh, inventory, codes, none, jobs.month_ends(first, args.until), [], allow_empty=False)
        return {"runs": [list(r) for r in runs]}
    if args.command == "monthly":
        inventory = _source(spark, args.inventory, args.format, schemas.STAGING_INVENTORY, "reportdate")
        codes = _source(spark, args.codes, args.format, schemas.STAGING_CODES)
        checks = jobs.run_monthly(wh, inventory, codes, args.prev, args.run, allow_empty=args.allow_empty)
        return {"checks": [{"check": c, "value": v, "passed": p} for c, v, p in checks]}
    if args.command == "daily":
        if args.index:
            if args.format != "parquet":
                raise SystemExit("daily: --index goes with --format parquet")
            update_stamp_index(spark, args.loans, schemas.STAGING_LOANS, "checkoutdatetime", args.index)
            loans = read_indexed(spark, args.loans, schemas.STAGING_LOANS, args.index, args.prev, args.run)
        else:
            loans = _source(spark, args.loans, args.format, schemas.STAGING_LOANS, "checkoutdatetime")
        return {"fact_rows": jobs.run_daily(wh, loans, args.prev, args.run, allow_empty=args.allow_empty)}
    if args.command == "catchup":
        from circulation.streaming import start_daily_catchup

        landed = "typed" if args.format == "landed" else "delimited"
        start_daily_catchup(wh, args.landing, args.checkpoint, landed=landed).awaitTermination()
        return {"fact_rows": wh.row_count("fact_loans")}

    view = wh.snapshot()  # one state for all three results, whatever is published meanwhile
    fact, days = view.scan("fact_loans"), view.load_days()
    bounds = marts.date_bounds(fact, days).first()
    lo = args.lo or (bounds["min_date"].date().isoformat() if bounds["min_date"] else None)
    hi = args.hi or (bounds["max_date"].date().isoformat() if bounds["max_date"] else None)
    out = marts.dashboard(view, lo, hi)
    return {
        "range": [lo, hi],
        "loans_per_day": [[r["date"].isoformat(), r["count"]] for r in out["loans_per_day"].orderBy("date").collect()],
        "popular_subjects": [[r["subject"], r["count"]] for r in out["popular_subjects"].collect()],
        "popular_titles": [[r["title"], r["loan_numbers"]] for r in out["popular_titles"].collect()],
    }


def main(argv: Sequence[str] | None = None) -> int:
    print(json.dumps(run(sys.argv[1:] if argv is None else argv)))
    return 0
