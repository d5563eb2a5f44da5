"""

Every query reads the driver tables under ``sf_dir`` (through the fixture views of
``circulation.plans.fixtures``, which keep every row) and returns a DataFrame; ``oracle_sql()`` states the same
result in DuckDB SQL. Column names match between the two.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

import oracle_sql as _oracle  # noqa: E402
from circulation import schemas  # noqa: E402
from circulation.constants import LANDING_COMPRESSION  # noqa: E402
from circulation.operators import explode_tokens  # noqa: E402
from circulation.plans import fixtures as fx  # noqa: E402
from circulation.plans import jobs, marts, model  # noqa: E402
from circulation.plans.quality import (  # noqa: E402
    QualityError,
    duplicate_check,
    orphan_check,
    row_count_checks,
    scalar_checks,
)
from circulation.plans.star import Star, apply_month, empty  # noqa: E402
from circulation.session import apply_runtime_conf, ensure_checkpoint_dir, materialise, scratch_path  # noqa: E402
from circulation.sinks import Warehouse, write_delimited  # noqa: E402
from circulation.sources import (  # noqa: E402
    extract_size,
    extract_window,
    land_typed,
    read_delimited,
    read_indexed,
    read_landed,
    read_split_delimited,
    union_slices,
    update_stamp_index,
)

SMOKE_DIR = "/root/testdata/sf0.001"
MART_LO, MART_HI = _oracle.MART_LO, _oracle.MART_HI
# Window of the first inventory month and loan batch, then of the second: (lo, hi].
RUNS = (("1900-01-01", "1998-06-30"), ("1998-06-30", "2100-01-01"))


def _prepare(spark: SparkSession) -> None:
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    # Python workers import the package from here, wherever the driver was started.
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _HERE not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_HERE, *paths])


def build_months(spark: SparkSession, sf_dir: str) -> Star:
    """Two inventory months as DataFrame state; every step's rows are written, nothing is kept between calls."""
    _prepare(spark)
    star = apply_month(Star.empty(spark), fx.inventory(spark, sf_dir, 1), fx.codes(spark, sf_dir))
    return apply_month(star, fx.inventory(spark, sf_dir, 2))


def _warehouse(spark: SparkSession, label: str) -> Warehouse:
    """A scratch warehouse under the shared checkpoint folder. Buckets follow the cluster's
    cores (defaultParallelism), so a small local run does not write hundreds of tiny files."""
    _prepare(spark)
    buckets = max(1, spark.sparkContext.defaultParallelism)
    return Warehouse(spark, f"circ_{label}_{uuid.uuid4().hex[:12]}", scratch_path(spark, label), buckets=buckets)


def _stored(spark: SparkSession, sf_dir: str, label: str) -> Warehouse:
    """A warehouse that the jobs have loaded: two inventory months, each followed by its loans."""
    wh = _warehouse(spark, label)
    inventory, codes, loans = _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir), fx.loans(spark, sf_dir)
    for lo, hi in RUNS:
        jobs.run_monthly(wh, inventory, codes, lo, hi, check=False)
        jobs.run_daily(wh, loans, lo, hi)
    return wh


def _all_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.inventory_source(spark, sf_dir)


# --- queries -----------------------------------------------------------------------------

def q_extract_window(spark, sf_dir):
    events = fx.read_table(spark, sf_dir, "events")
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    return extract_window(events, "ts", _oracle.EVENTS_LO, _oracle.EVENTS_HI, cols)


def q_extract_window_midnight(spark, sf_dir):
    li = fx.read_table(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    return extract_window(li, "l_shipdate", _oracle.SHIP_LO, _oracle.SHIP_HI, cols)


def q_extract_size(spark, sf_dir):
    li = fx.read_table(spark, sf_dir, "lineitem")
    return extract_size(li, "l_shipdate", _oracle.SHIP_LO, _oracle.SHIP_HI)


def q_union_slices(spark, sf_dir):
    loans = fx.loans(spark, sf_dir)
    cols = ["id", "bibnumber", "checkoutdatetime"]
    return union_slices(extract_window(loans, "checkoutdatetime", lo, hi, cols) for lo, hi in RUNS)


def q_extract_window_text(spark, sf_dir):
    loans = fx.loans(spark, sf_dir)
    cols = ["id", "bibnumber", "checkoutdatetime"]
    return extract_window(loans, "checkoutdatetime", _oracle.SHIP_LO, _oracle.SHIP_HI, cols)


def q_extract_indexed(spark, sf_dir):
    """S2 over a parquet source with text stamps: files that cannot hold rows of the window are not opened."""
    _prepare(spark)
    loans, source, index = fx.loans(spark, sf_dir), scratch_path(spark, "loans"), scratch_path(spark, "loans-index")
    loans.write.parquet(source)
    update_stamp_index(spark, source, loans.schema, "checkoutdatetime", index)
    rows = read_indexed(spark, source, loans.schema, index, _oracle.SHIP_LO, _oracle.SHIP_HI)
    cols = ["id", "bibnumber", "checkoutdatetime"]
    return extract_window(rows, "checkoutdatetime", _oracle.SHIP_LO, _oracle.SHIP_HI, cols)


def q_delimited_roundtrip(spark, sf_dir):
    _prepare(spark)
    docs = fx.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "delimited")
    write_delimited(docs, path)
    return read_delimited(spark, path, docs.schema)


def q_delimited_split_scan(spark, sf_dir):
    """S1 on files that several tasks may share: records put together from lines by quote parity."""
    _prepare(spark)
    docs = fx.read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "delimited-split")
    write_delimited(docs, path)
    return read_split_delimited(spark, path, docs.schema)


def q_explode_tokens(spark, sf_dir):
    return model.subject_tokens(_all_inventory(spark, sf_dir))


def q_explode_tokens_keep(spark, sf_dir):
    distinct = _all_inventory(spark, sf_dir).selectExpr("subjects AS subjects_string").distinct()
    return explode_tokens(distinct, "subjects_string", "subject", keep=True)


def q_first_per_key(spark, sf_dir):
    return model.canonical_inventory(_all_inventory(spark, sf_dir))


def q_dim_time(spark, sf_dir):
    return model.new_dim_time(fx.loans(spark, sf_dir))


def q_dim_collections(spark, sf_dir):
    return model.dim_collections(fx.codes(spark, sf_dir))


def q_dim_subject_batch1(spark, sf_dir):
    _prepare(spark)
    tokens = model.subject_tokens(fx.inventory(spark, sf_dir, 1))
    return model.new_dim_subject(tokens, empty(spark, schemas.DIM_SUBJECT))


def q_dim_subject_batch2(spark, sf_dir):
    return build_months(spark, sf_dir).dim_subject


def q_dim_books_batch2(spark, sf_dir):
    return build_months(spark, sf_dir).dim_books


def q_bridge_subject(spark, sf_dir):
    return build_months(spark, sf_dir).bridge_subject


def q_fact_loans(spark, sf_dir):
    """Each month's loans against the canonical rows of that month."""
    days = [model.fact_rows(fx.loans(spark, sf_dir, m), model.canonical_inventory(fx.inventory(spark, sf_dir, m)))
            for m in (1, 2)]
    return days[0].unionByName(days[1])


def q_dim_time_batches(spark, sf_dir):
    first = model.new_dim_time(fx.loans(spark, sf_dir, 1))
    return first.unionByName(model.new_dim_time(fx.loans(spark, sf_dir, 2), first))


def q_date_bounds(spark, sf_dir):
    wh = _stored(spark, sf_dir, "bounds")
    return marts.date_bounds(wh.scan("fact_loans"), wh.load_days())


def q_loans_per_day(spark, sf_dir):
    wh = _stored(spark, sf_dir, "per_day")
    return marts.loans_per_day(wh.scan("fact_loans"), MART_LO, MART_HI, wh.load_days())


def q_loans_per_day_all(spark, sf_dir):
    wh = _stored(spark, sf_dir, "per_day_all")
    return marts.loans_per_day(wh.scan("fact_loans"), days=wh.load_days())


def q_stream_fact_loans(spark, sf_dir):
    """The whole inventory loaded by the monthly job, then every loan landed by year-end run date (one
    write) and loaded by the catch-up stream."""
    from circulation.streaming import start_daily_catchup

    wh = _warehouse(spark, "stream")
    jobs.run_monthly(wh, _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir), RUNS[0][0], RUNS[1][1])
    loans = fx.loans(spark, sf_dir)
    # The loans of 31 December belong to that day's run: its midnight closes the window.
    year = F.year(F.col("checkoutdatetime").cast("timestamp_ntz"))
    landing = scratch_path(spark, "stream-landing")
    write_delimited(loans.withColumn("run_date", F.make_date(year, F.lit(12), F.lit(31))), landing, partition_by=["run_date"],
                    compression=LANDING_COMPRESSION)
    query = start_daily_catchup(wh, landing, scratch_path(spark, "stream-ckpt"))
    query.awaitTermination()
    return wh.scan("fact_loans")


def _subjects(summary: bool):
    def run(spark, sf_dir):
        wh = _stored(spark, sf_dir, "subjects")
        return marts.popular_subjects(wh.scan("fact_loans"), wh.scan("bridge_subject"), wh.scan("dim_subject"),
                                      MART_LO, MART_HI, days=wh.load_days() if summary else None)
    return run


def _titles(summary: bool):
    def run(spark, sf_dir):
        wh = _stored(spark, sf_dir, "titles")
        return marts.popular_titles(wh.scan("fact_loans"), wh.scan("dim_books"), MART_LO, MART_HI,
                                    days=wh.load_days() if summary else None)
    return run


def _refresh(part: str):
    def run(spark, sf_dir):
        wh = _stored(spark, sf_dir, "refresh")
        return marts.refresh(wh.scan("fact_loans"), wh.scan("bridge_subject"), wh.scan("dim_subject"),
                             wh.scan("dim_books"), MART_LO, MART_HI, wh.load_days())[part]
    return run


def q_quality_gate(spark, sf_dir):
    wh = _stored(spark, sf_dir, "gate")
    counts = row_count_checks({t: wh.scan(t) for t in ("dim_books", "dim_collections", "bridge_subject", "dim_subject")})
    return counts.unionByName(scalar_checks([
        orphan_check(wh.scan("fact_loans"), wh.scan("dim_books"), "bibnumber", "bibnum", "loans_without_book"),
        duplicate_check(wh.scan("dim_books"), "bibnum", "repeated_books"),
    ]))


def q_load_counts(spark, sf_dir):
    return _stored(spark, sf_dir, "counts").counts(
        ["dim_time", "dim_books", "dim_collections", "dim_subject", "bridge_subject", "fact_loans", "fact_load_days"])


def q_replace_load(spark, sf_dir):
    wh = _warehouse(spark, "replace")
    rows = model.dim_collections(fx.codes(spark, sf_dir))
    wh.replace("dim_collections", rows)
    wh.replace("dim_collections", rows)
    return wh.scan("dim_collections")


def q_append_load(spark, sf_dir):
    wh = _warehouse(spark, "append")
    wh.create("dim_books")
    for batch in (1, 2):
        canonical = model.canonical_inventory(fx.inventory(spark, sf_dir, batch))
        wh.append("dim_books", model.new_dim_books(canonical, wh.scan("dim_books")))
    return wh.scan("dim_books")


def q_replace_landing(spark, sf_dir):
    """One run date's folder written twice with different loans, then read."""
    path = scratch_path(spark, "replace-landing") + "/run_date=1998-06-30"
    for batch in (1, 2):
        write_delimited(fx.loans(spark, sf_dir, batch), path)
    return read_delimited(spark, path, schemas.STAGING_LOANS).select("id", "bibnumber", "checkoutdatetime")


def q_drop_tables(spark, sf_dir):
    """Month 1 loaded, one staging table dropped, what is left counted; then all dropped and listed."""
    wh = _warehouse(spark, "drop")
    jobs.run_monthly(wh, _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir), *RUNS[0], check=False)
    wh.drop("staging_inventory")
    left = materialise(wh.counts(wh.tables()), "drop-left")
    wh.drop_all()
    return left.unionByName(spark.createDataFrame([("after drop_all", len(wh.tables()))], "table string, rows long"))


def q_rerun_replaces_day(spark, sf_dir):
    """The second run loaded, then loaded again corrected, when no loan finds its book: nothing of it stays."""
    wh = _warehouse(spark, "rerun")
    loans = fx.loans(spark, sf_dir)
    jobs.run_monthly(wh, _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir), RUNS[0][0], RUNS[1][1], check=False)
    for lo, hi in RUNS:
        jobs.run_daily(wh, loans, lo, hi)
    jobs.run_daily(wh, loans.withColumn("bibnumber", -1 - F.col("bibnumber")), *RUNS[1])
    return wh.scan("fact_loans").drop("load_date")


def q_late_row_in_range(spark, sf_dir):
    """All loans stored under the first run date, most of them stamped after it: a range counts them all."""
    wh = _warehouse(spark, "late")
    wh.replace_run(RUNS[0][1], model.fact_rows(fx.loans(spark, sf_dir), model.canonical_inventory(_all_inventory(spark, sf_dir))))
    fact, days = wh.scan("fact_loans"), wh.load_days()
    per_day = marts.loans_per_day(fact, _oracle.LATE_LO, _oracle.LATE_HI, days)
    rows = marts.in_range(fact, _oracle.LATE_LO, _oracle.LATE_HI, days).agg(F.count(F.lit(1)).alias("count"))
    return per_day.unionByName(rows.select(F.lit(None).cast("date").alias("date"), "count"))


def q_empty_month_keeps_state(spark, sf_dir):
    """Month 1, then an empty month that is allowed, then month 1's loans: they still find their books."""
    wh = _warehouse(spark, "empty")
    inventory, codes = _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir)
    jobs.run_monthly(wh, inventory, codes, *RUNS[0], check=False)
    jobs.run_monthly(wh, inventory, codes.where("false"), "2200-01-01", "2200-02-01", allow_empty=True, check=False)
    jobs.run_daily(wh, fx.loans(spark, sf_dir), *RUNS[0])
    return wh.scan("fact_loans").drop("load_date")


def q_pipeline_subjects(spark, sf_dir):
    """Both jobs over the typed landing and the delimited one, then the flagship mart."""
    wh = _warehouse(spark, "pipeline")
    landing = scratch_path(spark, "landing")
    inventory, codes, loans = _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir), fx.loans(spark, sf_dir)
    for lo, hi in RUNS:
        jobs.run_monthly(wh, inventory, codes, lo, hi, landing=landing)
        land_typed(extract_window(loans, "checkoutdatetime", lo, hi), landing, "typed_loans", hi, "checkoutdatetime")
        landed = read_landed(spark, landing, "typed_loans", schemas.STAGING_LOANS, "checkoutdatetime")
        jobs.run_daily(wh, landed, lo, hi, landing=landing)
    return marts.popular_subjects(wh.scan("fact_loans"), wh.scan("bridge_subject"), wh.scan("dim_subject"),
                                  MART_LO, MART_HI, days=wh.load_days())


def q_publish_after_checks(spark, sf_dir):
    """Month 1, then month 2 with a check that fails: every table stays that of month 1."""
    wh = _warehouse(spark, "publish")
    inventory, codes = _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir)
    jobs.run_monthly(wh, inventory, codes, *RUNS[0])

    def no_new_books(view):
        return [orphan_check(view.scan("dim_books"), held, "bibnum", "bibnum", "books_that_are_new")]

    held = wh.scan("dim_books")
    try:
        jobs.run_monthly(wh, inventory, codes, *RUNS[1], checks=no_new_books)
    except QualityError:
        return wh.scan("dim_subject")
    raise RuntimeError("the run was published although its check failed")


def q_empty_run_report(spark, sf_dir):
    """Two run dates without loans beside the others: the report reads them as empty runs and writes nothing."""
    wh = _stored(spark, sf_dir, "empty_runs")
    for day in ("2200-01-01", "2200-01-02"):
        jobs.run_daily(wh, fx.loans(spark, sf_dir), day, day, allow_empty=True)
    return marts.dashboard(wh.snapshot())["loans_per_day"]


def q_catchup_months(spark, sf_dir):
    """Month 1 loaded, then all missed runs of both schedules caught up in their order."""
    wh = _warehouse(spark, "catchup")
    inventory, codes, loans = _all_inventory(spark, sf_dir), fx.codes(spark, sf_dir), fx.loans(spark, sf_dir)
    jobs.run_monthly(wh, inventory, codes, *RUNS[0], check=False)
    ends = [hi for _, hi in RUNS]
    jobs.catch_up(wh, inventory, codes, loans, ends, ends)
    return wh.scan("fact_loans").drop("load_date")


def q_rolled_subjects(spark, sf_dir):
    """The dashboard's subjects from the stored roll-ups, without a scan of facts."""
    return marts.rolled_subjects(_stored(spark, sf_dir, "rolled").snapshot(), MART_LO, MART_HI)


def q_rolled_titles(spark, sf_dir):
    """The dashboard's titles from the stored roll-ups by the three-phase top-k (C11)."""
    return marts.rolled_titles(_stored(spark, sf_dir, "rolled").snapshot(), MART_LO, MART_HI)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "extract_window": q_extract_window,
    "extract_window_midnight": q_extract_window_midnight,
    "extract_size": q_extract_size,
    "union_slices": q_union_slices,
    "extract_window_text": q_extract_window_text,
    "extract_indexed": q_extract_indexed,
    "delimited_roundtrip": q_delimited_roundtrip,
    "delimited_split_scan": q_delimited_split_scan,
    "explode_tokens": q_explode_tokens,
    "explode_tokens_keep": q_explode_tokens_keep,
    "first_per_key": q_first_per_key,
    "dim_time": q_dim_time,
    "dim_collections": q_dim_collections,
    "dim_subject_batch1": q_dim_subject_batch1,
    "dim_subject_batch2": q_dim_subject_batch2,
    "dim_books_batch2": q_dim_books_batch2,
    "bridge_subject": q_bridge_subject,
    "fact_loans": q_fact_loans,
    "date_bounds": q_date_bounds,
    "loans_per_day": q_loans_per_day,
    "loans_per_day_all": q_loans_per_day_all,
    "dim_time_batches": q_dim_time_batches,
    "stream_fact_loans": q_stream_fact_loans,
    "popular_subjects": _subjects(True),
    "popular_subjects_preagg": _subjects(False),
    "popular_titles": _titles(True),
    "popular_titles_preagg": _titles(False),
    "refresh_loans_per_day": _refresh("loans_per_day"),
    "refresh_popular_subjects": _refresh("popular_subjects"),
    "refresh_popular_titles": _refresh("popular_titles"),
    "quality_gate": q_quality_gate,
    "replace_load": q_replace_load,
    "append_load": q_append_load,
    "pipeline_subjects": q_pipeline_subjects,
    "load_counts": q_load_counts,
    "replace_landing": q_replace_landing,
    "drop_tables": q_drop_tables,
    "rerun_replaces_day": q_rerun_replaces_day,
    "late_row_in_range": q_late_row_in_range,
    "empty_month_keeps_state": q_empty_month_keeps_state,
    "publish_after_checks": q_publish_after_checks,
    "empty_run_report": q_empty_run_report,
    "catchup_months": q_catchup_months,
    "rolled_subjects": q_rolled_subjects,
    "rolled_titles": q_rolled_titles,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top subjects (the group bridge) over the sf0.001 tables."""
    _prepare(spark)
    return _subjects(True)(spark, SMOKE_DIR)


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


try:  # the training-data operators are optional: the rest works without their folders
    import corpus_pipeline
    from circulation.llm import queries as _llm
except ModuleNotFoundError as missing:
    # Only their own absence is allowed: a library that is not installed fails the import.
    if not f"{missing.name}.".startswith(("corpus_pipeline.", "circulation.llm.")):
        raise
    _llm = corpus_pipeline = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: _prepared(fn) for name, fn in _QUERIES.items()}
    if _llm:
        found |= {name: _prepared(fn) for name, fn in _llm.QUERIES.items()} | {"pipeline": _prepared(corpus_pipeline.run)}
    return found


def oracle_sql() -> dict[str, str]:
    found = _oracle.oracle_sql()
    if _llm:
        found |= _llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
