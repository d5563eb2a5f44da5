"""Daily loads as a catch-up stream over the loan landing zone (C14 with scheduler catch-up).

Each run date lands its loans under ``<landing>/run_date=YYYY-MM-DD/``. A file stream with
``trigger(availableNow=True)`` finds the files not yet processed (progress is kept in the stream
checkpoint on shared storage); it reads their names only. Every run date with a new file is then
loaded whole from its folder, once, replacing its ``load_date`` partition, so a replayed micro-batch, or a
run date whose files arrive across two runs, writes the same result again instead of duplicating rows.

Nothing is left out in silence: a file outside a ``run_date=`` folder, and loans stamped after their
run date, fail the stream with their number.
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from circulation import schemas
from circulation.plans.jobs import load_loans
from circulation.session import ensure_checkpoint_dir
from circulation.sinks import Warehouse
from circulation.sources import read_delimited
from circulation.sources.extract import RUN_DATE, window_predicate

log = logging.getLogger(__name__)

_FOLDER = re.compile(rf"/{RUN_DATE}=(\d{{4}}-\d{{2}}-\d{{2}})/")
_FILES = "path string, modificationTime timestamp, length long, content binary"


class LateLoansError(Exception):
    pass


def load_run_date(wh: Warehouse, landing: str, run_date: str, landed: str = "delimited") -> int:
    """Load one run date from its landing folder: staged once, checked, then its partition replaced and published.
    ``landed`` is the folder's format: ``delimited`` text or the ``typed`` landing."""
    folder = f"{landing.rstrip('/')}/{RUN_DATE}={run_date}"
    with wh.transaction():
        wh.create_all()
        if landed == "typed":
            loans = wh.spark.read.schema(schemas.STAGING_LOANS).parquet(folder)
        else:
            loans = read_delimited(wh.spark, folder, schemas.STAGING_LOANS)
        wh.replace("staging_loans", loans)
        staged = wh.scan("staging_loans")
        inside = window_predicate(staged, "checkoutdatetime", None, run_date)
        seen = staged.agg(F.count_if(~inside).alias("late"), F.count_if(inside.isNull()).alias("blank")).first()
        if seen["late"]:
            raise LateLoansError(f"run date {run_date}: {seen['late']} loans are stamped after it")
        log.info("run date %s: %d loans without a stamp are in no window", run_date, seen["blank"])
        return load_loans(wh, staged.where(inside), run_date)


def load_run_dates(wh: Warehouse, landing: str, run_dates: list[str], landed: str = "delimited") -> int:
    return sum(load_run_date(wh, landing, d, landed) for d in run_dates)


def default_checkpoint(wh: Warehouse) -> str:
    """Where the stream keeps its progress, stable across processes: under the warehouse
    location, else under the configured checkpoint base (the per-application dir that
    ``getCheckpointDir`` returns changes with every run, which would restart the catch-up)."""
    if wh.location is not None:
        return f"{wh.location}/_streams/daily_catchup"
    base = wh.spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(wh.spark)
    return f"{base.rstrip('/')}/streams/{wh.database}_daily_catchup"


def start_daily_catchup(
    wh: Warehouse,
    landing: str,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int | None = None,
    landed: str = "delimited",
) -> StreamingQuery:
    """Start the stream; with ``availableNow`` it stops once every landed file is processed.

    Only names are streamed, so one micro-batch over all new files is cheap; with
    ``max_files_per_trigger`` below a folder's files that folder is loaded once per micro-batch."""
    wh.create_all()
    if checkpoint_location is None:
        checkpoint_location = default_checkpoint(wh)
    reader = wh.spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    paths = reader.load(landing).select("path")

    def process(batch: DataFrame, _epoch: int) -> None:
        run_date = F.regexp_extract("path", _FOLDER.pattern, 1).alias(RUN_DATE)
        # One row per run date in this micro-batch: a handful of dates, never loan rows.
        found = {r[RUN_DATE]: r["n"] for r in batch.groupBy(run_date).agg(F.count(F.lit(1)).alias("n")).collect()}
        if "" in found:
            raise ValueError(f"{found['']} landed files are in no {RUN_DATE}=YYYY-MM-DD folder")
        load_run_dates(wh, landing, sorted(found), landed)

    return (
        paths.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
