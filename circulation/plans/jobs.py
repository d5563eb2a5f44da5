"""C13 monthly and C14 daily jobs: ordered calls of the builders against a Warehouse.

Sources are DataFrames over the landing zone (or any dated table): the window extract picks
the run's slice, so a job is re-runnable for any ``(prev_run_date, run_date]``.

Each job is one transaction: it stages its extract (counted by the write that stages it), builds on what it staged, runs
its checks, and only then publishes all its tables together. A run that fails, or is killed, between any two steps
leaves what was published before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circulation import schemas
from circulation.constants import LANDING_COMPRESSION, QUALITY_MINIMUM_ROWS, QUALITY_TABLES
from circulation.functions.dates import DateLike, as_date
from circulation.plans import model
from circulation.plans.quality import Check, duplicate_check, enforce, scalar_checks
from circulation.sinks import CANONICAL, Snapshot, Warehouse, write_delimited
from circulation.sources import EmptyExtractError, extract_window, read_delimited

Checks = Callable[[Snapshot], Sequence[Check]]


def _land(wh: Warehouse, df: DataFrame, landing: str | None, dataset: str, run_date: DateLike, schema) -> DataFrame:
    """Optional landing round trip: write the run's files (replacing them; compressed, as text takes many times what is staged
    from it) and stage from them."""
    if landing is None:
        return df
    path = f"{landing.rstrip('/')}/{dataset}/run_date={as_date(run_date).isoformat()}"
    write_delimited(df, path, compression=LANDING_COMPRESSION)
    return read_delimited(wh.spark, path, schema)


def _stage(wh: Warehouse, table: str, rows: DataFrame, what: str, allow_empty: bool, keep: bool) -> int:
    """The extract is read once: the write that stages it counts it. No rows stop the run unless they may be none."""
    n = wh.replace(table, rows, keep_if_empty=keep)
    if n == 0 and not allow_empty:
        raise EmptyExtractError(f"{what}: the extract window holds no rows")
    return n


def standing_checks(view: Snapshot) -> list[Check]:
    """Each checked table has rows (counted as they were written) and no subject id is used twice."""
    counts = [Check(t, view.wh.spark.range(1).select(F.lit(view.row_count(t)).alias("value")), QUALITY_MINIMUM_ROWS) for t in QUALITY_TABLES]
    return [*counts, duplicate_check(view.scan("dim_subject"), "subject_id", "repeated_subject_ids")]


def run_monthly(
    wh: Warehouse,
    inventory_source: DataFrame,
    codes_source: DataFrame,
    prev_run_date: DateLike,
    run_date: DateLike,
    landing: str | None = None,
    allow_empty: bool = False,
    check: bool = True,
    na_values: Iterable[str] | None = None,
    checks: Checks | None = None,
) -> list[tuple[str, int, bool]]:
    """Codes -> dim_collections; inventory -> dim_books, dim_subject, bridge_subject; checks; publish.

    An empty extract stops the run; with ``allow_empty`` it changes nothing: the last month's canonical rows and the
    last collections stay. ``checks`` states checks of the caller's own over what the run would publish, beside the
    standing ones (``check=False`` leaves those out); if any fails nothing is published.

    ``na_values`` lists subjects strings that count as missing in the split (for parity with
    readers that turn words such as ``NA`` into missing values); the fact still hashes them.
    """
    inv_cols = schemas.STAGING_INVENTORY.fieldNames()
    inventory = extract_window(inventory_source, "reportdate", prev_run_date, run_date, inv_cols)
    with wh.transaction():
        wh.create_all()
        inventory = _land(wh, inventory, landing, "inventory", run_date, schemas.STAGING_INVENTORY)
        codes = _land(wh, codes_source.select(*schemas.STAGING_CODES.fieldNames()), landing, "codes", run_date, schemas.STAGING_CODES)

        if _stage(wh, "staging_codes", codes, "codes", allow_empty, keep=True):
            wh.replace("dim_collections", model.dim_collections(wh.scan("staging_codes")))
        if _stage(wh, "staging_inventory", inventory, "inventory", allow_empty, keep=True):
            staged = wh.scan("staging_inventory")
            wh.replace(CANONICAL, model.canonical_inventory(staged))
            wh.append("dim_books", model.new_dim_books(wh.scan(CANONICAL), wh.scan("dim_books")))
            wh.replace("staging_exploded_subjects", model.subject_tokens(staged, na_values))
            tokens = wh.scan("staging_exploded_subjects")
            wh.append("dim_subject", model.new_dim_subject(tokens, wh.scan("dim_subject")))
            bridge = model.new_bridge(staged, wh.scan("dim_subject"), wh.scan("bridge_subject"), na_values)
            wh.append("bridge_subject", bridge)
        wh.reach("monthly", run_date)

        view = wh.snapshot()
        wanted = [*(standing_checks(view) if check else []), *(checks(view) if checks else [])]
        return enforce(scalar_checks(wanted)) if wanted else []


def load_loans(wh: Warehouse, staged: DataFrame, run_date: DateLike, checks: Checks | None = None) -> int:
    """Staged loans -> this run date's facts (replaced, also by nothing) and new dim_time days, then the checks."""
    rows = wh.replace_run(run_date, model.fact_rows(staged, wh.scan(CANONICAL)))
    wh.append("dim_time", model.new_dim_time(staged, wh.scan("dim_time")))
    wh.drop("staging_loans")
    wh.reach("daily", run_date)
    if checks:
        enforce(scalar_checks(checks(wh.snapshot())))
    return rows


def run_daily(
    wh: Warehouse,
    loans_source: DataFrame,
    prev_run_date: DateLike,
    run_date: DateLike,
    landing: str | None = None,
    allow_empty: bool = False,
    checks: Checks | None = None,
) -> int:
    """Loans -> fact_loans (this run's load_date replaced, with ``allow_empty`` also by nothing) and new dim_time
    days, then the staging table is dropped. Returns the facts the run date now has."""
    loans = extract_window(loans_source, "checkoutdatetime", prev_run_date, run_date,
                           schemas.STAGING_LOANS.fieldNames())
    with wh.transaction():
        wh.create_all()
        loans = _land(wh, loans, landing, "loans", run_date, schemas.STAGING_LOANS)
        _stage(wh, "staging_loans", loans, "loans", allow_empty, keep=False)
        return load_loans(wh, wh.scan("staging_loans"), run_date, checks)


def missed(wh: Warehouse, job: str, run_dates: Iterable[DateLike]) -> list[tuple[str, str]]:
    """The windows (previous run date, run date) of a schedule after the last run that the warehouse has of ``job``. The first
    window of all begins before any date."""
    dates = sorted(as_date(d).isoformat() for d in run_dates)
    reached = wh.frontier.get(job, "")
    return [(lo, hi) for lo, hi in zip(["0001-01-01", *dates], dates) if hi > reached]


def month_ends(first: DateLike, last: DateLike) -> list[str]:
    """The last day of every month from ``first``'s to the last one that has ended by ``last``."""
    import datetime as dt

    out, year, month = [], as_date(first).year, as_date(first).month
    while True:
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
        end = dt.date(year, month, 1) - dt.timedelta(days=1)
        if end > as_date(last):
            return out
        out.append(end.isoformat())


def catch_up(
    wh: Warehouse,
    inventory_source: DataFrame,
    codes_source: DataFrame,
    loans_source: DataFrame,
    months: Iterable[DateLike],
    days: Iterable[DateLike],
    allow_empty: bool = True,
    checks: Checks | None = None,
) -> list[tuple[str, str]]:
    """Every missed run of both schedules in the order of their dates, the inventory of a date before its loans.

    Each run is published on its own and moves its job's frontier, so a catch-up that is stopped goes on where it
    was. Returns the runs made, as (job, run date)."""
    runs = [(hi, 0, lo) for lo, hi in missed(wh, "monthly", months)] + [(hi, 1, lo) for lo, hi in missed(wh, "daily", days)]
    for hi, kind, lo in sorted(runs):
        if kind == 0:
            run_monthly(wh, inventory_source, codes_source, lo, hi, allow_empty=allow_empty, check=not allow_empty, checks=checks)
        else:
            run_daily(wh, loans_source, lo, hi, allow_empty=allow_empty, checks=checks)
    return [(("monthly", "daily")[kind], hi) for hi, kind, _ in sorted(runs)]
