"""Dashboard marts C8-C11 over the star schema, with bound date literals.

Both top-k marts count before they fan out: loans are counted per subject group (or per
book) first, and only those counts meet the bridge (or ``dim_books``). The sum over joined
rows equals the plain ``count(*)`` of the reference's join, NULL groups included, while the
join shrinks from loans x subjects to groups x subjects and a hot group is one partial
aggregate per task instead of a skewed join key. ``preaggregate=False`` gives the plain form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circulation.constants import TOP_SUBJECTS, TOP_TITLES
from circulation.functions import midnight_lit
from circulation.functions.dates import DateLike, as_date
from circulation.operators import align_to_calendar, date_spine, lookup_join, top_k
from circulation.operators.dyadic import three_phase_top_k
from circulation.session import materialise
from circulation.sinks.warehouse import Snapshot


# Stored rows of titles up to which one sum over all of them is the shorter way.
ONE_PASS_ROWS = 2_000_000


def _day_range(day: str, lo: DateLike | None, hi: DateLike | None) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(day) >= F.lit(as_date(lo)))
    if hi is not None:
        cond = cond & (F.col(day) <= F.lit(as_date(hi)))
    return cond


def in_range(fact: DataFrame, lo: DateLike | None, hi: DateLike | None, days: DataFrame | None = None) -> DataFrame:
    """Inclusive ``[lo, hi]`` on ``time_key``.

    ``days`` is the stored summary (day, loans, load_date): only the partitions of run dates with a day in
    the range are read, whatever days a run date holds. The list has one entry per run date."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("time_key") >= midnight_lit(lo))
    if hi is not None:
        cond = cond & (F.col("time_key") <= midnight_lit(hi))
    if days is not None and (lo is not None or hi is not None):
        runs = [r["load_date"] for r in days.where(_day_range("day", lo, hi)).select("load_date").distinct().collect()]
        cond = cond & (F.col("load_date").isin(runs) if runs else F.lit(False))
    return fact.where(cond)


def date_bounds(fact: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """First and last loan day, from the stored summary if there is one."""
    if days is not None:
        return days.agg(F.min("day").cast("timestamp_ntz").alias("min_date"), F.max("day").cast("timestamp_ntz").alias("max_date"))
    return fact.agg(F.min("time_key").alias("min_date"), F.max("time_key").alias("max_date"))


def _series(bounds: DataFrame, daily: DataFrame, lo: DateLike | None, hi: DateLike | None) -> DataFrame:
    """Gap-filled (date, count) from the fact's (lo, hi) bounds and per-day counts."""
    spine = date_spine(bounds).where(_day_range("date", lo, hi))
    return align_to_calendar(spine, daily, "date", ["count"])


def _day_bounds(fact: DataFrame) -> DataFrame:
    return fact.agg(F.min("time_key").cast("date").alias("lo"), F.max("time_key").cast("date").alias("hi"))


def loans_per_day(fact: DataFrame, lo: DateLike | None = None, hi: DateLike | None = None,
                  days: DataFrame | None = None) -> DataFrame:
    """Loans per day, quiet days as 0. The calendar runs over the fact's own first to
    last day and is then cut to ``[lo, hi]``, so no zero rows appear outside the data.

    With the stored summary ``days`` the fact is not read at all. Without it Catalyst turns this into two narrow scans of ``time_key``: min/max over the column for the
    calendar bounds (partial aggregates, one row per task), and per-day counts with the range
    pushed into the scan, so a short range reads only the row groups it needs. The spine and the
    counts are a few thousand rows.
    """
    if days is not None:
        dated = days.where(F.col("day").isNotNull())
        counts = dated.where(_day_range("day", lo, hi)).groupBy(F.col("day").alias("date")).agg(F.sum("loans").alias("count"))
        return _series(dated.agg(F.min("day").alias("lo"), F.max("day").alias("hi")), counts, lo, hi)
    daily = (
        in_range(fact, lo, hi)
        .where(F.col("time_key").isNotNull())
        .groupBy(F.col("time_key").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _series(_day_bounds(fact), daily, lo, hi)


def _top_subjects(per_group: DataFrame, bridge: DataFrame, dim_subject: DataFrame, k: int) -> DataFrame:
    """Top-k subjects from loan counts per subject group (``subject_group_id``, ``_n``)."""
    links = bridge.select("subject_group_id", "subject_id")
    names = dim_subject.select("subject_id", "subject")
    # The stored bridge is bucketed by group: the join reads it without a shuffle. AQE broadcasts
    # a shuffled side that measures small. Counts are added up per id before they meet the names.
    fanned = per_group.join(links, "subject_group_id", "left").groupBy("subject_id").agg(F.sum("_n").alias("_n"))
    named = lookup_join(fanned, names, "subject_id", "left")
    counts = named.groupBy("subject").agg(F.sum("_n").cast("long").alias("count"))
    return top_k(counts, k, [F.col("count").desc(), F.col("subject").asc_nulls_first()])


def _top_titles(per_book: DataFrame, dim_books: DataFrame, k: int) -> DataFrame:
    """Top-k titles from loan counts per book (``bibnumber``, ``_n``)."""
    titles = dim_books.select(F.col("bibnum").alias("bibnumber"), "title")
    # Stored dim_books is bucketed by book: no shuffle of the lookup side (AQE broadcasts a
    # shuffled one that measures small).
    named = per_book.join(titles, "bibnumber", "left")
    counts = named.groupBy("title").agg(F.sum("_n").cast("long").alias("loan_numbers"))
    return top_k(counts, k, [F.col("loan_numbers").desc(), F.col("title").asc_nulls_first()])


def popular_subjects(
    fact: DataFrame,
    bridge: DataFrame,
    dim_subject: DataFrame,
    lo: DateLike | None = None,
    hi: DateLike | None = None,
    k: int = TOP_SUBJECTS,
    preaggregate: bool = True,
    days: DataFrame | None = None,
) -> DataFrame:
    """Top-k subjects by loans in ``[lo, hi]``; loans whose group has no bridge rows
    count under a NULL subject, which competes for the top k."""
    loans = in_range(fact, lo, hi, days)
    if preaggregate:
        per_group = loans.groupBy("subject_group_id").agg(F.count(F.lit(1)).alias("_n"))
        return _top_subjects(per_group, bridge, dim_subject, k)
    links = bridge.select("subject_group_id", "subject_id")
    names = dim_subject.select("subject_id", "subject")
    fanned = loans.select("subject_group_id").join(links, "subject_group_id", "left")
    named = fanned.join(names, "subject_id", "left")
    counts = named.groupBy("subject").agg(F.count(F.lit(1)).alias("count"))
    return top_k(counts, k, [F.col("count").desc(), F.col("subject").asc_nulls_first()])


def popular_titles(
    fact: DataFrame,
    dim_books: DataFrame,
    lo: DateLike | None = None,
    hi: DateLike | None = None,
    k: int = TOP_TITLES,
    preaggregate: bool = True,
    days: DataFrame | None = None,
) -> DataFrame:
    """C11: top-k titles by loans in ``[lo, hi]``; books sharing a title are merged."""
    loans = in_range(fact, lo, hi, days)
    if preaggregate:
        per_book = loans.groupBy("bibnumber").agg(F.count(F.lit(1)).alias("_n"))
        return _top_titles(per_book, dim_books, k)
    titles = dim_books.select(F.col("bibnum").alias("bibnumber"), "title")
    named = loans.select("bibnumber").join(titles, "bibnumber", "left")
    counts = named.groupBy("title").agg(F.count(F.lit(1)).alias("loan_numbers"))
    return top_k(counts, k, [F.col("loan_numbers").desc(), F.col("title").asc_nulls_first()])


def range_counts(fact: DataFrame, lo: DateLike | None = None, hi: DateLike | None = None,
                 days: DataFrame | None = None) -> DataFrame:
    """Loan counts of ``[lo, hi]`` per subject group and book, ``(subject_group_id, bibnumber, _n)``: a book
    has one group at a time, so this is about as many rows as books, and both top lists add up from it."""
    return in_range(fact, lo, hi, days).groupBy("subject_group_id", "bibnumber").agg(F.count(F.lit(1)).alias("_n"))


def dashboard(view: Snapshot, lo: DateLike | None = None, hi: DateLike | None = None) -> dict[str, DataFrame]:
    """The dashboard's four results (C8 to C11) of one published state, from the stored summaries: no fact is scanned
    if all of them are in the roll-ups (else those that are not come from the facts)."""
    days = view.load_days()
    return {
        "date_bounds": date_bounds(view.scan("fact_loans"), days),
        "loans_per_day": loans_per_day(view.scan("fact_loans"), lo, hi, days),
        "popular_subjects": rolled_subjects(view, lo, hi),
        "popular_titles": rolled_titles(view, lo, hi),
    }


def rolled_subjects(view: Snapshot, lo: DateLike | None = None, hi: DateLike | None = None, k: int = TOP_SUBJECTS) -> DataFrame:
    """C10 from the nodes of the range: a sum of O(log days) stored rows per group."""
    bridge, names, per_group = view.scan("bridge_subject"), view.scan("dim_subject"), view.group_counts(lo, hi)
    if per_group is None:
        return popular_subjects(view.scan("fact_loans"), bridge, names, lo, hi, k, days=view.load_days())
    return _top_subjects(per_group, bridge, names, k)


def rolled_titles(view: Snapshot, lo: DateLike | None = None, hi: DateLike | None = None, k: int = TOP_TITLES) -> DataFrame:
    """C11 from the nodes of the range by an exact three-phase top-k: the tail of rarely lent titles is never shuffled.
    Up to ``ONE_PASS_ROWS`` stored rows its extra passes cost more than one plain sum, which gives the same."""
    found = view.title_counts(lo, hi)
    if found is None:
        return popular_titles(view.scan("fact_loans"), view.scan("dim_books"), lo, hi, k, days=view.load_days())
    rows, n_nodes, most = found
    if most <= ONE_PASS_ROWS:
        sums = rows.groupBy("title").agg(F.sum("loans").cast("long").alias("loan_numbers"))
        return top_k(sums, k, [F.col("loan_numbers").desc(), F.col("title").asc_nulls_first()])
    return three_phase_top_k(rows, "title", "loans", ["level", "node"], n_nodes, k).withColumnRenamed("loans", "loan_numbers")


def refresh(
    fact: DataFrame,
    bridge: DataFrame,
    dim_subject: DataFrame,
    dim_books: DataFrame,
    lo: DateLike | None = None,
    hi: DateLike | None = None,
    days: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The dashboard's three results (C9, C10, C11) from one pass over the range's facts.

    The loans are counted per group and book once; the counts are written to the shared scratch folder and
    both top lists are built from them. The daily series comes from the stored summary ``days``."""
    counts = materialise(range_counts(fact, lo, hi, days), "refresh")

    def part(key: str) -> DataFrame:
        return counts.groupBy(key).agg(F.sum("_n").alias("_n"))

    return {
        "loans_per_day": loans_per_day(fact, lo, hi, days),
        "popular_subjects": _top_subjects(part("subject_group_id"), bridge, dim_subject, TOP_SUBJECTS),
        "popular_titles": _top_titles(part("bibnumber"), dim_books, TOP_TITLES),
    }
