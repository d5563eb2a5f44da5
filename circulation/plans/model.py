"""Star-schema builders C1-C7: DataFrames in, new rows out. Nothing here writes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circulation.constants import SUBJECT_SEPARATOR
from circulation.functions import date_parts, day_of, group_key, time_key
from circulation.operators import assign_ids, explode_tokens, first_per_key, lookup_join, only_new

# Order that picks the canonical inventory row of a book: smallest itemcount (NULL last),
# then a tie-break on the fields the outputs carry, so dim_books and fact_loans agree.
CANONICAL_ORDER_COLUMNS = ("title", "publisher", "author", "subjects")


def canonical_order() -> list[Column]:
    return [F.col("itemcount").asc_nulls_last()] + [F.col(c).asc_nulls_first() for c in CANONICAL_ORDER_COLUMNS]


def canonical_inventory(inventory: DataFrame) -> DataFrame:
    """First inventory row per ``bibnum`` (W2). Compute once and feed C5 and C7."""
    cols = ["bibnum", "itemcount", *CANONICAL_ORDER_COLUMNS]
    return first_per_key(inventory.select(*cols), ["bibnum"], canonical_order()).drop("itemcount")


def subject_tokens(inventory: DataFrame, na_values: Iterable[str] | None = None) -> DataFrame:
    """C1 ``staging_exploded_subjects``: each distinct subjects string once, one row per token.

    De-duplicating before the explode keeps the explode proportional to distinct strings,
    and the partial aggregate of ``distinct`` absorbs a string held by a third of the rows.
    """
    distinct = inventory.select(F.col("subjects").alias("subjects_string")).distinct()
    return explode_tokens(distinct, "subjects_string", "subject", sep=SUBJECT_SEPARATOR, na_values=na_values)


def new_dim_time(loans: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per loan day with its parts. With ``existing`` only days not yet present."""
    days = loans.select(day_of("checkoutdatetime").alias("_day")).where(F.col("_day").isNotNull()).distinct()
    rows = days.select(time_key(F.col("_day")).alias("time_key"), *date_parts(F.col("_day")))
    return only_new(rows, existing, "time_key") if existing is not None else rows


def dim_collections(codes: DataFrame) -> DataFrame:
    """Codes with a non-empty category group (NULL is dropped too); full replace."""
    return codes.where(F.col("category_group") != "").select(
        "code", F.col("category_group").alias("item_type")
    )


def new_dim_subject(tokens: DataFrame, dim_subject: DataFrame) -> DataFrame:
    """C4: subjects not yet in ``dim_subject`` with ids max+1.. in subject order."""
    distinct = tokens.select("subject").distinct()
    return assign_ids(only_new(distinct, dim_subject, "subject"), "subject", "subject_id", dim_subject)


def new_dim_books(canonical: DataFrame, dim_books: DataFrame) -> DataFrame:
    """Canonical rows of books not yet in ``dim_books`` (first writer wins)."""
    return only_new(canonical, dim_books, "bibnum").select("bibnum", "title", "publisher", "author")


def new_bridge(inventory: DataFrame, dim_subject: DataFrame, bridge: DataFrame,
               na_values: Iterable[str] | None = None) -> DataFrame:
    """Bridge rows of subject groups not yet in the bridge, with subject ids looked up.

    The distinct subjects strings meet the distinct group ids of the bridge before they are exploded,
    so only new groups' tokens are ever made. ``dim_subject`` must already hold this batch's new subjects.
    """
    strings = inventory.select(F.col("subjects").alias("subjects_string")).distinct()
    keyed = strings.withColumn("subject_group_id", group_key("subjects_string"))
    fresh = only_new(keyed, bridge.select("subject_group_id").distinct(), "subject_group_id")
    tokens = explode_tokens(fresh, "subjects_string", "subject", sep=SUBJECT_SEPARATOR, na_values=na_values)
    joined = lookup_join(tokens, dim_subject.select("subject", "subject_id"), "subject", "left")
    return joined.select("subject_group_id", F.col("subject_id").cast("long"), "subjects_string")


def fact_rows(loans: DataFrame, canonical: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One fact row per loan whose book is in the inventory; the subject group comes from
    the inventory's canonical row, not the loan's own subjects. The group key is hashed on the
    inventory side (one per book) before the join, not once per loan. ``carry`` names extra
    loan columns (such as a load date) passed through to the output."""
    books = canonical.select(
        F.col("bibnum").alias("bibnumber"), group_key("subjects").alias("subject_group_id")
    )
    slim = loans.select("id", "checkoutdatetime", "itemtype", "collection", "bibnumber", *carry)
    joined = lookup_join(slim, books, "bibnumber", "inner")
    return joined.select(
        "id",
        time_key(day_of("checkoutdatetime")).alias("time_key"),
        "itemtype",
        "collection",
        "bibnumber",
        "subject_group_id",
        *carry,
    )
