"""The star schema as DataFrame state: apply inventory months and loan days without tables.

``jobs`` does the same against stored tables; this form lets every builder be checked
against plain SQL on static inputs, with the previous state passed in as DataFrames.

Each step writes only the rows it adds (to the shared scratch folder) and unions them
onto the previous state, so lineage stays one scan per step instead of re-running every
earlier month, and no step rewrites the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from circulation import schemas
from circulation.plans import model
from circulation.session import materialise


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Star:
    dim_subject: DataFrame
    bridge_subject: DataFrame
    dim_books: DataFrame
    dim_collections: DataFrame
    dim_time: DataFrame
    fact_loans: DataFrame
    canonical: DataFrame | None = None  # canonical rows of the latest inventory month

    @staticmethod
    def empty(spark: SparkSession) -> Star:
        return Star(
            dim_subject=empty(spark, schemas.DIM_SUBJECT),
            bridge_subject=empty(spark, schemas.BRIDGE_SUBJECT),
            dim_books=empty(spark, schemas.DIM_BOOKS),
            dim_collections=empty(spark, schemas.DIM_COLLECTIONS),
            dim_time=empty(spark, schemas.DIM_TIME),
            fact_loans=empty(spark, schemas.FACT_LOANS),
        )


def _cut(df: DataFrame, materialize: bool) -> DataFrame:
    return materialise(df, "star") if materialize else df


def apply_month(star: Star, inventory: DataFrame, codes: DataFrame | None = None, materialize: bool = True) -> Star:
    """Monthly load: collections (replaced), books, subjects, then the bridge."""
    canonical = _cut(model.canonical_inventory(inventory), materialize)
    tokens = _cut(model.subject_tokens(inventory), materialize)
    dim_subject = star.dim_subject.unionByName(_cut(model.new_dim_subject(tokens, star.dim_subject), materialize))
    new_links = model.new_bridge(inventory, dim_subject, star.bridge_subject)
    bridge = star.bridge_subject.unionByName(_cut(new_links, materialize))
    dim_books = star.dim_books.unionByName(_cut(model.new_dim_books(canonical, star.dim_books), materialize))
    collections = model.dim_collections(codes) if codes is not None else star.dim_collections
    return replace(
        star,
        dim_subject=dim_subject,
        bridge_subject=bridge,
        dim_books=dim_books,
        dim_collections=collections,
        canonical=canonical,
    )


def apply_day(star: Star, loans: DataFrame, materialize: bool = True) -> Star:
    """Daily load: fact rows against the latest inventory month, and new loan days."""
    if star.canonical is None:
        raise ValueError("no inventory month loaded yet: the fact load needs one")
    fact = star.fact_loans.unionByName(_cut(model.fact_rows(loans, star.canonical), materialize))
    dim_time = star.dim_time.unionByName(_cut(model.new_dim_time(loans, star.dim_time), materialize))
    return replace(star, fact_loans=fact, dim_time=dim_time)
