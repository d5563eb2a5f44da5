"""Staging-shaped lending data derived from the driver tables (FIXTURES.md §2).

The driver tables hold no lending data, so loans come from ``lineitem``, inventory from
``lineitem`` joined to ``part`` and codes from ``nation`` and ``region``. Every row of the tables is
kept: quiet days, books that loans do not find and members that come with the second month are made by
moving rows (to another day, book number or report date), never by dropping them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from circulation import schemas

# Fixed values of the fixture mapping.
BATCH_SPLIT = _dt.datetime(1998, 7, 1)  # first day of the second inventory month
CLOSED_WEEKDAY = 2  # Spark dayofweek: 1 = Sunday, 2 = Monday -> Monday's loans count on Tuesday
MAX_HELD_SIZE = 40  # parts over this size are held under another book number
OTHER_BOOK_NUMBERS = 1_000_000_000  # added to the number of such parts
MONTH2_PUBLISHER_SUFFIX = "5"  # brands ending in 5 are first reported in month 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _iso_midnight(ts: str) -> Column:
    return F.concat(F.col(ts).cast("date").cast("string"), F.lit("T00:00:00.000"))


def _conform(df: DataFrame, schema) -> DataFrame:
    cols = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def loans(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    """``staging_loans`` rows: one per shipped line item; a closed day's on the day after."""
    li = read_table(spark, sf_dir, "lineitem")
    next_day = F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")
    li = li.withColumn("l_shipdate", F.when(F.dayofweek("l_shipdate") == CLOSED_WEEKDAY, next_day).otherwise(F.col("l_shipdate")))
    split = F.lit(BATCH_SPLIT).cast("timestamp_ntz")
    if batch == 1:
        li = li.where(F.col("l_shipdate") < split)
    elif batch == 2:
        li = li.where(F.col("l_shipdate") >= split)
    out = li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_partkey").alias("bibnumber"),
        F.col("l_returnflag").alias("itemtype"),
        F.col("l_linestatus").alias("collection"),
        _iso_midnight("l_shipdate").alias("checkoutdatetime"),
    )
    return _conform(out, schemas.STAGING_LOANS)


def subjects_expr() -> Column:
    """Comma-joined subjects with blanks after commas, empty strings and repeated tokens."""
    words = F.regexp_replace(F.col("p_name"), " ", ", ")
    repeat = F.when(F.col("p_size") % 7 == 0, F.concat(F.lit(","), F.col("p_type"))).otherwise(F.lit(""))
    full = F.concat(words, F.lit(","), F.col("p_type"), F.lit(","), F.col("p_brand"), repeat)
    return F.when(F.col("p_size") % 10 == 0, F.lit("")).otherwise(full)


def inventory(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    """``staging_inventory`` rows, one per line item. ``batch`` 1 or 2 gives one inventory month; some
    publishers' rows are all reported in month 2, which so adds members."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_shipdate",
        F.when(F.col("l_linenumber") == 7, _null("int")).otherwise(F.col("l_quantity").cast("int")).alias("itemcount"),
    )
    split = F.lit(BATCH_SPLIT).cast("timestamp_ntz")
    part = read_table(spark, sf_dir, "part")
    late = F.col("p_brand").endswith(MONTH2_PUBLISHER_SUFFIX) & (F.col("l_shipdate") < split)
    joined = li.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "l_shipdate", F.when(late, split).otherwise(F.col("l_shipdate")))
    if batch == 1:
        joined = joined.where(F.col("l_shipdate") < split)
    elif batch == 2:
        joined = joined.where(F.col("l_shipdate") >= split)
    held = F.col("p_size") <= MAX_HELD_SIZE
    out = joined.select(
        F.when(held, F.col("l_partkey")).otherwise(F.col("l_partkey") + OTHER_BOOK_NUMBERS).alias("bibnum"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("l_suppkey").cast("string")).alias("title"),
        F.col("p_brand").alias("publisher"),
        F.col("p_type").alias("author"),
        F.col("l_suppkey").cast("string").alias("itemlocation"),
        "itemcount",
        _iso_midnight("l_shipdate").alias("reportdate"),
        subjects_expr().alias("subjects"),
    )
    return _conform(out, schemas.STAGING_INVENTORY)


def inventory_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both inventory months as one dated source, for window extracts by ``reportdate``."""
    return inventory(spark, sf_dir).where(F.col("reportdate").isNotNull())  # rows without a date are in no month


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``staging_codes`` rows: one per nation, with empty and NULL category groups."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    group = (
        F.when(F.col("n_regionkey") == 0, F.lit(""))
        .when(F.col("n_regionkey") == 1, _null("string"))
        .otherwise(F.col("r_name"))
    )
    out = joined.select(F.col("n_name").alias("code"), group.alias("category_group"))
    return _conform(out, schemas.STAGING_CODES)
