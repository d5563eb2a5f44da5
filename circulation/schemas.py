"""Declared schemas of the ten tables (staging files bind columns by position)."""

from __future__ import annotations

from pyspark.sql import types as T

from circulation.constants import ALL_TABLES

S, L, I = T.StringType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STAGING_INVENTORY = _struct(
    ("bibnum", L), ("title", S), ("isbn", S), ("publicationyear", S), ("publisher", S),
    ("itemtype", S), ("itemcollection", S), ("floatingitem", S), ("itemlocation", S),
    ("reportdate", S), ("itemcount", I), ("author", S), ("subjects", S),
)

STAGING_LOANS = _struct(
    ("id", S), ("checkoutyear", I), ("bibnumber", L), ("itembarcode", L), ("itemtype", S),
    ("collection", S), ("callnumber", S), ("itemtitle", S), ("subjects", S), ("checkoutdatetime", S),
)

STAGING_CODES = _struct(
    ("code", S), ("description", S), ("code_type", S), ("format_group", S), ("format_subgroup", S),
    ("category_group", S), ("category_subgroup", S), ("age_group", S),
)

STAGING_EXPLODED_SUBJECTS = _struct(("subjects_string", S), ("subject", S))

DIM_TIME = _struct(
    ("time_key", T.TimestampNTZType()), ("quarter_of_year", I), ("day_of_week", I),
    ("day", I), ("month", I), ("year", I),
)

DIM_COLLECTIONS = _struct(("code", S), ("item_type", S))

DIM_SUBJECT = _struct(("subject", S), ("subject_id", L))

DIM_BOOKS = _struct(("bibnum", L), ("title", S), ("publisher", S), ("author", S))

FACT_LOANS = _struct(
    ("id", S), ("time_key", T.TimestampNTZType()), ("itemtype", S), ("collection", S),
    ("bibnumber", L), ("subject_group_id", S),
)

BRIDGE_SUBJECT = _struct(("subject_group_id", S), ("subject_id", L), ("subjects_string", S))

# Table name -> schema, in the drop-all order of constants.ALL_TABLES.
TABLES: dict[str, T.StructType] = {
    "staging_loans": STAGING_LOANS,
    "staging_inventory": STAGING_INVENTORY,
    "staging_codes": STAGING_CODES,
    "staging_exploded_subjects": STAGING_EXPLODED_SUBJECTS,
    "dim_time": DIM_TIME,
    "dim_books": DIM_BOOKS,
    "dim_collections": DIM_COLLECTIONS,
    "dim_subject": DIM_SUBJECT,
    "bridge_subject": BRIDGE_SUBJECT,
    "fact_loans": FACT_LOANS,
}

assert tuple(TABLES) == ALL_TABLES
