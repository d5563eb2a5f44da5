"""These must equal the reference's for the results to match."""

# --- fixed values -------------------------------------------------------------------------
# Delimited files: field separator, header row, quote character.
FILE_SEPARATOR = "|"
FILE_HEADER = True
FILE_QUOTE = '"'
# Multi-valued subjects: one string, tokens separated by a comma (no trimming).
SUBJECT_SEPARATOR = ","
# Day text: the first 10 characters of a timestamp text, read as year-month-day.
DAY_TEXT_LENGTH = 10
DAY_PATTERN = "yyyy-MM-dd"
# Day of week numbering: 0 = Sunday ... 6 = Saturday.
FIRST_WEEKDAY_NUMBER = 0
# Subject group key: md5 hex of the raw subjects string; md5 of the empty string.
EMPTY_GROUP_ID = "d41d8cd98f00b204e9800998ecf8427e"
# Dashboard top-k sizes.
TOP_SUBJECTS = 30
TOP_TITLES = 20
# Monthly data check: these tables, each must hold at least this many rows.
QUALITY_TABLES = ("dim_books", "dim_collections", "bridge_subject", "dim_subject")
QUALITY_MINIMUM_ROWS = 1
# Drop-all order of the ten tables.
ALL_TABLES = (
    "staging_loans", "staging_inventory", "staging_codes", "staging_exploded_subjects",
    "dim_time", "dim_books", "dim_collections", "dim_subject", "bridge_subject", "fact_loans",
)
# --- end of fixed values ------------------------------------------------------------------
# Codec of the jobs' delimited landing (a file is one task to its reader, compressed or not).
LANDING_COMPRESSION = "gzip"
