"""S1 typed delimited scan: ``|``-separated text with a header row, columns bound by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from circulation.constants import FILE_HEADER, FILE_QUOTE, FILE_SEPARATOR

# Reader and writer options that make a write -> read round trip lossless for the separator,
# quotes, backslashes, embedded CR/LF and leading or trailing blanks.
CSV_OPTIONS = {
    "sep": FILE_SEPARATOR,
    "header": str(FILE_HEADER).lower(),
    "quote": FILE_QUOTE,
    "escape": FILE_QUOTE,
}


def blank_strings(df: DataFrame) -> DataFrame:
    """Missing text is '' (not NULL) in staging; numbers stay NULL."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna("", subset=names) if names else df


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = FILE_SEPARATOR,
    multi_line: bool = True,
) -> DataFrame:
    """Read one or more delimited files (or directories) into ``schema`` by position.

    ``multiLine`` keeps quoted newlines inside a field but makes each file one task: land
    many files per run (every Spark write does), read few large files by ``read_split_delimited``,
    or convert to parquet once.
    Malformed rows fail the read (``FAILFAST``), as a warehouse load would.
    """
    reader = (
        spark.read.schema(schema)
        .options(**{**CSV_OPTIONS, "sep": sep})
        .option("multiLine", str(multi_line).lower())
        .option("mode", "FAILFAST")
        .option("enforceSchema", "true")
    )
    paths = [paths] if isinstance(paths, str) else list(paths)
    return blank_strings(reader.csv(paths))


def _split_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(record)``: the records below the header rows, put together from lines that many tasks read."""
    line, quotes = F.col("line"), F.col("quotes")
    # Lines of a split are numbered as they are read; only their order inside it is used.
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line")
    ).withColumn("quotes", (F.length(line) - F.length(F.replace(line, F.lit(FILE_QUOTE), F.lit("")))) % 2)

    in_split = Window.partitionBy("file", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    unbalanced = F.raise_error(F.concat(F.lit("quotes are not balanced in "), F.col("file"))).cast("long")
    # One row per split: how many odd lines the splits before it hold.
    splits = lines.groupBy("file", "split").agg(F.sum(quotes).alias("odd")).select(
        "file", "split", F.when(F.sum("odd").over(Window.partitionBy("file")) % 2 == 1, unbalanced)
        .otherwise(F.coalesce(F.sum("odd").over(in_file), F.lit(0))).alias("odd_ahead"))
    placed = lines.select(
        "file", "split", "place", "line", "quotes",
        F.coalesce(F.sum(quotes).over(in_split), F.lit(0)).alias("odd_before"),
        ((F.col("split") == 0) & (F.count(F.lit(1)).over(in_split) == 0)).alias("header"),
    ).join(splits, ["file", "split"]).withColumn("odd_before", F.col("odd_before") + F.col("odd_ahead"))

    # A line is a record if no quote is open at its start or end; others belong together from the one
    # that opens a quote to the one that closes it.
    alone = (F.col("odd_before") % 2 == 0) & (quotes == 0)
    whole = placed.where(alone).select("header", F.col("line").alias("record"))
    joined = placed.where(~alone).groupBy("file", F.shiftright("odd_before", 1).alias("n")).agg(
        F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("split", "place", "line"))).alias("lines"),
    ).select("header", F.array_join(F.col("lines.line"), "\n").alias("record"))
    ended = F.regexp_replace("record", "\\r$", "")
    return whole.unionAll(joined).where(~F.col("header")).select(ended.alias("record")).where("record != ''")


def read_split_delimited(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str = FILE_SEPARATOR
) -> DataFrame:
    """``read_delimited`` for few large files: every file is read by as many tasks as it has splits.

    A newline ends a record where the number of quotes before it is even. Each split counts its lines
    with an odd number of quotes; a sum over the splits before tells every line whether it begins inside a
    quoted field. Lines that are whole records are parsed where they are; only those of records over several
    lines meet, one group per record. The lines are shuffled once, by split, and the text is scanned twice.

    Lines end in LF or CRLF, and quotes stand around fields only (doubled inside them), as the sink
    writes them; a file whose quotes do not balance fails the read, as does a malformed row.
    Empty lines are no rows, an empty file or one of a header alone has none.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {**CSV_OPTIONS, "sep": sep, "header": "false", "multiLine": "true", "mode": "FAILFAST"}
    parsed = _split_records(spark, paths).select(F.from_csv("record", ddl, options).alias("row"))
    return blank_strings(parsed.select(*[F.col("row")[f.name].alias(f.name) for f in schema.fields]))
