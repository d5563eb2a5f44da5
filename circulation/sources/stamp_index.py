"""File-skipping index (S2, P2): the least and greatest stamp of every file of a source not laid out by run date.

``update_stamp_index`` reads the files it does not know yet and appends one row per file; ``read_indexed``
opens only the files that may hold rows of a window. A file is known by its name, size and
modification time: a late, replaced or unindexed file has no entry and is always opened, so an index that
lags behind costs time and never a row.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.functions import midnight_lit
from circulation.functions.dates import DateLike
from circulation.sources.extract import as_timestamp

_KEY = ["file", "size", "modified"]
_INDEX = "file string, size long, modified timestamp, least timestamp_ntz, greatest timestamp_ntz"


def _files(spark: SparkSession, source: str) -> DataFrame:
    """The source's parquet files as storage lists them; their content is not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    return listed.load(source).select(F.col("path").alias("file"), F.col("length").alias("size"),
                                      F.col("modificationTime").alias("modified"))


def _index(spark: SparkSession, index: str) -> DataFrame:
    try:
        return spark.read.schema(_INDEX).parquet(index)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _INDEX)


def _plain(name: Column) -> Column:
    """One form for local names, which come with one or three slashes."""
    return F.regexp_replace(name, "^file:/+", "file:/")


def _open(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def update_stamp_index(spark: SparkSession, source: str, schema: T.StructType, stamp: str, index: str) -> int:
    """Append an entry for every file without one; how many files were read, of which only the stamps are.

    A file whose stamps are all missing gets an entry of nulls, and no window opens it; one without rows gets
    none, nor does one whose name storage and scan give in different forms."""
    new = _files(spark, source).join(_index(spark, index), _KEY, "left_anti")
    files = [r["file"] for r in new.select("file").collect()]  # names only, as the scan holds them too
    if not files:
        return 0
    rows = _open(spark, files, schema)
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    ends = rows.select(_plain(name).alias("plain"), as_timestamp(rows, stamp).alias("ts")).groupBy("plain").agg(
        F.min("ts").alias("least"), F.max("ts").alias("greatest"))
    entries = new.withColumn("plain", _plain(F.col("file"))).join(ends, "plain")
    entries.select(*_KEY, "least", "greatest").coalesce(1).write.mode("append").parquet(index)
    return len(files)


def files_of_window(spark: SparkSession, source: str, index: str, lo: DateLike | None, hi: DateLike | None) -> list[str]:
    """The files that may hold rows of ``(lo, hi]``, sorted by name."""
    files = _files(spark, source)
    if lo is not None or hi is not None:
        out = F.col("least").isNull()
        if lo is not None:
            out = out | (F.col("greatest") <= midnight_lit(lo))
        if hi is not None:
            out = out | (F.col("least") > midnight_lit(hi))
        files = files.join(_index(spark, index).where(out), _KEY, "left_anti")
    return sorted(r["file"] for r in files.select("file").collect())


def read_indexed(spark: SparkSession, source: str, schema: T.StructType, index: str,
                 lo: DateLike | None, hi: DateLike | None) -> DataFrame:
    """The rows of the files that may matter to ``(lo, hi]``; ``extract_window`` over it gives the window's rows."""
    return _open(spark, files_of_window(spark, source, index, lo, hi), schema)
