"""S6/S7 delimited sink: ``|``-separated with a header, replacing the run's directory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from circulation.constants import FILE_SEPARATOR
from circulation.sources.delimited import CSV_OPTIONS


def write_delimited(df: DataFrame, path: str, sep: str = FILE_SEPARATOR, mode: str = "overwrite",
                    partition_by: Sequence[str] = (), compression: str = "none") -> None:
    """Write ``df`` as delimited text under ``path`` (one directory per run date).

    Spark's CSV writer trims blanks by default, which would turn a token ``" B"`` into
    ``"B"``; both trims are switched off. ``mode="overwrite"`` replaces what the directory
    held (S7). Each task writes its own part file, so the later multi-line read is parallel.
    ``compression`` (such as ``gzip``) suits landings that ``read_delimited`` reads: it takes a file per task
    anyhow. ``read_split_delimited`` cannot divide a compressed file.
    """
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    (
        writer.mode(mode)
        .options(**{**CSV_OPTIONS, "sep": sep})
        .option("emptyValue", "")
        .option("compression", compression)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
