"""Typed landing: parquet folders per run date with the stamp parsed once, for pruned extracts.

``land_typed`` writes ``<root>/<dataset>/run_date=YYYY-MM-DD/`` with the staging columns and
``<stamp>_ts``, the stamp as a timestamp; it refuses rows stamped after the run date. So a window's lower
end prunes folders exactly, and both ends reach the scan of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.functions.dates import DateLike, as_date
from circulation.sources.extract import RUN_DATE, TYPED, window_predicate


class StampAfterRunError(Exception):
    pass


def land_typed(df: DataFrame, root: str, dataset: str, run_date: DateLike, stamp: str) -> None:
    """Replace the run date's folder. A blank stamp lands as a missing one."""
    late = df.where(~window_predicate(df, stamp, None, run_date)).count()
    if late:
        raise StampAfterRunError(f"{dataset}: {late} rows are stamped after run date {as_date(run_date)}")
    typed = df.withColumn(stamp + TYPED, F.nullif(F.col(stamp).cast("string"), F.lit("")).cast("timestamp_ntz"))
    folder = f"{root.rstrip('/')}/{dataset}/{RUN_DATE}={as_date(run_date).isoformat()}"
    typed.write.mode("overwrite").parquet(folder)


def read_landed(spark: SparkSession, root: str, dataset: str, schema: T.StructType, stamp: str) -> DataFrame:
    """All landed run dates of a dataset: the staging columns, the typed stamp and ``run_date``."""
    full = T.StructType([*schema.fields, T.StructField(stamp + TYPED, T.TimestampNTZType()),
                         T.StructField(RUN_DATE, T.DateType())])
    return spark.read.schema(full).parquet(f"{root.rstrip('/')}/{dataset}")
