"""Run extracts (S2-S5): one run's slice of a dated source, its size, and unions of slices."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.functions import midnight_lit
from circulation.functions.dates import DateLike, as_date


# Names of the typed landing (sources.landing): the parsed stamp beside the text one, the folders' key.
TYPED = "_ts"
RUN_DATE = "run_date"


class EmptyExtractError(Exception):
    pass


def as_timestamp(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        # ISO text such as 2018-05-27T00:00:00.000; comparing it as text would put the
        # midnight row of the upper bound outside the window. A blank stamp is a missing one,
        # outside every window; other text that is no stamp still fails the read.
        return F.nullif(c, F.lit("")).cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp_ntz")
    return c


def window_predicate(df: DataFrame, column: str, lo: DateLike | None, hi: DateLike | None) -> Column:
    """Left-open, right-closed ``(lo, hi]`` on midnight bounds: a row stamped exactly at
    ``hi`` 00:00 belongs to this run, one stamped at ``lo`` 00:00 to the previous one.

    On a typed landing the parsed stamp is compared and, as no row is stamped after its run date,
    folders up to ``lo`` are pruned; both reach the scan."""
    typed = column + TYPED in df.columns
    ts = F.col(column + TYPED) if typed else as_timestamp(df, column)
    cond = F.lit(True)
    if typed and RUN_DATE in df.columns and lo is not None:
        cond = cond & (F.col(RUN_DATE) > F.lit(as_date(lo)))
    if lo is not None:
        cond = cond & (ts > midnight_lit(lo))
    if hi is not None:
        cond = cond & (ts <= midnight_lit(hi))
    return cond


def extract_window(
    df: DataFrame,
    column: str,
    lo: DateLike | None,
    hi: DateLike | None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One run's slice in the declared column order (a missing column raises). On a parquet
    source with a timestamp column both the predicate and the projection reach the scan."""
    out = df.where(window_predicate(df, column, lo, hi))
    return out.select(*columns) if columns is not None else out


def extract_size(df: DataFrame, column: str, lo: DateLike | None, hi: DateLike | None) -> DataFrame:
    """Rows under the extract's own predicate, as a one-row frame ``(rows)``."""
    return df.where(window_predicate(df, column, lo, hi)).agg(F.count(F.lit(1)).alias("rows"))


def require_rows(df: DataFrame, what: str, allow_empty: bool = False) -> int:
    """Count an extract and fail clearly on zero rows unless ``allow_empty``."""
    n = df.count()
    if n == 0 and not allow_empty:
        raise EmptyExtractError(f"{what}: the extract window holds no rows")
    return n


def union_slices(slices: Iterable[DataFrame]) -> DataFrame:
    """Concatenate slices with bag semantics (UNION ALL), matching columns by name."""
    return reduce(lambda a, b: a.unionByName(b), slices)
