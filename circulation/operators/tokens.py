"""Split-and-explode of a delimited multi-valued string column."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circulation.constants import SUBJECT_SEPARATOR


def is_missing(c: Column, na_values: Iterable[str] | None = None) -> Column:
    """NULL or empty text counts as missing; ``na_values`` adds words such as ``NA`` for parity
    with readers that treat them as missing."""
    cond = c.isNull() | (c == F.lit(""))
    words = list(na_values or [])
    if words:
        cond = cond | c.isin(words)
    return cond


def split_tokens(c: Column, sep: str = SUBJECT_SEPARATOR, trim: bool = False, dedupe: bool = False) -> Column:
    """Array of tokens. ``split`` takes a regex, so the separator is quoted; limit -1 keeps
    trailing empty tokens. No trimming and no de-duplication unless asked for."""
    tokens = F.split(c, re.escape(sep), -1)
    if trim:
        tokens = F.transform(tokens, lambda t: F.trim(t))
    if dedupe:
        tokens = F.array_distinct(tokens)
    return tokens


def explode_tokens(
    df: DataFrame,
    column: str,
    new_column: str,
    sep: str = SUBJECT_SEPARATOR,
    keep: bool = False,
    trim: bool = False,
    dedupe: bool = False,
    na_values: Iterable[str] | None = None,
) -> DataFrame:
    """One row per token of ``column``; other columns repeat. Rows with a missing value
    produce nothing. With ``keep`` the unsplit value is emitted first when it has more than
    one token."""
    c = F.col(column)
    tokens = split_tokens(c, sep, trim, dedupe)
    if keep:
        tokens = F.when(F.size(tokens) > 1, F.concat(F.array(c), tokens)).otherwise(tokens)
    return df.where(~is_missing(c, na_values)).withColumn(new_column, F.explode(tokens))
