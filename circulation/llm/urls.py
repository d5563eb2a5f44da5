"""Native URL columns shared by the URL filter and the capture index."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for a null url or one without it."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Up to the first of ``/?#``, with A to Z lower-cased."""
    raw = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host, up to the first of ``?#``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def reversed_host_key(url: Column) -> Column:
    """``com,example,www)/path?query``: captures of one site sort together. The fragment is left out."""
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host_of(url), r"\.")), ","), F.lit(")"), rest)
