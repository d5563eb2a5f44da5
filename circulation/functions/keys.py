"""Hash keys of the group-bridge model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from circulation.constants import EMPTY_GROUP_ID

__all__ = ["EMPTY_GROUP_ID", "group_key"]

# A book without subjects lands in the md5('') group (EMPTY_GROUP_ID), which has no bridge
# rows, so its loans are counted under a NULL subject.


def group_key(subjects: Column | str) -> Column:
    """Subject group id: md5 hex of the raw comma-joined string (order and blanks matter)."""
    c = F.col(subjects) if isinstance(subjects, str) else subjects
    return F.md5(c)
