from circulation.functions.dates import (
    as_date,
    date_parts,
    day_of,
    day_of_week_sunday0,
    midnight_lit,
    time_key,
)
from circulation.functions.keys import EMPTY_GROUP_ID, group_key

__all__ = [
    "EMPTY_GROUP_ID",
    "as_date",
    "date_parts",
    "day_of",
    "day_of_week_sunday0",
    "group_key",
    "midnight_lit",
    "time_key",
]
