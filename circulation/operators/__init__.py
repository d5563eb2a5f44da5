from circulation.operators.calendar import align_to_calendar, date_spine
from circulation.operators.dedupe import first_per_key
from circulation.operators.joins import lookup_join
from circulation.operators.members import assign_ids, only_new
from circulation.operators.tokens import explode_tokens, is_missing, split_tokens
from circulation.operators.topk import top_k

__all__ = [
    "align_to_calendar",
    "assign_ids",
    "date_spine",
    "explode_tokens",
    "first_per_key",
    "is_missing",
    "lookup_join",
    "only_new",
    "split_tokens",
    "top_k",
]
