from circulation.sources.delimited import CSV_OPTIONS, blank_strings, read_delimited, read_split_delimited
from circulation.sources.extract import (
    EmptyExtractError,
    extract_size,
    extract_window,
    require_rows,
    union_slices,
    window_predicate,
)
from circulation.sources.landing import land_typed, read_landed
from circulation.sources.stamp_index import files_of_window, read_indexed, update_stamp_index

__all__ = [
    "CSV_OPTIONS",
    "EmptyExtractError",
    "blank_strings",
    "extract_size",
    "extract_window",
    "files_of_window",
    "land_typed",
    "read_delimited",
    "read_indexed",
    "read_landed",
    "read_split_delimited",
    "require_rows",
    "union_slices",
    "update_stamp_index",
    "window_predicate",
]
