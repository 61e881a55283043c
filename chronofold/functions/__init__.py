from chronofold.functions.columns import (
    OPEN_END,
    OPEN_END_SQL,
    any_differs,
    any_null,
    ascending_or_descending,
    at_path,
    col_of,
    hashable,
    keys_equal,
    keys_same,
    path_steps,
    quoted,
    ref,
    row_bytes,
    stable_salt,
    text,
)

__all__ = [
    "OPEN_END",
    "OPEN_END_SQL",
    "any_differs",
    "any_null",
    "ascending_or_descending",
    "at_path",
    "col_of",
    "hashable",
    "keys_equal",
    "keys_same",
    "path_steps",
    "quoted",
    "ref",
    "row_bytes",
    "stable_salt",
    "text",
]
