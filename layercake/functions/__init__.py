"""Scalar functions: built-in Spark expressions only (no Python UDF)."""

from .casts import cast_if_present, to_double, to_timestamp
from .dates import date_path, month_name, year_of
from .hashing import hash_columns, sha256_hex
from .runinfo import RunInfo, new_run
from .values import blank_fallback, is_blank, join_nonnull, recode, trim_spaces

__all__ = [
    "RunInfo", "blank_fallback", "cast_if_present", "date_path", "hash_columns", "is_blank",
    "join_nonnull", "month_name", "new_run", "recode", "sha256_hex", "to_double",
    "to_timestamp", "trim_spaces", "year_of",
]
