"""Value-level helpers: recode, blank test/fallback, trim, address join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace exact matches per ``mapping``; other values (and NULL) unchanged."""
    expr = None
    for src, dst in mapping.items():
        expr = F.when(c == src, F.lit(dst)) if expr is None else expr.when(c == src, F.lit(dst))
    return c if expr is None else expr.otherwise(c)


def is_blank(c: Column) -> Column:
    """NULL or the empty string (whitespace is not blank)."""
    return c.isNull() | (c == "")


def blank_fallback(value: Column, fallback: Column) -> Column:
    """``fallback`` when ``value`` is blank, else ``value``.  Not ``coalesce``:
    ``''`` counts as blank too."""
    return F.when(is_blank(value), fallback).otherwise(value)


def trim_spaces(c: Column) -> Column:
    """Strip leading/trailing spaces only; tabs and other whitespace stay."""
    return F.trim(c)


def join_nonnull(sep: str, *parts: Column) -> Column:
    """``concat_ws``: NULL parts skipped, ``''`` kept, all-NULL gives ``''``."""
    return F.concat_ws(sep, *parts)
