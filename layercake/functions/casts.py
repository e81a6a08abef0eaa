"""Casts that never fail the job: a malformed value becomes NULL (``try_cast``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from ..names import col, resolve


def to_double(c: Column) -> Column:
    """``c`` as DOUBLE; malformed text becomes NULL."""
    return c.try_cast("double")


def to_timestamp(c: Column, ntz: bool = False) -> Column:
    """``c`` as TIMESTAMP (``ntz``: without time zone); malformed text becomes NULL."""
    return c.try_cast("timestamp_ntz" if ntz else "timestamp")


def cast_if_present(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Apply ``try_cast`` to each listed column that exists (case-insensitive)."""
    changes = {}
    for name, dtype in casts.items():
        actual = resolve(df, name)
        if actual is not None:
            changes[actual] = col(actual).try_cast(dtype)
    return df.withColumns(changes) if changes else df
