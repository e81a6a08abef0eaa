"""SHA-256 PII hashing (F1/F2) as the built-in ``sha2`` — stays in codegen."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import col, resolve

Blank = Literal["hash", "null"]


def sha256_hex(c: Column, blank: Blank = "hash") -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text of ``c``; NULL stays NULL.

    ``blank="hash"`` hashes ``''`` like any other value (e3b0c442...);
    ``blank="null"`` maps ``''`` to NULL as well (the medallion silver job's rule).
    Non-string input is hashed as its string form.
    """
    text = c.cast("string")
    digest = F.sha2(text, 256)
    if blank == "null":
        return F.when(text != "", digest)
    return digest


def hash_columns(df: DataFrame, columns: Iterable[str], blank: Blank = "hash") -> DataFrame:
    """Replace each named column (case-insensitive, absent names ignored) by its hash.

    Hashing an already hashed column hashes the hash: always start from the raw layer.
    """
    targets = {}
    for name in columns:
        actual = resolve(df, name)
        if actual is not None:
            targets[actual] = sha256_hex(col(actual), blank)
    return df.withColumns(targets) if targets else df
