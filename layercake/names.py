"""Column-name helpers.

Source columns carry spaces, ``/``, ``&``, ``(``, ``,``, ``-`` and ``.``; every
name that reaches Spark goes through :func:`col` / :func:`quote` so none of
them is parsed as a nested field or an expression.  Resolution is
case-insensitive, like Spark's default analyzer.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Backtick-quote one identifier for SQL text or ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """``F.col`` for a literal column name (no nested-field parsing)."""
    return F.col(quote(name))


def resolve(df: DataFrame, name: str) -> str | None:
    """The actual spelling of ``name`` in ``df`` (case-insensitive), or None."""
    wanted = name.lower()
    for actual in df.columns:
        if actual.lower() == wanted:
            return actual
    return None


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The actual spellings of the given names that exist in ``df``."""
    found = (resolve(df, n) for n in names)
    return [n for n in found if n is not None]
