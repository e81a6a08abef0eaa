"""Projections and filters (P1-P9): one ``select``/``filter`` each, so Catalyst
prunes columns down to the scan and pushes predicates into it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..names import col, present, resolve

Mapping_ = Mapping[str, "str | Sequence[str]"]


def apply_mapping(df: DataFrame, mapping: Mapping_) -> DataFrame:
    """Config-driven projection.

    ``{"src": "dst"}`` renames, ``{"src": ["a", "b"]}`` feeds several targets from
    one source column.  Unmapped columns vanish; output order is mapping order;
    an unknown source column raises (Spark's unresolved-column error).
    Names may contain dots or spaces: they are never parsed as paths.
    """
    out = []
    for src, dests in mapping.items():
        for dst in [dests] if isinstance(dests, str) else list(dests):
            out.append(col(src).alias(dst))
    return df.select(*out)


def drop_pii(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the named columns; case-insensitive, absent names ignored."""
    return df.drop(*present(df, columns))


def conform(df: DataFrame, schema: T.StructType | Sequence[str], *,
            fill_missing: bool = False) -> DataFrame:
    """Project to a table's column order (by name, case-insensitive).

    A missing column raises, unless ``fill_missing`` (needs a ``StructType``),
    which adds it as a typed NULL.  Columns of ``df`` outside ``schema`` are
    rejected when filling, so a misspelt name never vanishes silently.
    """
    names = schema.names if isinstance(schema, T.StructType) else list(schema)
    types = {f.name: f.dataType for f in schema.fields} if isinstance(schema, T.StructType) else {}
    if fill_missing:
        wanted = {n.lower() for n in names}
        unknown = [c for c in df.columns if c.lower() not in wanted]
        if unknown:
            raise ValueError(f"columns {unknown} are not in the target {names}")
    cols = []
    for name in names:
        actual = resolve(df, name)
        if actual is not None:
            cols.append(col(actual).alias(name))
        elif fill_missing and name in types:
            cols.append(F.lit(None).cast(types[name]).alias(name))
        else:
            raise ValueError(f"column {name!r} missing; have {df.columns}")
    return df.select(*cols)


def where_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Equality filter (``col = value``); pushed down to the scan as ``EqualTo``.

    ``value=None`` selects NULL keys (``IS NULL``), unlike ``col == None``.
    """
    c = col(column)
    return df.filter(c.isNull() if value is None else c == value)
