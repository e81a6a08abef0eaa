"""Data-quality gates (Q1, Q2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class NoInputError(RuntimeError):
    """A layer/prefix that must hold data holds none."""


class EmptyOutputError(RuntimeError):
    """A write that must produce rows produced none."""


class QuarantineError(RuntimeError):
    """More malformed records than a load allows."""


def require_path(path: str | None, where: str) -> str:
    """Q1 for file inputs: raise when nothing was found under ``where``."""
    if not path:
        raise NoInputError(f"no input files found under {where}")
    return path


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs ``df``
    (the write itself), so the Q2 check costs no extra job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def require_rows(obs: Observation, where: str) -> int:
    """Q2: raise when the observed action wrote no rows."""
    rows = int(obs.get.get("rows", 0) or 0)
    if rows == 0:
        raise EmptyOutputError(f"no rows written to {where}")
    return rows
