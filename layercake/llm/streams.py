"""Helpers for operators that read sorted partitions as streams of pandas batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession


def task_count(spark: SparkSession, least: int = 1) -> int:
    """An explicit number of partitions for work whose cost its bytes do not show: at least the
    session's shuffle partitions, so that adaptive execution does not merge it into one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), least)


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, bool, pd.DataFrame]]:
    """Cut a stream sorted by ``keys`` where a key changes: (key, whether it is new, rows).

    A key with many rows comes in several pieces, one per batch, so a hot key is never gathered.
    The keys are columns of strings or of whole numbers without NULL; a NULL string is a key too.
    """
    last: tuple | None = None
    for pdf in batches:
        if not len(pdf):
            continue
        change = np.zeros(len(pdf), dtype=bool)
        for k in keys:
            v = pdf[k].to_numpy()
            differs = v[1:] != v[:-1]
            if v.dtype == object:
                differs &= ~(pd.isna(v[1:]) & pd.isna(v[:-1]))
            change[1:] |= differs.astype(bool)
        cuts = [0, *np.flatnonzero(change), len(pdf)]
        for a, b in zip(cuts, cuts[1:]):
            part = pdf.iloc[a:b]
            key = tuple(None if isinstance(x, float) or x is pd.NA else x for x in (part[k].iat[0] for k in keys))
            yield key, key != last, part
            last = key


def text_slices(pdf: pd.DataFrame, column: str, limit: int = 4 << 20) -> Iterator[pd.DataFrame]:
    """The rows of a batch in slices of about ``limit`` characters (one long text is one slice)."""
    sizes = pdf[column].str.len().fillna(0).to_numpy(dtype=np.int64)
    group = np.cumsum(sizes) // limit
    for _, part in pdf.groupby(group, sort=False):
        yield part
