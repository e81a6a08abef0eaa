"""Aggregates, sort and limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import col
from ..schemas import REPORT_STATUSES


def status_report(
    df: DataFrame,
    status: str = "Status",
    price: str = "Price",
    statuses: Mapping[str, str] = REPORT_STATUSES,
) -> DataFrame:
    """A1-A4: the one-row status report in ONE aggregate (one scan).

    Per ``statuses`` column: count of rows whose status equals the value
    exactly (case-sensitive).  ``average_price``: mean of the price cast to
    double, malformed/NULL skipped, NULL on empty input.  ``total_orders``:
    all rows (it counts order *items*, other statuses included).
    The aggregate is computed partially per task and merged, so the single
    output row never pulls rows into one task.
    """
    s, p = col(status), col(price).try_cast("double")
    return df.agg(
        *[F.count_if(s == value).alias(name) for name, value in statuses.items()],
        F.avg(p).alias("average_price"),
        F.count(F.lit(1)).alias("total_orders"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A5: distinct values of one column (NULL kept as its own value)."""
    return df.select(col(column)).distinct()


def top_n(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows by ``order`` (TakeOrderedAndProject: a per-task
    top-n then a merge of ``n`` x tasks rows, never a full sort)."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, order: Sequence[Column], n: int = 10) -> DataFrame:
    """A repeatable ``n``-row preview (ordered, unlike ``show``)."""
    return top_n(df, order, n)
