"""Joins (J1-J5).

No join hint is forced anywhere: the planner broadcasts a side only when its
estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
re-plans from actual shuffle sizes at run time (a checked size bound with a
sort-merge join beyond it); AQE's skew-join handling splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import blank_fallback, trim_spaces
from ..names import col, quote, resolve


def _on(left: DataFrame, right: DataFrame, lkey: str, rkey: str) -> Column:
    return left[quote(lkey)] == right[quote(rkey)]


@dataclass(frozen=True)
class StarKeys:
    """Key names of the order-items star (defaults: the relational source's)."""
    item_order: str = "OrderID"
    order_key: str = "OrderID"
    order_customer: str = "CustomerID"
    customer_key: str = "CustomerID"
    item_product: str = "ProductID"
    product_key: str = "ProductID"


def order_items_view(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    columns: Sequence[str],
    keys: StarKeys = StarKeys(),
    *,
    customers_first: bool = False,
) -> DataFrame:
    """Items JOIN orders JOIN customers JOIN products (inner equi-joins),
    projected to ``columns``.  Key columns are carried only as far as needed.

    Join order.  By default items meet each table in turn, so every table the
    planner finds small enough is broadcast and the items stream is never
    shuffled.  When none of them fits a broadcast (all large, as at 100 TB),
    that order shuffles the items stream three times (order, customer and
    product keys).  ``customers_first=True`` joins orders to customers first,
    so the items stream is shuffled only twice.  It is not the default: without
    table statistics Spark sizes a join result as the product of its inputs,
    so a pre-joined orders/customers side never looks broadcastable, and a
    small items side may be broadcast instead.  Inner joins commute, so both
    orders give the same rows.
    """
    if customers_first:
        oc = orders.join(customers,
                         _on(orders, customers, keys.order_customer, keys.customer_key))
        ioc = items.join(oc, _on(items, oc, keys.item_order, keys.order_key))
    else:
        io = items.join(orders, _on(items, orders, keys.item_order, keys.order_key))
        ioc = io.join(customers, _on(io, customers, keys.order_customer, keys.customer_key))
    full = ioc.join(products, _on(ioc, products, keys.item_product, keys.product_key))
    return full.select(*[col(c) for c in columns])


def lookup(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    right_key: str,
    *,
    drop_right_key: bool = True,
    dedupe_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left-outer lookup; unmatched rows get NULL dimension columns.
    ``dedupe_by`` keeps one dimension row per key first (see :func:`first_per_key`),
    so a key listed twice cannot multiply rows.  The dimension may be a selection
    of ``df`` itself: its key joins under a name of its own."""
    if dedupe_by:
        dim = first_per_key(dim, right_key, dedupe_by)
    key = resolve(dim, right_key) or right_key
    held = [c for c in dim.columns if not (drop_right_key and c == key)]
    dim = dim.select(*[col(c).alias(c) for c in held], col(key).alias("__dim_key"))
    joined = df.alias("__row").join(
        dim, F.col(f"__row.{quote(left_key)}") == F.col("__dim_key"), "left_outer")
    return joined.drop("__dim_key")


def lookup_fill(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    right_key: str,
    fill: Mapping[str, str],
    *,
    trim_left_key: bool = True,
    dedupe_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left-outer lookup on a space-trimmed left key, then fill blanks.

    The right key is not trimmed.  ``fill = {"City": "Geo_City"}`` takes the
    dimension's value only where the row's own value is NULL or ``''``.
    Several dimension rows with one key fan the row out (like any equi-join,
    the original job's behaviour and the default).  ``dedupe_by`` keeps one
    dimension row per key first (the first by those columns), so every row
    gets at most one match and a duplicated hot key cannot multiply rows.
    """
    if trim_left_key:
        df = df.withColumn(left_key, trim_spaces(col(left_key)))
    joined = lookup(df, dim, left_key, right_key, dedupe_by=dedupe_by)
    return joined.withColumns({c: blank_fallback(col(c), col(src)) for c, src in fill.items()})


def _rank(order_by: Sequence[str]) -> Column:
    """The ordering struct of the columns, with NULLs after every value."""
    return F.struct(*[c for o in order_by for c in (col(o).isNull(), col(o))])


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per ``key``: the first by ``order_by`` (ties broken by the later
    columns; make the last one unique for a deterministic pick).  A ``min_by``
    aggregate with a partial (map-side) stage, so a key with a third of all
    rows is reduced inside every task before the shuffle."""
    key = resolve(df, key) or key
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.select(col(key)).distinct()
    best = df.groupBy(col(key).alias(key)).agg(
        F.min_by(F.struct(*[col(c) for c in rest]), _rank(order_by)).alias("__best"))
    return best.select(col(key), *[F.col("__best").getField(c).alias(c) for c in rest])


def first_match(
    keys: DataFrame,
    candidates: DataFrame,
    key: str,
    order_by: Sequence[str],
    values: Sequence[str],
    *,
    candidate_key: str | None = None,
) -> DataFrame:
    """For every row of ``keys`` the first candidate by ``order_by``.

    Keys without a candidate keep their row with NULL values.  The choice is a
    ``min_by`` aggregate, so a key holding millions of candidates is reduced
    map-side before the shuffle (partial aggregation) and never lands whole in
    one task.  Ties are broken by the remaining ``order_by`` columns; make the
    last one unique for a deterministic result.
    """
    ckey = candidate_key or key
    best = (
        candidates.groupBy(col(ckey).alias("__key"))
        .agg(F.min_by(F.struct(*[col(v) for v in values]), _rank(order_by)).alias("__best"))
    )
    joined = keys.join(best, keys[quote(key)] == best["__key"], "left_outer")
    return joined.select(*[keys[quote(c)] for c in keys.columns],
                         *[F.col("__best").getField(v).alias(v) for v in values])
