"""Medallion order flows (W1-W5): bronze -> silver -> gold -> served report.

Each step reads one run of the previous layer (the newest of the day unless a
run id is given) and publishes a new run of its own; steps share nothing but
the ``root``/``topic``/``dt`` path convention.  No sleeps: a reader takes the
newest run that has a manifest, so a run still being published is never read
half-way, and one that failed its audit is never read at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.hashing import hash_columns
from ..functions.runinfo import RunInfo, new_run
from ..operators.aggregates import status_report
from ..operators.joins import StarKeys, order_items_view
from ..operators.projection import drop_pii
from ..schemas import ORDER_ITEMS_COLUMNS, ORDER_ITEMS_PII, REPORT_STATUSES
from ..sinks.files import write_layer, write_report
from ..sources.files import read_report
from ..sources.jdbc import read_jdbc
from ..sources.layers import newest_run, read_layer

TOPIC = "orderitems"


def bronze_from_tables(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame,
    root: str, *, topic: str = TOPIC, run: RunInfo | None = None,
    columns: Sequence[str] = ORDER_ITEMS_COLUMNS, keys: StarKeys = StarKeys(),
    fmt: str = "parquet",
) -> str:
    """W1 (in Spark): star join -> bronze run.  Returns the run folder."""
    run = run or new_run()
    view = order_items_view(items, orders, customers, products, columns, keys)
    return write_layer(view, root, topic, "bronze", run, fmt=fmt)


def bronze_from_jdbc(
    spark: SparkSession, url: str, query: str, root: str, *, topic: str = TOPIC,
    run: RunInfo | None = None, fmt: str = "parquet", **jdbc,
) -> str:
    """W1 (pushed down): the star join runs inside the database."""
    run = run or new_run()
    return write_layer(read_jdbc(spark, url, query=query, **jdbc), root, topic, "bronze", run,
                       fmt=fmt)


def _silver(spark: SparkSession, root: str, dt: str, transform, *, topic: str,
            run: RunInfo | None, bronze_run: str | None, fmt: str,
            schema: T.StructType | None) -> str:
    run = run or new_run()
    bronze = read_layer(spark, root, topic, "bronze", dt, bronze_run, fmt=fmt, schema=schema)
    return write_layer(transform(bronze), root, topic, "silver", run, fmt=fmt, dt=dt)


def silver_drop(spark: SparkSession, root: str, dt: str, *, pii: Sequence[str] = ORDER_ITEMS_PII,
                topic: str = TOPIC, run: RunInfo | None = None, bronze_run: str | None = None,
                fmt: str = "parquet", schema: T.StructType | None = None) -> str:
    """Newest bronze -> PII columns dropped -> silver run."""
    return _silver(spark, root, dt, lambda df: drop_pii(df, pii), topic=topic, run=run,
                   bronze_run=bronze_run, fmt=fmt, schema=schema)


def silver_hash(spark: SparkSession, root: str, dt: str, *, pii: Sequence[str] = ORDER_ITEMS_PII,
                topic: str = TOPIC, run: RunInfo | None = None, bronze_run: str | None = None,
                fmt: str = "parquet", schema: T.StructType | None = None) -> str:
    """Newest bronze -> PII hashed (``''`` and NULL -> NULL) -> silver run.
    Always reads bronze, so a value is never hashed twice."""
    return _silver(spark, root, dt, lambda df: hash_columns(df, pii, blank="null"), topic=topic,
                   run=run, bronze_run=bronze_run, fmt=fmt, schema=schema)


def gold_report(spark: SparkSession, root: str, dt: str, *, topic: str = TOPIC,
                status: str = "Status", price: str = "Price",
                statuses: Mapping[str, str] = REPORT_STATUSES, run: RunInfo | None = None,
                silver_run: str | None = None, fmt: str = "parquet") -> str:
    """Newest silver -> one-pass status report -> one JSON file (Q2-gated)."""
    run = run or new_run()
    silver = read_layer(spark, root, topic, "silver", dt, silver_run, fmt=fmt)
    return write_report(status_report(silver, status, price, statuses), root, topic, run, dt=dt)


def latest_report(spark: SparkSession, root: str, dt: str, *, topic: str = TOPIC) -> DataFrame:
    """The newest committed gold report of the day, as a one-row DataFrame (Q1 if none)."""
    return read_report(spark, newest_run(spark, root, topic, "gold", dt))
