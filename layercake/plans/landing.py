"""Mapped landing and external export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.casts import cast_if_present
from ..functions.values import join_nonnull
from ..names import col
from ..operators.projection import apply_mapping
from ..schemas import ADDRESS_PARTS, CLIENTS_COLUMNS
from ..sinks.jdbc import write_jdbc
from ..sinks.tables import merge_insert_only
from ..sources.csv import read_csv

TIMESTAMP_CASTS = {"created_at": "timestamp", "updated_at": "timestamp"}


def map_columns(df: DataFrame, mapping: Mapping, casts: Mapping[str, str] = TIMESTAMP_CASTS
                ) -> DataFrame:
    """W8 transform: config-driven projection, then casts of the columns present."""
    return cast_if_present(apply_mapping(df, mapping), casts)


def land_mapped_csv(spark: SparkSession, path: str, mapping: Mapping, table: str, *,
                    keys: Sequence[str] = ("id",),
                    casts: Mapping[str, str] = TIMESTAMP_CASTS) -> int:
    """All-string CSV -> mapping -> casts -> insert-only merge on ``keys``."""
    return merge_insert_only(map_columns(read_csv(spark, path), mapping, casts), table, keys)


def clients_view(landing: DataFrame, *, parts: Sequence[str] = ADDRESS_PARTS) -> DataFrame:
    """W9 transform: ``address`` = the non-NULL parts joined by ``', '``;
    ``zipcode`` renamed ``zip_code``; the clients column order."""
    with_address = landing.withColumn("address", join_nonnull(", ", *[col(p) for p in parts]))
    renamed = {"zip_code": "zipcode"}
    return with_address.select(*[col(renamed.get(c, c)).alias(c) for c in CLIENTS_COLUMNS])


def export_clients(spark: SparkSession, table: str, url: str, target: str = "clients",
                   **jdbc) -> None:
    """Landing table -> clients view -> JDBC append in batches of 1000."""
    write_jdbc(clients_view(spark.table(table)), url, target, **jdbc)
