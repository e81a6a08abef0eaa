"""Catalog table scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table; filters on its partition columns prune folders."""
    return spark.table(name)
