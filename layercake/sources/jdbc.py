"""JDBC query scan (S3): the join may run inside the database.

With ``partition_column`` the read is split into ``num_partitions`` range
queries (one connection each); a plain ``query`` is a single partition.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    *,
    query: str | None = None,
    table: str | None = None,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; a query to be split by ``partition_column`` is wrapped
    as a derived table, since Spark rejects ``query`` + ``partitionColumn``."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query= or table=")
    opts: dict[str, str] = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound, num_partitions")
        opts["dbtable"] = f"({query}) q" if query is not None else table
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    elif query is not None:
        opts["query"] = query
    else:
        opts["dbtable"] = table
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            opts[key] = value
    opts.update(extra or {})
    return opts


def read_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """S3: a JDBC query or table as a DataFrame (options as in :func:`jdbc_read_options`)."""
    return spark.read.format("jdbc").options(**jdbc_read_options(url, **kwargs)).load()
