"""JDBC append (K7): one connection per partition, inserts in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    batch_size: int = 1000,
    max_connections: int | None = None,
    mode: str = "append",
) -> None:
    """Append ``df`` to ``table``.  ``max_connections`` caps concurrent
    connections (Spark coalesces to that many partitions before writing), so a
    large cluster does not open one connection per task against the database.

    Delivery is at least once, not exactly once.  Each partition is inserted
    in one transaction where the database supports them, so a failed attempt
    leaves nothing behind.  But an executor lost after its commit, or a
    speculative copy, inserts that partition again on retry.  Give the target
    a unique key (duplicates are then rejected or upserted by the database),
    or append to a fresh staging table and move it into the target inside the
    database.  Keep ``spark.speculation`` off for these writes.
    """
    writer = (df.write.format("jdbc").mode(mode)
              .option("url", url).option("dbtable", table).option("batchsize", str(batch_size)))
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            writer = writer.option(key, value)
    if max_connections:
        writer = writer.option("numPartitions", str(max_connections))
    writer.save()
