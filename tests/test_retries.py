"""Lost tasks: a task attempt that dies after handing rows to the writer is
retried, and the published output holds every row exactly once (Spark's
commit protocol discards the dead attempt's files)."""

import uuid

from pyspark import TaskContext
from pyspark.sql import functions as F

from layercake.functions import new_run
from layercake.sinks import (ensure_database, ensure_table, export_by_key, merge_insert_only,
                             overwrite_table, write_layer)
from layercake.sources import read_layer, read_table

N = 20000


def dies_once(batches):
    """Test-only: the first attempt of partition 0 writes one batch, then dies."""
    ctx = TaskContext.get()
    doomed = ctx.partitionId() == 0 and ctx.attemptNumber() == 0
    for batch in batches:
        yield batch
        if doomed:
            raise RuntimeError("simulated lost executor")


def flaky(spark):
    df = spark.range(0, N, numPartitions=4).select(
        F.col("id"), (F.col("id") % 7).cast("string").alias("k"))
    return df.mapInPandas(dies_once, df.schema)


def test_write_layer_survives_a_lost_task(spark, scratch):
    run = new_run()
    write_layer(flaky(spark), scratch, "t", "bronze", run, fmt="parquet")
    back = read_layer(spark, scratch, "t", "bronze", run.dt, run.run_id, fmt="parquet")
    got = back.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).first()
    assert (got["n"], got["ids"]) == (N, N)


def test_export_by_key_survives_a_lost_task(spark, scratch):
    assert export_by_key(flaky(spark), "k", f"{scratch}/export", fmt="parquet") == N
    back = spark.read.parquet(f"{scratch}/export")
    got = back.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).first()
    assert (got["n"], got["ids"]) == (N, N)


def test_merge_survives_a_lost_task(spark, scratch):
    db = f"r_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, f"{scratch}/{db}.db")
    name = f"{db}.landing"
    ensure_table(spark, name, spark.range(1).select(F.col("id"), F.lit("x").alias("k")).schema)
    overwrite_table(spark.range(0, N, 2).select("id", F.lit("old").alias("k")), name)
    assert merge_insert_only(flaky(spark), name, ["id"]) == N // 2
    got = read_table(spark, name).agg(F.count("*").alias("n"),
                                      F.count_distinct("id").alias("ids"),
                                      F.count_if(F.col("k") == "old").alias("old")).first()
    assert (got["n"], got["ids"], got["old"]) == (N, N, N // 2)
