"""Write, audit, publish: what readers see while runs are written, fail or lose their driver."""

import json
import os

import pytest
from pyspark.sql import functions as F

from layercake import commits
from layercake.functions import new_run
from layercake.operators import EmptyOutputError, NoInputError
from layercake.plans import latest_report
from layercake.sinks import files as sink
from layercake.sinks import publish_run, stage_run, write_layer, write_report
from layercake.sources import (committed, committed_runs, layer_root, newest_run, read_days,
                               read_layer, register_runs)

from .conftest import plan_text, rows

DAY = "2024-09-05"
REPORT = ("items_shipped_count long, items_delivered_count long, items_pending_count long, "
          "average_price double, total_orders long")


def test_write_once_is_whole_and_never_overwrites(spark, scratch):
    path = f"{scratch}/log/1.json"
    assert commits.write_once(spark, path, "first é")
    assert not commits.write_once(spark, path, "second")
    assert commits.read_text(spark, path) == "first é"
    assert [n for n, _ in commits.listing(spark, f"{scratch}/log")] == ["1.json"]
    assert commits.listing(spark, f"{scratch}/missing") == []


def test_empty_report_leaves_the_old_one_current(spark, scratch):
    report = spark.createDataFrame([(1, 2, 3, 4.5, 10)], REPORT)
    write_report(report, scratch, "orders", new_run(), dt=DAY)
    with pytest.raises(EmptyOutputError):
        write_report(report.limit(0), scratch, "orders", new_run(), dt=DAY)
    assert tuple(latest_report(spark, scratch, DAY, topic="orders").first()) == (1, 2, 3, 4.5, 10)
    assert committed_runs(spark, scratch, "orders", "gold").count() == 1


@pytest.mark.parametrize("lost", ["move_new", "commit_run"])
def test_driver_lost_between_write_and_publish(spark, scratch, monkeypatch, lost):
    """The driver dies before the folder is moved, or before the manifest is written: readers keep
    the old run, and the same work under a new run id publishes."""
    write_layer(spark.range(3), scratch, "t", "bronze", new_run(), dt=DAY)

    def dies(*_, **__):
        raise KeyboardInterrupt("driver killed")
    monkeypatch.setattr(sink, lost, dies)
    with pytest.raises(KeyboardInterrupt):
        write_layer(spark.range(9), scratch, "t", "bronze", new_run(), dt=DAY)
    monkeypatch.undo()
    assert read_layer(spark, scratch, "t", "bronze", DAY, schema="id long").count() == 3
    assert read_days(spark, scratch, "t", "bronze", schema="id long").count() == 3
    write_layer(spark.range(9), scratch, "t", "bronze", new_run(), dt=DAY)
    assert read_layer(spark, scratch, "t", "bronze", DAY, schema="id long").count() == 9


def test_staged_run_is_invisible_until_published(spark, scratch):
    run = new_run()
    staged, n = stage_run(spark.range(5), scratch, "t", "bronze", run, dt=DAY)
    assert n == 5
    with pytest.raises(NoInputError):
        read_layer(spark, scratch, "t", "bronze", DAY)
    publish_run(spark, staged, scratch, "t", "bronze", run, n, dt=DAY)
    assert read_layer(spark, scratch, "t", "bronze", DAY).count() == 5
    assert committed(spark, scratch, "t", "bronze", DAY, run.run_id)
    r = committed_runs(spark, scratch, "t", "bronze").first()
    assert (r.run_id, r.rows, r.dt) == (run.run_id, 5, DAY) and r.files >= 1 and r.bytes > 0
    with pytest.raises(FileExistsError):
        write_layer(spark.range(1), scratch, "t", "bronze", run, dt=DAY)


def test_newest_run_of_a_day_of_10000_files_reads_manifests_only(spark, scratch):
    run = write_layer(spark.range(10), scratch, "t", "bronze", new_run(), dt=DAY)
    for k in range(10_000):
        open(f"{run}/part-x{k}.parquet", "w").close()
    runs = committed_runs(spark, scratch, "t", "bronze", DAY, DAY)
    assert len(runs.inputFiles()) == 1 and runs.rdd.getNumPartitions() == 1
    assert newest_run(spark, scratch, "t", "bronze", DAY) == run


def test_newest_committed_run_of_each_day(spark, scratch):
    for day, n in (("2024-09-04", 5), (DAY, 7), (DAY, 3), ("2024-09-06", 11), ("2024-10-01", 2)):
        write_layer(spark.range(n), scratch, "t", "silver", new_run(), dt=day)
    stage_run(spark.range(99), scratch, "t", "silver", new_run(), dt=DAY)
    got = read_days(spark, scratch, "t", "silver", first="2024-09-04", last="2024-09-06")
    assert rows(got.groupBy(F.col("dt").cast("string")).count()) == [("2024-09-04", 5), (DAY, 3), ("2024-09-06", 11)]
    assert len(got.inputFiles()) < len(read_days(spark, scratch, "t", "silver", runs="all").inputFiles())
    assert read_days(spark, scratch, "t", "silver", runs="all").count() == 28
    assert "dt" in plan_text(got.where(F.col("dt") == DAY)).split("PartitionFilters: [")[1].split("]")[0]
    picked = committed_runs(spark, scratch, "t", "silver", "2024-09-04", "2024-09-06")
    assert "dt#" in plan_text(picked).split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(NoInputError):
        read_days(spark, scratch, "t", "silver", first="2030-01-01")


def test_foreign_runs_count_once_registered(spark, scratch):
    """A folder without ``_SUCCESS`` is never registered; a root marker says nothing of later runs."""
    base = layer_root(scratch, "t", "bronze")
    spark.range(6).withColumns({"dt": F.lit(DAY), "run_id": F.lit("bulk")}).write.partitionBy("dt", "run_id").parquet(base)
    assert register_runs(spark, scratch, "t", "bronze") == 0       # only the root has a marker
    assert register_runs(spark, scratch, "t", "bronze", require_success=False) == 1
    half = f"{base}/dt={DAY}/run_id=half"
    os.makedirs(half)
    spark.range(4).coalesce(1).write.parquet(f"{scratch}/other")
    part = next(f for f in os.listdir(f"{scratch}/other") if f.endswith(".parquet"))
    os.rename(f"{scratch}/other/{part}", f"{half}/{part}")
    assert register_runs(spark, scratch, "t", "bronze") == 0
    assert read_layer(spark, scratch, "t", "bronze", DAY).count() == 6
    open(f"{half}/_SUCCESS", "w").close()
    assert register_runs(spark, scratch, "t", "bronze") == 1
    assert read_layer(spark, scratch, "t", "bronze", DAY).count() == 4
    with open(f"{base}/_manifests/dt={DAY}/half.json") as f:
        assert json.load(f)["rows"] is None
