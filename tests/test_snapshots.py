"""Versioned datasets: self-reading overwrites, concurrent merges, the key index, exports."""

import re
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from layercake.operators import EmptyOutputError, NoInputError
from layercake.sinks import (CommitConflict, drop_versions, ensure_database, export_generation, merge_snapshot,
                             read_snapshot, snapshot, versions, write_snapshot)
from layercake.sinks import snapshots as module

from .conftest import final_plan, rows, session_conf


def test_overwrite_from_a_query_over_itself(spark, scratch):
    root = f"{scratch}/t"
    with pytest.raises(NoInputError):
        read_snapshot(spark, root)
    assert write_snapshot(spark.range(10).withColumn("k", F.col("id") % 3), root, partition_by=["k"]) == 1
    old = read_snapshot(spark, root)
    assert write_snapshot(old.where("k > 0").withColumn("id", F.col("id") * 10), root, partition_by=["k"]) == 2
    assert sorted(r.id for r in read_snapshot(spark, root).collect()) == [10, 20, 40, 50, 70, 80]
    assert old.count() == 10 and read_snapshot(spark, root, 1).count() == 10  # the reader of before
    assert "PartitionFilters: [isnotnull(k" in final_plan(read_snapshot(spark, root).where("k = 1"))


def test_reader_during_the_swap_sees_the_old_rows(spark, scratch, monkeypatch):
    root, seen = f"{scratch}/t", []
    write_snapshot(spark.range(5), root)
    real = module.write_once

    def slow(*args):
        seen.append(read_snapshot(spark, root).count())   # data written, not yet committed
        return real(*args)
    monkeypatch.setattr(module, "write_once", slow)
    write_snapshot(spark.range(50), root)
    assert seen == [5] and read_snapshot(spark, root).count() == 50


def test_failed_audit_and_lost_driver_keep_the_old_version(spark, scratch, monkeypatch):
    root = f"{scratch}/t"
    write_snapshot(spark.range(5), root)
    with pytest.raises(EmptyOutputError):
        write_snapshot(spark.range(0), root, least_rows=1)

    def dies(*_):
        raise KeyboardInterrupt("driver killed")
    monkeypatch.setattr(module, "write_once", dies)
    with pytest.raises(KeyboardInterrupt):
        write_snapshot(spark.range(9), root)
    monkeypatch.undo()
    assert versions(spark, root) == [1] and read_snapshot(spark, root).count() == 5
    write_snapshot(spark.range(7), root)
    assert read_snapshot(spark, root).count() == 7
    assert drop_versions(spark, root) == 2                 # version 1 and the lost folder
    assert read_snapshot(spark, root).count() == 7 and versions(spark, root) == [2]


def test_expected_version(spark, scratch):
    root = f"{scratch}/t"
    assert write_snapshot(spark.range(1), root, expect=0) == 1
    with pytest.raises(CommitConflict):
        write_snapshot(spark.range(2), root, expect=0)
    assert write_snapshot(spark.range(3), root, expect=1) == 2
    assert read_snapshot(spark, root).count() == 3


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, v string")


@pytest.mark.parametrize("indexed", [False, True])
def test_two_interleaved_merges_insert_each_key_once(spark, scratch, monkeypatch, indexed):
    """The second merge commits between the first one's read and its commit."""
    root, db = f"{scratch}/t", f"m_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, f"{scratch}/{db}.db")
    options = {"index": f"{db}.landing_keys", "buckets": 4} if indexed else {}
    write_snapshot(batch(spark, ("1", "old")), root)
    real, other = module.write_once, []

    def late(sp, path, text):
        if not other:
            other.append(True)
            other.append(merge_snapshot(batch(spark, ("2", "b"), ("3", "b")), root, ["id"], **options))
        return real(sp, path, text)
    monkeypatch.setattr(module, "write_once", late)
    assert merge_snapshot(batch(spark, ("1", "a"), ("2", "a"), ("4", "a")), root, ["id"], **options) == 1
    assert other[1] == 2
    assert rows(read_snapshot(spark, root)) == [("1", "old"), ("2", "b"), ("3", "b"), ("4", "a")]


def test_merges_from_threads(spark, scratch):
    root = f"{scratch}/t"
    write_snapshot(spark.range(10).withColumn("who", F.lit(-1)), root)
    errors = []

    def merge(k):
        try:
            merge_snapshot(spark.range(40).withColumn("who", F.lit(k)), root, ["id"])
        except Exception as e:  # pragma: no cover - reported below
            errors.append(e)
    threads = [threading.Thread(target=merge, args=(k,)) for k in range(3)]
    [t.start() for t in threads], [t.join() for t in threads]
    got = read_snapshot(spark, root)
    assert not errors and got.count() == 40 and got.select("id").distinct().count() == 40


def test_key_index_null_and_duplicate_keys(spark, scratch):
    root, db = f"{scratch}/t", f"k_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, f"{scratch}/{db}.db")
    index = f"{db}.landing_keys"
    write_snapshot(batch(spark, ("1", "old"), (None, "old")), root)
    source = batch(spark, ("1", "new"), ("2", "a"), ("2", "b"), (None, "n"))
    assert merge_snapshot(source, root, ["ID"], index=index, buckets=4) == 3
    assert merge_snapshot(source, root, ["id"], index=index) == 1          # the NULL key again
    assert rows(read_snapshot(spark, root)) == [("1", "old"), ("2", "a"), ("2", "b"), (None, "n"), (None, "n"), (None, "old")]
    assert merge_snapshot(batch(spark, ("1", "x")), root, ["id"], index=index) == 0
    # an overwrite leaves the index behind; the next merge indexes the new folder
    write_snapshot(batch(spark, ("9", "only")), root)
    assert merge_snapshot(batch(spark, ("9", "x"), ("1", "back")), root, ["id"], index=index) == 1
    assert rows(read_snapshot(spark, root)) == [("1", "back"), ("9", "only")]


@pytest.mark.parametrize("bits", [1 << 20, 1 << 10])
def test_key_index_is_not_shuffled(spark, scratch, bits):
    """No Exchange above the index scan, and the rows equal a plain anti join's; a bitmap that
    would hold too many keys is left out."""
    root, db = f"{scratch}/t", f"x_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, f"{scratch}/{db}.db")
    index = f"{db}.keys"
    base = spark.range(0, 20000, 2).select(F.col("id"), (F.col("id") % 7).cast("string").alias("g"), F.lit("old").alias("v"))
    write_snapshot(base, root)
    source = spark.range(15000, 25000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("g"), F.lit("new").alias("v"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with session_conf(spark, off):
        assert merge_snapshot(source, root, ["id", "g"], index=index, buckets=8, bits=bits) == 7500
        snap = snapshot(spark, root)
        more = source.unionByName(spark.range(25000, 26000).select("id", F.lit("0").alias("g"), F.lit("n").alias("v")))
        plan = final_plan(module.rows_by_index(more, root, snap, ["id", "g"], index, bits))
    join = plan[plan.index("SortMergeJoin"):]
    scan = join.index("FileScan parquet spark_catalog." + index)
    above = [x for x in join[:scan].split("\n") if x.strip()]
    depth = len(re.match(r"[\s:|]*", above[-1])[0]) if above else 0
    side = []                       # the lines from the scan up to the join: its ancestors
    for line in reversed(join[:scan].split("\n")[:-1]):
        indent = len(re.match(r"[\s:|]*", line)[0])
        if indent < depth or not side:
            side.append(line)
            depth = min(depth, indent)
    assert "Bucketed: true" in join[scan:] and not [x for x in side if "Exchange" in x and "SortMergeJoin" not in x]
    assert ("BroadcastExchange" in plan) == (bits == 1 << 20)
    assert rows(read_snapshot(spark, root).groupBy("v").count()) == [("new", 7500), ("old", 10000)]
    assert module.rows_by_index(more, root, snap, ["id", "g"], index, bits).count() == 1000


def test_merge_into_a_partitioned_dataset(spark, scratch):
    root = f"{scratch}/t"
    write_snapshot(spark.range(6).withColumn("k", (F.col("id") % 2).cast("string")), root, partition_by=["k"])
    more = spark.range(4, 9).withColumn("k", F.lit("new"))
    assert merge_snapshot(more, root, ["id"]) == 3 and merge_snapshot(more, root, ["id"]) == 0
    got = read_snapshot(spark, root)
    assert got.columns == ["id", "k"] and rows(got.groupBy("k").count()) == [("0", 3), ("1", 3), ("new", 3)]
    write_snapshot(got, root, partition_by=["k"], expect=2)     # compacted into one folder
    assert len(snapshot(spark, root).folders) == 1 and read_snapshot(spark, root).count() == 9


def test_export_generation_is_swapped_whole(spark, scratch):
    root = f"{scratch}/export"
    df = spark.createDataFrame([(1, "IT"), (2, "R&D"), (3, "Ops/Field"), (4, None)], "id int, department string")
    export_generation(df, "department", root)
    old = read_snapshot(spark, root)
    export_generation(df.where("id = 2").withColumn("id", F.lit(5)), "department", root)
    assert rows(read_snapshot(spark, root)) == [(5, "R&D")]       # keys that are gone are gone
    assert rows(old) == rows(df)
    with pytest.raises(EmptyOutputError):
        export_generation(df.limit(0), "department", root)
    assert rows(read_snapshot(spark, root)) == [(5, "R&D")]
    export_generation(df, "department", root, keep_key=True, fmt="parquet")
    assert rows(read_snapshot(spark, root), "id", "department") == rows(df)
