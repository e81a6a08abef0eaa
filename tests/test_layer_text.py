"""Layers keep text as it is, in Parquet and in CSV; odd export keys; unranked candidates."""

import pytest
from pyspark.sql import functions as F

from layercake.functions import new_run
from layercake.operators import EmptyOutputError, first_match, lookup
from layercake.plans import silver_hash
from layercake.sinks import export_by_key, write_layer
from layercake.sources import read_csv, read_layer

ROWS = [(1, "Ann\nLee", "  pad  "), (2, "", None), (3, 'q"uote, \\ back', "\ttab"), (4, None, "")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_layer_round_trip(spark, scratch, fmt):
    df = spark.createDataFrame(ROWS, "id long, name string, note string")
    run = new_run()
    write_layer(df, scratch, "t", "bronze", run, fmt=fmt)
    back = read_layer(spark, scratch, "t", "bronze", run.dt, run.run_id, fmt=fmt, schema=df.schema)
    assert sorted(back.collect()) == sorted(df.collect(), key=lambda r: r.id)


def test_no_clear_name_in_hashed_silver(spark, scratch):
    df = spark.createDataFrame(ROWS, "id long, name string, note string")
    run = new_run()
    write_layer(df, scratch, "t", "bronze", run)
    path = silver_hash(spark, scratch, run.dt, pii=["name"], topic="t")
    got = spark.read.parquet(path).collect()
    assert len(got) == 4 and not any("Lee" in str(r) for r in got)


@pytest.mark.parametrize("key", ["user.dept", "Dept Name"])
def test_export_key_with_an_odd_name(spark, scratch, key):
    df = spark.createDataFrame([(1, "a"), (2, "b")], ["id", key])
    assert export_by_key(df, key, f"{scratch}/out") == 2


def test_unranked_candidate_loses(spark):
    keys = spark.createDataFrame([("k",)], ["k"])
    cand = spark.createDataFrame([("k", None, "none"), ("k", 1, "first")], "k string, rank int, v string")
    assert first_match(keys, cand, "k", ["rank"], ["v"]).first().v == "first"


def test_export_keeps_the_key_in_the_files(spark, scratch):
    df = spark.createDataFrame([(1, "IT"), (2, "R&D"), (3, None)], "id int, dept string")
    assert export_by_key(df, "dept", f"{scratch}/out", keep_key=True) == 3
    back = read_csv(spark, f"{scratch}/out", df.schema, recursiveFileLookup="true")
    assert sorted(back.collect(), key=lambda r: r.id) == df.collect()


@pytest.mark.parametrize("replace", ["keys", "all"])
def test_empty_export_keeps_the_old_one(spark, scratch, replace):
    df = spark.createDataFrame([(1, "IT")], "id int, dept string")
    export_by_key(df, "dept", f"{scratch}/out", replace=replace)
    with pytest.raises(EmptyOutputError):
        export_by_key(df.limit(0), "dept", f"{scratch}/out", replace=replace)
    assert spark.read.option("header", True).csv(f"{scratch}/out").count() == 1


def test_lookup_dedupes_a_key_in_other_case(spark):
    df = spark.createDataFrame([("1",), ("2",)], ["zip"])
    dim = spark.createDataFrame([("1", "B"), ("1", "A")], ["Zipcode", "city"])
    got = lookup(df, dim, "zip", "ZIPCODE", dedupe_by=["city"])
    assert sorted(got.collect()) == [("1", "A"), ("2", None)]


def test_lookup_in_a_selection_of_the_table_itself(spark):
    staff = spark.createDataFrame([(1, "Ann", None), (2, "Bo", 1)], "id int, name string, boss int")
    names = staff.select("id", F.col("name").alias("boss_name"))
    got = lookup(staff, names, "boss", "id")
    assert got.columns == ["id", "name", "boss", "boss_name"]
    assert sorted(got.collect()) == [(1, "Ann", None, None), (2, "Bo", 1, "Ann")]
