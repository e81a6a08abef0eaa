import os
from datetime import date

import pytest

from layercake.operators import NoInputError
from layercake.schemas import EMPLOYEE
from layercake.sources import (jdbc_read_options, legacy_prefix, newest_file, read_csv,
                               read_layer, read_newest)
from layercake.sinks import write_layer
from layercake.functions import new_run

EMP_CSV = """
employee_id,first_name,last_name,email,department,job_title,salary,hire_date,nationality,age,gender,education_level,performance_score,manager_id
1,Orla,Quist,orla.quist@example.com,Hydrology,River Surveyor,90000,2018-01-15,USA,41,Female,Diploma,71,10
2,Tavi,Brandt,"",Archives,Map Keeper,oops,2019-03-22,UK,52,Male,None,64,11
3,Ilse,Novak,,R&D,Glass Blower,61000,,Atlantis,33,Female,Licence,77,
"""


def write(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def test_typed_csv_permissive_blank_line_and_empty_cells(spark, scratch):
    p = write(f"{scratch}/emp.csv", EMP_CSV)
    df = read_csv(spark, p, EMPLOYEE)
    r = {x.employee_id: x for x in df.collect()}
    assert df.count() == 3
    assert r[2].salary is None and r[2].email is None      # malformed int, quoted ""
    assert r[3].email is None and r[3].hire_date is None and r[3].manager_id is None
    assert r[1].hire_date == date(2018, 1, 15) and r[1].salary == 90000


def test_untyped_csv_all_strings(spark, scratch):
    p = write(f"{scratch}/emp.csv", EMP_CSV)
    df = read_csv(spark, p)
    assert set(dict(df.dtypes).values()) == {"string"}
    assert df.first().salary == "90000"


def test_newest_file_mtime_nested_zero_bytes_tie_and_empty(spark, scratch):
    base = f"{scratch}/drops"
    write(f"{base}/a.csv", "x\n1\n", 1_000)
    write(f"{base}/sub/b.csv", "x\n2\n", 3_000)           # nested, newest non-empty
    write(f"{base}/c.csv", "x\n3\n", 2_000)
    write(f"{base}/empty.csv", "", 9_000)                   # 0 bytes: skipped
    assert newest_file(spark, base).endswith("/sub/b.csv")
    assert [r.x for r in read_newest(spark, base).collect()] == ["2"]
    write(f"{base}/d.csv", "x\n4\n", 3_000)                 # tie -> greater path
    assert newest_file(spark, base).endswith("/sub/b.csv")
    write(f"{base}/z.csv", "x\n5\n", 3_000)
    assert newest_file(spark, base).endswith("/z.csv")
    os.makedirs(f"{scratch}/nothing")
    with pytest.raises(NoInputError):
        read_newest(spark, f"{scratch}/nothing")
    with pytest.raises(NoInputError):
        read_newest(spark, f"{scratch}/missing")


def test_read_layer_takes_whole_newest_run(spark, scratch):
    df = spark.range(100).repartition(4)
    first = write_layer(df.where("id < 10"), scratch, "t", "bronze", new_run(), dt="2024-09-05")
    second = write_layer(df, scratch, "t", "bronze", new_run(), dt="2024-09-05")
    assert len([f for f in os.listdir(second) if f.startswith("part-")]) > 1
    back = read_layer(spark, scratch, "t", "bronze", "2024-09-05", schema="id long")
    assert back.count() == 100                              # every part file of the run
    run_id = first.rsplit("run_id=", 1)[1]
    assert read_layer(spark, scratch, "t", "bronze", "2024-09-05", run_id,
                      schema="id long").count() == 10
    with pytest.raises(NoInputError):
        read_layer(spark, scratch, "t", "bronze", "2024-09-06")


def test_legacy_prefix():
    assert legacy_prefix("online-shopping", date(2024, 9, 5), "orderitems", "bronze") == \
        "online-shopping/2024/September/05/orderitems/bronze/"


def test_jdbc_options():
    q = "select 1 as id"
    assert jdbc_read_options("jdbc:x", query=q)["query"] == q
    opts = jdbc_read_options("jdbc:x", query=q, partition_column="id", lower_bound=0,
                             upper_bound=100, num_partitions=4, user="u")
    assert opts["dbtable"] == f"({q}) q" and "query" not in opts
    assert opts["numPartitions"] == "4" and opts["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", table="t", partition_column="id")


def test_read_days_prunes_other_days(spark, scratch):
    """Every run of every day in one scan; a dt filter prunes the other days'
    folders (partition filter), and both runs of the kept day are read."""
    from pyspark.sql import functions as F

    from layercake.sources import read_days

    from .conftest import plan_text
    for day, n in (("2024-09-04", 5), ("2024-09-05", 7), ("2024-09-05", 3), ("2024-09-06", 11)):
        write_layer(spark.range(n), scratch, "t", "silver", new_run(), fmt="parquet", dt=day)
    days = read_days(spark, scratch, "t", "silver", runs="all")
    assert sorted(days.columns) == ["dt", "id", "run_id"]
    one = days.where(F.col("dt") == "2024-09-05")
    plan = plan_text(one)
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-09-05" in plan
    assert one.count() == 10
    assert one.select("run_id").distinct().count() == 2


def test_read_layer_skips_a_run_still_being_published(spark, scratch):
    """A newer run whose part files are in place but that is not committed is
    skipped; a foreign run counts once it has its ``_SUCCESS`` and is registered."""
    from layercake.sources import register_runs
    write_layer(spark.range(4), scratch, "t", "bronze", new_run(), dt="2024-09-05", fmt="csv")
    busy = f"{scratch}/t/bronze/dt=2024-09-05/run_id={new_run().run_id}"
    os.makedirs(busy)
    with open(f"{busy}/part-00000.csv", "w") as fh:
        fh.write("id\n100\n101\n")
    assert register_runs(spark, scratch, "t", "bronze") == 0
    back = read_layer(spark, scratch, "t", "bronze", "2024-09-05", schema="id long", fmt="csv")
    assert sorted(r.id for r in back.collect()) == [0, 1, 2, 3]
    open(f"{busy}/_SUCCESS", "w").close()        # the commit finishes
    assert register_runs(spark, scratch, "t", "bronze") == 1
    back = read_layer(spark, scratch, "t", "bronze", "2024-09-05", schema="id long", fmt="csv")
    assert sorted(r.id for r in back.collect()) == [100, 101]


def test_read_layer_bulk_load_counts_when_registered(spark, scratch):
    """One partitioned job over many days writes only a root _SUCCESS, which
    commits nothing by itself; its caller registers the runs."""
    from pyspark.sql import functions as F

    from layercake.sources import layer_root, register_runs
    run = new_run()
    days = spark.range(30).select(
        F.col("id"), F.when(F.col("id") < 10, "2024-09-04").otherwise("2024-09-05").alias("dt"),
        F.lit(run.run_id).alias("run_id"))
    days.write.partitionBy("dt", "run_id").parquet(layer_root(scratch, "t", "bronze"))
    with pytest.raises(NoInputError):
        read_layer(spark, scratch, "t", "bronze", "2024-09-05")
    assert register_runs(spark, scratch, "t", "bronze", require_success=False) == 2
    assert read_layer(spark, scratch, "t", "bronze", "2024-09-05").count() == 20


def test_newest_empty_file_raises_on_request(spark, scratch):
    base = f"{scratch}/drops"
    write(f"{base}/a.csv", "x\n1\n", 1_000)
    write(f"{base}/empty.csv", "", 9_000)
    assert [r.x for r in read_newest(spark, base, empty="raise", glob="a*").collect()] == ["1"]
    with pytest.raises(NoInputError, match="empty"):
        read_newest(spark, base, empty="raise")


def test_listing_many_files_takes_few_tasks(spark, scratch):
    from layercake.sources import list_files
    for k in range(3000):
        write(f"{scratch}/drops/{k % 7}/f{k}.csv", "x\n", 1_000 + k)
    files = list_files(spark, f"{scratch}/drops")
    assert files.count() == 3000
    assert files.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert newest_file(spark, f"{scratch}/drops").endswith("/f2999.csv")
