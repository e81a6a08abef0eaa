"""Resumable evolution and quarantined rows."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layercake.functions import new_run
from layercake.operators import QuarantineError
from layercake.sinks import ensure_database, ensure_table, evolve_in_steps, overwrite_table, partition_columns, write_quarantine
from layercake.sinks import tables as module
from layercake.sources import quarantine_counts, read_csv_checked, read_layer

from .conftest import rows


@pytest.fixture
def visits(spark, scratch):
    db = f"e_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, f"{scratch}/{db}.db")
    name = f"{db}.visits"
    ensure_table(spark, name, T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                                            T.StructField("year", T.IntegerType()), T.StructField("k", T.StringType())]),
                 ["year", "k"])
    overwrite_table(spark.range(60).select(
        "id", F.expr("timestamp_ntz'2024-01-15 00:00:00' + make_interval(0, cast(id % 12 as int))").alias("ts"),
        (2020 + F.col("id") % 3).cast("int").alias("year"),
        F.when(F.col("id") % 2 == 0, "a/b=c d").otherwise(F.lit(None)).alias("k")), name)
    return name


MONTH = "date_format(ts, 'MMMM')"


@pytest.mark.parametrize("killed", [1, 3, 6])
def test_a_killed_rewrite_resumes_with_what_is_left(spark, visits, monkeypatch, killed):
    """Six partitions, one per step: the driver dies after some steps, the last of them written but not
    yet marked done; the next call rewrites that one and the rest, and nothing twice."""
    before = rows(spark.table(visits))
    real, marks = module.write_once, []

    def dies(sp, path, text):
        if len(marks) == killed - 1:
            raise KeyboardInterrupt("driver killed")
        marks.append(path)
        return real(sp, path, text)
    monkeypatch.setattr(module, "write_once", dies)
    with pytest.raises(KeyboardInterrupt):
        evolve_in_steps(spark, visits, "month", MONTH, per_step=1)
    assert rows(spark.table(visits)) == before               # the old table is in use
    again = []
    monkeypatch.setattr(module, "write_once", lambda *a: again.append(a) or real(*a))
    assert evolve_in_steps(spark, visits, "month", MONTH, per_step=1)
    assert len(again) == 6 - (killed - 1)
    assert partition_columns(spark, visits) == ["year", "k", "month"]
    got = spark.table(visits)
    assert rows(got.select("id", "ts", "year", "k")) == before
    assert got.where("month <> date_format(ts, 'MMMM') or month is null").count() == 0
    assert evolve_in_steps(spark, visits, "month", MONTH)     # nothing left to do
    assert len(again) == 6 - (killed - 1)


def test_steps_of_a_maintenance_window_and_a_lost_swap(spark, visits, monkeypatch):
    assert evolve_in_steps(spark, visits, "month", MONTH, per_step=2, max_steps=2) is False
    real, calls = spark.sql, []

    class Lost:
        """The session, dying after the first rename."""

        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            if "RENAME" in text:
                calls.append(text)
                if len(calls) == 2:
                    raise KeyboardInterrupt("driver killed")
            return real(text)
    with pytest.raises(KeyboardInterrupt):
        evolve_in_steps(Lost(), visits, "month", MONTH)
    assert not spark.catalog.tableExists(visits)
    assert evolve_in_steps(spark, visits, "month", MONTH)     # the second rename
    assert spark.table(visits).count() == 60 and partition_columns(spark, visits)[-1] == "month"


def test_rows_written_meanwhile_are_noticed(spark, visits):
    evolve_in_steps(spark, visits, "month", MONTH, per_step=1, max_steps=5)
    spark.table(visits).where("id < 6").write.insertInto(visits)
    with pytest.raises(RuntimeError, match="written to meanwhile"):
        evolve_in_steps(spark, visits, "month", MONTH)
    assert spark.table(visits).count() == 66


def test_unpartitioned_table_is_one_step(spark, visits):
    name = f"{visits}_flat"
    ensure_table(spark, name, spark.table(visits).select("id", "ts").schema)
    overwrite_table(spark.table(visits).select("id", "ts"), name)
    assert evolve_in_steps(spark, name, "month", MONTH)
    assert partition_columns(spark, name) == ["month"] and spark.table(name).count() == 60


# -- S1, S2: malformed records
def drop(scratch, text, name="a.csv"):
    with open(f"{scratch}/{name}", "w") as f:
        f.write(text)
    return scratch


def test_malformed_records_are_quarantined(spark, scratch, tmp_path_factory):
    path = drop(scratch, "id,name,n\n1,Ann,5\n2,Bo,five\n3,Cy\n4,Di,6,extra\n,,\n5,Ed,\n")
    drop(scratch, "id,name,n\n6,Fo,x\n", "b.csv")
    good, bad = read_csv_checked(spark, path, "id int, name string, n int")
    assert rows(good) == [(1, "Ann", 5), (5, "Ed", None), (None, None, None)]
    assert good.count() == 3 and good.select("id").where("id > 0").count() == 2   # pruned columns too
    assert rows(bad, "record") == [("2,Bo,five",), ("3,Cy",), ("4,Di,6,extra",), ("6,Fo,x",)]
    assert sorted((r.file[-5:], r.records) for r in quarantine_counts(bad).collect()) == [("a.csv", 3), ("b.csv", 1)]
    root, run = str(tmp_path_factory.mktemp("q")), new_run()
    assert write_quarantine(bad, root, "emp", run) == 4
    assert rows(read_layer(spark, root, "emp", "quarantine", run.dt), "record") == rows(bad, "record")
    with pytest.raises(QuarantineError):
        write_quarantine(bad, root, "emp", new_run(), most=3)
    assert write_quarantine(bad.limit(0), root, "emp", new_run(), most=0) == 0


def test_quoted_newlines_and_strings_without_schema(spark, scratch):
    path = drop(scratch, 'id,name\n1,"two\nlines, ""quoted"""\n2\n3,plain\n')
    good, bad = read_csv_checked(spark, path, quoted_newlines=True)
    assert rows(good) == [("1", 'two\nlines, "quoted"'), ("3", "plain")]
    assert [r.record.strip() for r in bad.collect()] == ["2"]


def test_columns_with_odd_names(spark, scratch):
    path = drop(scratch, "a.b,file,c`d\n1,x,2\nz,x,2\n")
    good, bad = read_csv_checked(spark, path, T.StructType([T.StructField(n, t) for n, t in (
        ("a.b", T.IntegerType()), ("file", T.StringType()), ("c`d", T.IntegerType()))]))
    assert [tuple(r) for r in good.collect()] == [(1, "x", 2)] and good.columns == ["a.b", "file", "c`d"]
    assert bad.first().record == "z,x,2" and bad.first().file.endswith("a.csv")
