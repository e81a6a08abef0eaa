import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from layercake.functions import (blank_fallback, cast_if_present, date_path, hash_columns,
                                 is_blank, join_nonnull, month_name, new_run, recode,
                                 sha256_hex, trim_spaces, year_of)

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def test_sha256_matches_python_incl_non_ascii(spark):
    values = ["alice", "Zoë Ünïcødé", "日本語", "a b\tc"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.h for r in df.select(sha256_hex(F.col("v")).alias("h")).collect()]
    assert got == [hashlib.sha256(v.encode()).hexdigest() for v in values]
    assert all(len(h) == 64 and h == h.lower() for h in got)


def test_hash_null_preserving_vs_blank_to_null(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, v string")
    keep = dict(hash_columns(df, ["v"], blank="hash").collect())
    blank = dict(hash_columns(df, ["v"], blank="null").collect())
    assert keep == {1: None, 2: EMPTY_SHA, 3: hashlib.sha256(b"x").hexdigest()}
    assert blank == {1: None, 2: None, 3: hashlib.sha256(b"x").hexdigest()}


def test_hash_columns_case_insensitive_absent_ignored_and_non_string(spark):
    df = spark.createDataFrame([(7, "Ann")], "id int, firstname string")
    out = hash_columns(df, ["FirstName", "Email", "id"])
    assert out.columns == ["id", "firstname"]
    r = out.first()
    assert r.firstname == hashlib.sha256(b"Ann").hexdigest()
    assert r.id == hashlib.sha256(b"7").hexdigest()


def test_hash_twice_hashes_the_hash(spark):
    df = spark.createDataFrame([("x",)], "v string")
    twice = hash_columns(hash_columns(df, ["v"]), ["v"]).first().v
    once = hashlib.sha256(b"x").hexdigest()
    assert twice == hashlib.sha256(once.encode()).hexdigest()


def test_hash_stays_in_codegen_no_python_udf(spark):
    df = spark.createDataFrame([("x",)], "v string")
    plan = hash_columns(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "PythonUDF" not in plan


def test_recode_and_blank_rules(spark):
    df = spark.createDataFrame(
        [("USA", None, "fb"), ("UK", "", "fb"), ("Peru", " ", "fb"), (None, "x", "fb")],
        "n string, c string, f string")
    out = df.select(recode(F.col("n"), {"USA": "United States", "UK": "United Kingdom"}).alias("n"),
                    is_blank(F.col("c")).alias("b"),
                    blank_fallback(F.col("c"), F.col("f")).alias("c")).collect()
    assert [tuple(r) for r in out] == [
        ("United States", True, "fb"), ("United Kingdom", True, "fb"),
        ("Peru", False, " "), (None, False, "x")]


def test_trim_spaces_only(spark):
    df = spark.createDataFrame([("  12 ",), ("\t12",), ("12\t ",)], "z string")
    assert [r.z for r in df.select(trim_spaces(F.col("z")).alias("z")).collect()] == [
        "12", "\t12", "12\t"]


def test_concat_ws_semantics(spark):
    df = spark.createDataFrame([("a", None, "", "d"), (None, None, None, None)],
                               "a string, b string, c string, d string")
    got = [r.x for r in df.select(join_nonnull(", ", *[F.col(c) for c in "abcd"]).alias("x"))
           .collect()]
    assert got == ["a, , d", ""]


def test_date_parts(spark):
    df = spark.createDataFrame([(datetime(2024, 9, 5, 10, 0), date(2018, 1, 15))],
                               "ts timestamp, d date")
    r = df.select(year_of(F.col("d")).alias("y"), month_name(F.col("ts")).alias("m"),
                  date_path(F.col("ts")).alias("p")).first()
    assert (r.y, r.m, r.p) == (2018, "September", "2024/September/05")
    assert dict(df.select(year_of(F.col("d")).alias("y")).dtypes)["y"] == "int"


def test_cast_if_present_malformed_to_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "1.5"), ("bad", "n/a")],
                               "Created_At string, price string")
    out = cast_if_present(df, {"created_at": "timestamp_ntz", "updated_at": "timestamp",
                               "price": "double"})
    assert out.columns == ["Created_At", "price"]
    got = [tuple(r) for r in out.collect()]
    assert got == [(datetime(2024, 1, 2, 3, 4, 5), 1.5), (None, None)]


def test_run_ids_unique_and_sortable():
    a, b = new_run(datetime(2024, 9, 5, 10, 0)), new_run(datetime(2024, 9, 5, 10, 1))
    assert a.run_id != b.run_id and a.run_id < b.run_id and a.dt == "2024-09-05"


def test_to_double_and_to_timestamp_never_fail(spark):
    from layercake.functions import to_double, to_timestamp
    df = spark.createDataFrame([("1.5", "2024-09-05 10:00:00"), ("n/a", "bad"), (None, None)],
                               "p string, t string")
    got = df.select(to_double(F.col("p")).alias("p"), to_timestamp(F.col("t"), ntz=True)
                    .alias("t")).collect()
    assert [(r.p, r.t) for r in got] == [(1.5, datetime(2024, 9, 5, 10, 0)), (None, None),
                                         (None, None)]
