"""Property checks (few examples each: every example is a Spark job)."""

import hashlib
import re
import uuid
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from layercake.functions import hash_columns, new_run
from layercake.operators import status_report
from layercake.sinks import ensure_database, ensure_table, export_by_key, merge_insert_only

SETTINGS = dict(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])
text = st.one_of(st.none(), st.text(max_size=12))


@settings(**SETTINGS)
@given(st.lists(text, min_size=1, max_size=20))
def test_hash_is_deterministic_hex_and_python_equal(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = dict(hash_columns(df, ["v"]).collect())
    for i, v in enumerate(values):
        if v is None:
            assert got[i] is None
        else:
            assert re.fullmatch("[0-9a-f]{64}", got[i])
            assert got[i] == hashlib.sha256(v.encode()).hexdigest()


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["Shipped", "Delivered", "Pending", "shipped", None]),
                          st.one_of(st.none(), st.floats(0, 1e6).map(str), st.just("n/a"))),
                max_size=30))
def test_report_counts_bounded_by_total(spark, items):
    df = spark.createDataFrame(items, "Status string, Price string")
    r = status_report(df).first()
    assert r.items_shipped_count + r.items_delivered_count + r.items_pending_count \
        <= r.total_orders == len(items)
    assert r.items_shipped_count == sum(1 for s, _ in items if s == "Shipped")


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["IT", "R&D", "a/b", "x y"])),
                          st.integers(0, 100)), min_size=1, max_size=30))
def test_export_by_key_row_counts_sum_to_input(spark, tmp_path_factory, items):
    path = str(tmp_path_factory.mktemp("export"))
    df = spark.createDataFrame(items, "k string, v int")
    assert export_by_key(df, "k", path, fmt="parquet", replace="all") == len(items)
    back = spark.read.parquet(path)
    assert back.count() == len(items)
    assert sorted(back.groupBy("k").count().collect(), key=repr) == \
        sorted(df.groupBy("k").count().collect(), key=repr)


@settings(**SETTINGS)
@given(st.lists(st.integers(0, 20), unique=True, max_size=15),
       st.lists(st.integers(0, 20), unique=True, max_size=15))
def test_merge_with_unique_keys_is_idempotent(spark, tmp_path_factory, target, source):
    db = f"p_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, db, str(tmp_path_factory.mktemp(db)))
    name = f"{db}.t"
    ensure_table(spark, name, T.StructType([T.StructField("id", T.IntegerType()),
                                            T.StructField("v", T.StringType())]))
    merge_insert_only(spark.createDataFrame([(i, "t") for i in target], "id int, v string"),
                      name, ["id"])
    src = spark.createDataFrame([(i, "s") for i in source], "id int, v string")
    first = merge_insert_only(src, name, ["id"])
    assert first == len(set(source) - set(target))
    assert merge_insert_only(src, name, ["id"]) == 0
    got = {r.id: r.v for r in spark.table(name).collect()}
    assert set(got) == set(target) | set(source)
    assert all(got[i] == "t" for i in target)


def test_run_ids_sort_by_start_time_within_a_second():
    base = datetime(2024, 9, 5, 10, 0, 0)
    ids = [new_run(base + timedelta(microseconds=us)).run_id for us in (5, 50, 500, 5000)]
    assert ids == sorted(ids)


def test_run_stamp_columns(spark):
    run = new_run(datetime(2024, 9, 5, 10, 0))
    r = run.stamp(spark.range(1)).first()
    assert r.run_id == run.run_id and r.run_ts == datetime(2024, 9, 5, 10, 0)
    assert dict(run.stamp(spark.range(1)).dtypes)["run_ts"] == "timestamp_ntz"


key = st.one_of(st.none(), st.integers(0, 5))


@settings(**SETTINGS)
@given(st.lists(st.tuples(key, st.integers(0, 3), st.integers(0, 99)), max_size=25),
       st.lists(key, max_size=8))
def test_first_match_equals_brute_force(spark, cands, keys):
    """first_match == for each key row, the candidate with the smallest
    (rank, value) among those with an equal, non-NULL key (NULLs never match)."""
    from layercake.operators import first_match
    k = spark.createDataFrame([(x,) for x in keys], "k int")
    c = spark.createDataFrame(cands, "k int, rank int, v int")
    got = sorted(((r.k, r.v) for r in first_match(k, c, "k", ["rank", "v"], ["v"]).collect()),
                 key=repr)
    want = []
    for x in keys:
        mine = sorted((rank, v) for ck, rank, v in cands if x is not None and ck == x)
        want.append((x, mine[0][1] if mine else None))
    assert got == sorted(want, key=repr)


@settings(**SETTINGS)
@given(st.lists(st.tuples(key, st.integers(0, 9)), max_size=25), st.lists(key, max_size=10))
def test_rows_to_insert_equals_brute_force(spark, source, target):
    """The anti join keeps exactly the source rows whose key is NULL or absent
    from the target's non-NULL keys; duplicates are all kept."""
    from layercake.sinks import rows_to_insert
    s = spark.createDataFrame(source, "id int, v int")
    t = spark.createDataFrame([(x,) for x in target], "id int")
    got = sorted((tuple(r) for r in rows_to_insert(s, t, ["id"]).collect()), key=repr)
    present = {x for x in target if x is not None}
    want = sorted((r for r in source if r[0] is None or r[0] not in present), key=repr)
    assert got == want


zips = st.sampled_from(["1", " 1", "1  ", "\t1", "2", None])
cities = st.sampled_from(["Own", "", None])


@settings(**SETTINGS)
@given(st.lists(st.tuples(zips, cities), max_size=15),
       st.lists(st.tuples(st.sampled_from(["1", "2", "\t1", None]), st.sampled_from("ab")),
                max_size=6))
def test_lookup_fill_equals_brute_force(spark, people, dim):
    """Left key trimmed of spaces only (tabs stay); every matching dimension
    row fans out; City filled from the dimension only when NULL or ''."""
    from layercake.operators import lookup_fill
    left = spark.createDataFrame(people, "Zipcode string, City string")
    right = spark.createDataFrame(dim, "Zipcode string, Geo_City string")
    out = lookup_fill(left, right, "Zipcode", "Zipcode", {"City": "Geo_City"})
    got = sorted((tuple(r) for r in out.select("Zipcode", "City", "Geo_City").collect()), key=repr)
    want = []
    for z, city in people:
        t = None if z is None else z.strip(" ")
        hits = [g for dz, g in dim if t is not None and dz == t]
        for g in hits or [None]:
            want.append((t, g if city in (None, "") else city, g))
    assert got == sorted(want, key=repr)


@settings(**SETTINGS)
@given(st.lists(st.tuples(zips, cities), max_size=15),
       st.lists(st.tuples(st.sampled_from(["1", "2", "\t1", None]), st.sampled_from("abc")),
                max_size=8))
def test_lookup_fill_dedupe_equals_brute_force(spark, people, dim):
    """With dedupe_by every row keeps exactly one output row, matched to the
    dimension row with the smallest value for its key."""
    from layercake.operators import lookup_fill
    left = spark.createDataFrame(people, "Zipcode string, City string")
    right = spark.createDataFrame(dim, "Zipcode string, Geo_City string")
    out = lookup_fill(left, right, "Zipcode", "Zipcode", {"City": "Geo_City"},
                      dedupe_by=["Geo_City"])
    got = sorted((tuple(r) for r in out.select("Zipcode", "City", "Geo_City").collect()), key=repr)
    want = []
    for z, city in people:
        t = None if z is None else z.strip(" ")
        hits = sorted(g for dz, g in dim if t is not None and dz == t)
        g = hits[0] if hits else None
        want.append((t, g if city in (None, "") else city, g))
    assert got == sorted(want, key=repr)
