import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from layercake.operators import (apply_mapping, conform, distinct_values, drop_pii,
                                 first_match, lookup, lookup_fill, order_items_view, preview,
                                 status_report, top_n, where_equals)
from layercake.schemas import ORDER_ITEMS_COLUMNS

from .conftest import rows


def test_apply_mapping_multi_target_order_and_dotted_names(spark):
    df = spark.createDataFrame([("1", "Ann", "2024-01-01", "x")],
                               "`user.id` string, name string, created string, extra string")
    out = apply_mapping(df, {"name": ["first_name", "display_name"], "user.id": "id",
                             "created": ["created_at", "updated_at"]})
    assert out.columns == ["first_name", "display_name", "id", "created_at", "updated_at"]
    assert tuple(out.first()) == ("Ann", "Ann", "1", "2024-01-01", "2024-01-01")


def test_apply_mapping_unknown_source_raises(spark):
    df = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(AnalysisException):
        apply_mapping(df, {"missing": "x"}).collect()


def test_drop_pii_case_insensitive_and_absent(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")],
                               "id int, firstname string, LastName string, email string")
    assert drop_pii(df, ["FirstName", "lastname", "Email", "Phone"]).columns == ["id"]


def test_conform_orders_by_name_and_rejects_missing(spark):
    df = spark.createDataFrame([(1, "x")], "B int, a string")
    assert conform(df, ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(ValueError):
        conform(df, ["a", "c"])


def test_where_equals_and_null_key(spark):
    df = spark.createDataFrame([("IT",), (None,), ("R&D",)], "department string")
    assert rows(where_equals(df, "department", "R&D")) == [("R&D",)]
    assert rows(where_equals(df, "department", None)) == [(None,)]


def test_equality_filter_is_pushed_to_parquet(spark):
    df = where_equals(spark.read.parquet("/root/testdata/sf0.001/customer.parquet"),
                      "c_mktsegment", "BUILDING")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plan


def order_tables(spark):
    items = spark.createDataFrame(
        [(1, 10, 100, 2, 5.0, "Shipped"), (2, 10, 101, 1, 7.5, "Pending"),
         (3, 11, 100, 1, 5.0, "Delivered"), (4, 99, 100, 1, 5.0, "Shipped")],
        "OrderItemID int, OrderID int, ProductID int, Quantity int, UnitPrice double, Status string")
    orders = spark.createDataFrame([(10, 1, "2024-09-01", 17.5), (11, 2, "2024-09-02", 5.0)],
                                   "OrderID int, CustomerID int, OrderDate string, TotalAmount double")
    customers = spark.createDataFrame([(1, "Ann", "Lee", "a@x"), (2, "Bo", "Kim", None)],
                                      "CustomerID int, FirstName string, LastName string, Email string")
    products = spark.createDataFrame([(100, "bolt", "hw", 5.0), (101, "nut", "hw", 7.5)],
                                     "ProductID int, ProductName string, ProductType string, Price double")
    return items, orders, customers, products


@pytest.mark.parametrize("customers_first", [False, True])
def test_star_join_reference_shape(spark, customers_first):
    """The source's own names (OrderID, CustomerID on both sides of a join)
    resolve in either join order."""
    out = order_items_view(*order_tables(spark), ORDER_ITEMS_COLUMNS,
                           customers_first=customers_first)
    assert out.columns == list(ORDER_ITEMS_COLUMNS)
    # item 4 has no order: inner join drops it
    assert rows(out, "OrderItemID", "FirstName", "ProductName") == [
        (1, "Ann", "bolt"), (2, "Ann", "nut"), (3, "Bo", "bolt")]


def test_lookup_left_outer_drops_right_key(spark):
    emp = spark.createDataFrame([(1, "United States"), (2, "Atlantis"), (3, None)],
                                "employee_id int, nationality string")
    geo = spark.createDataFrame([("United States", 38.0, -97.0)],
                                "Country string, Latitude double, Longitude double")
    out = lookup(emp, geo, "nationality", "Country")
    assert out.columns == ["employee_id", "nationality", "Latitude", "Longitude"]
    assert rows(out) == [(1, "United States", 38.0, -97.0), (2, "Atlantis", None, None),
                         (3, None, None, None)]


def test_lookup_fill_trim_tab_fanout_and_blank_fallback(spark):
    users = spark.createDataFrame(
        [(1, "  10001 ", None), (2, "10001", ""), (3, "\t10001", None), (4, "20002", "Own"),
         (5, None, None), (6, "30003", "")],
        "id int, Zipcode string, City string")
    zips = spark.createDataFrame(
        [("10001", "NYC"), ("20002", "DC"), ("30003", "A"), ("30003", "B")],
        "Zipcode string, Geo_City string")
    out = lookup_fill(users, zips, "Zipcode", "Zipcode", {"City": "Geo_City"})
    assert out.columns == ["id", "Zipcode", "City", "Geo_City"]
    assert rows(out, "id", "Zipcode", "City") == [
        (1, "10001", "NYC"), (2, "10001", "NYC"), (3, "\t10001", None), (4, "20002", "Own"),
        (5, None, None), (6, "30003", "A"), (6, "30003", "B")]


def test_first_match_zero_one_several(spark):
    keys = spark.createDataFrame([("Peru",), ("Chad",), ("Fiji",)], "Country string")
    cands = spark.createDataFrame(
        [("Peru", 2, -9.0, -75.0), ("Peru", 1, -10.0, -76.0), ("Chad", 1, 15.0, 19.0)],
        "Country string, rank int, Latitude double, Longitude double")
    out = first_match(keys, cands, "Country", ["rank"], ["Latitude", "Longitude"])
    assert out.columns == ["Country", "Latitude", "Longitude"]
    assert rows(out) == [("Chad", 15.0, 19.0), ("Fiji", None, None), ("Peru", -10.0, -76.0)]


def test_first_match_hot_key_is_aggregated_partially(spark):
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    cands = spark.range(200000).select((F.col("id") % 3 == 0).cast("int").alias("k"),
                                       F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    out = first_match(keys, cands, "k", ["o"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    assert rows(out) == [(1, 0), (2, None)]


def status_rows(spark):
    return spark.createDataFrame(
        [("Shipped", "10"), ("Shipped", "n/a"), ("shipped", "5"), ("Delivered", None),
         ("Pending", ""), ("Returned", "20"), (None, "30")],
        "status string, price string")


def test_status_report_exact_match_malformed_and_total(spark):
    r = status_report(status_rows(spark), "Status", "Price").first().asDict()
    assert r == {"items_shipped_count": 2, "items_delivered_count": 1,
                 "items_pending_count": 1, "average_price": 65 / 4, "total_orders": 7}


def test_status_report_empty_input(spark):
    empty = spark.createDataFrame([], "Status string, Price string")
    r = status_report(empty).first().asDict()
    assert r == {"items_shipped_count": 0, "items_delivered_count": 0, "items_pending_count": 0,
                 "average_price": None, "total_orders": 0}


def test_status_report_one_scan(spark, scratch):
    status_rows(spark).write.parquet(scratch + "/s")
    rep = status_report(spark.read.parquet(scratch + "/s"), "status", "price")
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1


def test_distinct_top_and_preview(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, d string")
    assert rows(distinct_values(df, "d")) == [("a",), ("b",), (None,)]
    assert [r.id for r in top_n(df, [F.col("id").desc()], 1).collect()] == [4]
    assert [r.id for r in preview(df, [F.col("id")], 2).collect()] == [1, 2]


def test_lookup_fill_dedupe_keeps_one_match_per_row(spark):
    from layercake.operators import first_per_key
    users = spark.createDataFrame([("1 ", ""), ("1", None), ("2", "Own"), (None, "")],
                                  "Zipcode string, City string")
    zips = spark.createDataFrame([("1", "Town B"), ("1", "Town A"), ("2", "Z"), (None, "N")],
                                 "Zipcode string, Geo_City string")
    fanned = lookup_fill(users, zips, "Zipcode", "Zipcode", {"City": "Geo_City"})
    assert fanned.count() == 6                                   # zip 1 matches twice
    one = lookup_fill(users, zips, "Zipcode", "Zipcode", {"City": "Geo_City"},
                      dedupe_by=["Geo_City"])
    assert rows(one, "Zipcode", "City") == [("1", "Town A"), ("1", "Town A"), ("2", "Own"),
                                            (None, None)]
    firsts = first_per_key(zips, "Zipcode", ["Geo_City"])
    assert firsts.columns == ["Zipcode", "Geo_City"]
    assert "partial_min_by" in firsts._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_key_only_and_ties(spark):
    from layercake.operators import first_per_key
    keys_only = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(first_per_key(keys_only, "k", ["k"])) == [("a",), (None,)]
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "w")],
                               "k string, r int, v string")
    assert rows(first_per_key(df, "k", ["r", "v"])) == [("a", 1, "y"), ("b", 5, "w")]


def test_lookup_dedupe_by(spark):
    people = spark.createDataFrame([(1, "Peru"), (2, "Chad")], "id int, nationality string")
    geo = spark.createDataFrame([("Peru", 2, -9.0), ("Peru", 1, -10.0), ("Chad", 1, 15.0)],
                                "Country string, rank int, Latitude double")
    assert lookup(people, geo, "nationality", "Country").count() == 3
    one = lookup(people, geo, "nationality", "Country", dedupe_by=["rank"])
    assert rows(one, "id", "Latitude") == [(1, -10.0), (2, 15.0)]
