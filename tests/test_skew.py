"""Hot keys in shuffled joins: a key (NULL included) holding a third of all
rows must be split over several tasks, not funnelled into one.

The dimensions are forced past the broadcast threshold so the joins shuffle,
as they do at scale; AQE's skew-join handling must then mark the join
``skew=true`` and split the hot partition.  Results stay whole.
"""

import pytest
from pyspark.sql import functions as F

from layercake.operators import lookup, lookup_fill
from layercake.sinks import rows_to_insert

from .conftest import final_plan, session_conf

SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}
N = 300000


def hot_rows(spark, hot):
    """N rows; every third one carries the key ``hot`` (NULL or a value)."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id"))
    return spark.range(N).select(key.cast("bigint").alias("k"),
                                 F.sha2(F.col("id").cast("string"), 256).alias("payload"))


@pytest.mark.parametrize("hot", [None, 7])
def test_merge_anti_join_splits_hot_key(spark, hot):
    source = hot_rows(spark, hot)
    target = spark.range(1, N, 2).select(F.col("id").alias("k"))
    with session_conf(spark, SHUFFLED):
        new = rows_to_insert(source, target, ["k"])
        plan = final_plan(new)
        kept = new.select(F.count("*").alias("n"), F.count_if(F.col("k").isNull()).alias("null"),
                          F.count_if(F.col("k") == 7).alias("seven")).first()
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan
    # odd ids exist in the target; even ids and every NULL key are inserted,
    # the hot value 7 (odd) is matched and left out
    odd_ids = len([i for i in range(1, N, 2) if i % 3 != 0])
    expected = N - odd_ids - (N // 3 if hot == 7 else 0)
    assert kept["n"] == expected
    assert kept["null"] == (N // 3 if hot is None else 0)
    assert kept["seven"] == 0


@pytest.mark.parametrize("hot", [None, 7])
def test_lookup_splits_hot_key(spark, hot):
    facts = hot_rows(spark, hot)
    dim = spark.range(N).select(F.col("id").alias("key"),
                                (F.col("id") * 10).alias("value"))
    with session_conf(spark, SHUFFLED):
        out = lookup(facts, dim, "k", "key")
        plan = final_plan(out)
        got = out.select(F.count("*").alias("n"), F.count("value").alias("matched")).first()
    assert "SortMergeJoin(skew=true)" in plan and "LeftOuter" in plan
    assert got["n"] == N
    assert got["matched"] == (N - N // 3 if hot is None else N)


def test_lookup_fill_splits_hot_zip(spark):
    users = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(" Z1 ")).otherwise(F.col("id").cast("string"))
        .alias("Zipcode"),
        F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.lit("Town")).alias("City"),
        # varied payload: AQE measures skew on compressed shuffle bytes
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    zips = spark.range(N).select(
        F.when(F.col("id") == 0, F.lit("Z1")).otherwise(F.col("id").cast("string"))
        .alias("Zipcode"), F.lit("Geo").alias("Geo_City"))
    with session_conf(spark, SHUFFLED):
        out = lookup_fill(users, zips, "Zipcode", "Zipcode", {"City": "Geo_City"})
        plan = final_plan(out)
        got = out.groupBy("City").count().collect()
    assert "SortMergeJoin(skew=true)" in plan
    counts = {r["City"]: r["count"] for r in got}
    assert sum(counts.values()) == N
    assert counts["Geo"] == N // 2 and counts["Town"] == N // 2


def test_star_join_splits_hot_order(spark):
    """A third of the items belong to one order of one customer."""
    from layercake.operators import StarKeys, order_items_view
    items = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("OrderID"),
        (F.col("id") % 1000).alias("ProductID"), F.col("id").alias("OrderItemID"),
        F.sha2(F.col("id").cast("string"), 256).alias("Status"))
    orders = spark.range(N).select(F.col("id").alias("OrderID"),
                                   (F.col("id") % 5000).alias("CustomerID"))
    customers = spark.range(5000).select(F.col("id").alias("CustomerID"),
                                         F.col("id").cast("string").alias("FirstName"))
    products = spark.range(1000).select(F.col("id").alias("ProductID"),
                                        F.col("id").cast("string").alias("ProductName"))
    with session_conf(spark, SHUFFLED):
        out = order_items_view(items, orders, customers, products,
                               ["OrderItemID", "Status", "FirstName", "ProductName"], StarKeys())
        plan = final_plan(out)
        n = out.count()
    assert "SortMergeJoin(skew=true)" in plan
    assert n == N  # every item resolves its order, customer and product


def test_star_join_order_options_same_rows_fewer_fact_shuffles(spark):
    """With no side broadcastable, customers_first shuffles the items stream
    twice instead of three times; both orders give the same rows."""
    import re

    from layercake.operators import order_items_view
    from layercake.queries import STAR_COLUMNS, STAR_KEYS, star_tables

    from .conftest import SF_SMALL, plan_text, rows
    tabs = star_tables(spark, SF_SMALL)
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                              "spark.sql.adaptive.enabled": "false"}):
        plain = order_items_view(*tabs, STAR_COLUMNS, STAR_KEYS)
        dims = order_items_view(*tabs, STAR_COLUMNS, STAR_KEYS, customers_first=True)

        def fact_shuffles(df):
            # exchanges whose input carries l_orderkey (the items stream)
            details = plan_text(df).split("\n\n")
            return sum(1 for d in details if re.match(r"\(\d+\) Exchange", d)
                       and "l_orderkey" in d.split("Arguments", 1)[0])
        assert fact_shuffles(plain) == 3
        assert fact_shuffles(dims) == 2
        assert rows(plain) == rows(dims)
