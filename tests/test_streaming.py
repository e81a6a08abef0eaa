import hashlib
from datetime import date

from pyspark.sql import types as T

from layercake.functions import new_run
from layercake.sinks import write_layer
from layercake.sources.layers import layer_root
from layercake.streaming import stream_silver

SCHEMA = T.StructType([T.StructField("OrderItemID", T.IntegerType()),
                       T.StructField("FirstName", T.StringType()),
                       T.StructField("Status", T.StringType())])


def test_stream_silver_processes_each_bronze_file_once(spark, scratch):
    first = spark.createDataFrame([(1, "Ann", "Shipped"), (2, "", "Pending")], SCHEMA)
    write_layer(first, scratch, "orderitems", "bronze", new_run(), dt="2024-09-05")
    ckpt = f"{scratch}/_checkpoints/silver"
    stream_silver(spark, scratch, "orderitems", SCHEMA, ckpt, pii=["FirstName"]) \
        .awaitTermination()
    out = layer_root(scratch, "orderitems", "silver_stream")
    assert spark.read.parquet(out).count() == 2

    # a later drop (another day) arrives; a rerun takes only the new files
    second = spark.createDataFrame([(3, "Bo", "Delivered")], SCHEMA)
    write_layer(second, scratch, "orderitems", "bronze", new_run(), dt="2024-09-06")
    stream_silver(spark, scratch, "orderitems", SCHEMA, ckpt, pii=["FirstName"]) \
        .awaitTermination()
    stream_silver(spark, scratch, "orderitems", SCHEMA, ckpt, pii=["FirstName"]) \
        .awaitTermination()                                   # nothing new: no rows added
    # batch readers infer the dt= folder values as dates
    back = {r.OrderItemID: (r.FirstName, r.dt) for r in spark.read.parquet(out).collect()}
    assert back == {1: (hashlib.sha256(b"Ann").hexdigest(), date(2024, 9, 5)),
                    2: (None, date(2024, 9, 5)),              # '' read as NULL stays NULL
                    3: (hashlib.sha256(b"Bo").hexdigest(), date(2024, 9, 6))}


def test_stream_silver_drop_action(spark, scratch):
    rows_ = spark.createDataFrame([(1, "Ann", "Shipped"), (2, None, "Pending")], SCHEMA)
    write_layer(rows_, scratch, "orderitems", "bronze", new_run(), dt="2024-09-05")
    stream_silver(spark, scratch, "orderitems", SCHEMA, f"{scratch}/_checkpoints/drop",
                  pii=["firstname"], action="drop").awaitTermination()
    out = spark.read.parquet(layer_root(scratch, "orderitems", "silver_stream"))
    assert sorted(out.columns) == ["OrderItemID", "Status", "dt"]
    assert sorted(r.OrderItemID for r in out.collect()) == [1, 2]
