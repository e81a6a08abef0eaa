"""Incremental silver (W2/W3 as a Structured Streaming job).

The batch flows pick "the newest bronze run" by listing files; a stream over
the bronze layer instead processes every committed bronze file exactly once,
whatever the arrival order: the source records the files it has taken in its
checkpoint, and the file sink publishes each micro-batch through its own
commit log (``_spark_metadata``), which batch readers of the output honour.
Run it with ``availableNow`` from a scheduler (drain what has arrived, stop)
or with a processing-time trigger as a long-running job.  The checkpoint must
live in the shared folder so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import hash_columns
from ..operators.projection import drop_pii
from ..schemas import ORDER_ITEMS_PII
from ..sources.layers import LAYER_CSV, layer_root


def bronze_stream(spark: SparkSession, root: str, topic: str, schema: T.StructType, *,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Every file of the bronze layer as a stream; ``dt``/``run_id`` come from
    the folder names (they are appended to ``schema``)."""
    full = T.StructType(list(schema.fields) + [T.StructField("dt", T.StringType()),
                                               T.StructField("run_id", T.StringType())])
    # files of any age count: a late run of an old day is not skipped
    reader = spark.readStream.format(fmt).schema(full).option("maxFileAge", "36500d")
    if fmt == "csv":
        reader = reader.options(**LAYER_CSV)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(layer_root(root, topic, "bronze"))


def stream_silver(spark: SparkSession, root: str, topic: str, schema: T.StructType,
                  checkpoint: str, *, pii: Sequence[str] = ORDER_ITEMS_PII,
                  action: str = "hash", fmt: str = "parquet", out_fmt: str = "parquet",
                  available_now: bool = True, max_files_per_trigger: int | None = None
                  ) -> StreamingQuery:
    """Start the incremental silver job; output at ``{root}/{topic}/silver_stream``,
    partitioned by the bronze ``dt``.  ``action``: ``hash`` (``''``/NULL -> NULL)
    or ``drop``.  Stateless, so no watermark is needed."""
    if action not in ("hash", "drop"):
        raise ValueError("action must be 'hash' or 'drop'")
    bronze = bronze_stream(spark, root, topic, schema, fmt=fmt,
                           max_files_per_trigger=max_files_per_trigger)
    silver = (hash_columns(bronze, pii, blank="null") if action == "hash"
              else drop_pii(bronze, pii)).drop("run_id")
    writer = (silver.writeStream.format(out_fmt).outputMode("append").partitionBy("dt")
              .option("checkpointLocation", checkpoint)
              .option("path", layer_root(root, topic, "silver_stream")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
