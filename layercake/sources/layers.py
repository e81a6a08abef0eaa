"""Dated medallion layers.

Layout: ``{root}/{topic}/{layer}/dt=YYYY-MM-DD/run_id={run}/part-*``.  Each run publishes a whole
directory (every part file) under its own id.  A run counts once its manifest exists: one small
JSON file ``_manifests/dt={day}/{run}.json`` of the layer, written in one step after the run's
files are in place and audited.  Readers find runs by reading manifests, never by listing part
files; Spark skips ``_`` folders, so manifests are no data.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import exists, listing, write_once
from ..operators.quality import require_path


#: Options of CSV layers, the same for writing and reading: quoted newlines, quotes, padding,
#: the empty text and NULL all come back as they were.
LAYER_CSV = {"header": "true", "multiLine": "true", "escape": '"', "nullValue": "\\N",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def layer_root(root: str, topic: str, layer: str) -> str:
    """``{root}/{topic}/{layer}``: every day and run of one layer."""
    return f"{root.rstrip('/')}/{topic}/{layer}"


def layer_path(root: str, topic: str, layer: str, dt: str, run_id: str | None = None) -> str:
    """The folder of one day (``dt=``) of a layer, or of one run of that day."""
    base = f"{layer_root(root, topic, layer)}/dt={dt}"
    return f"{base}/run_id={run_id}" if run_id else base


def legacy_prefix(project: str, day: date, topic: str, layer: str) -> str:
    """The ``project/yyyy/MMMM/dd/topic/layer/`` prefix of the original jobs."""
    return f"{project}/{day:%Y}/{day:%B}/{day:%d}/{topic}/{layer}/"


#: One committed run; ``rows`` is NULL for runs that another job wrote (:func:`register_runs`).
MANIFEST = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("files", T.LongType()),
    T.StructField("bytes", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("written_at", T.TimestampType()), T.StructField("dt", T.StringType())])


def manifest_folder(root: str, topic: str, layer: str) -> str:
    return f"{layer_root(root, topic, layer)}/_manifests"


def commit_run(spark: SparkSession, root: str, topic: str, layer: str, dt: str, run_id: str,
               rows: int | None, written_at: datetime | None = None) -> None:
    """Write the manifest of a run whose files are in place; raises if it has one already."""
    files = listing(spark, layer_path(root, topic, layer, dt, run_id))
    written_at = written_at or datetime.now(timezone.utc)
    text = json.dumps({"run_id": run_id, "files": len(files), "bytes": sum(n for _, n in files),
                       "rows": rows, "written_at": written_at.isoformat()})
    if not write_once(spark, f"{manifest_folder(root, topic, layer)}/dt={dt}/{run_id}.json", text):
        raise FileExistsError(f"run {run_id} of {topic}/{layer} {dt} is committed already")


def committed_runs(spark: SparkSession, root: str, topic: str, layer: str,
                   first: str | None = None, last: str | None = None) -> DataFrame:
    """The manifests of a layer (:data:`MANIFEST`); ``first``/``last`` bound ``dt`` and prune the
    manifest folders of other days."""
    base = manifest_folder(root, topic, layer)
    if not exists(spark, base):
        return spark.createDataFrame([], MANIFEST)
    one = f"{base}/dt={first}" if first and first == last else base
    if one != base and not exists(spark, one):
        return spark.createDataFrame([], MANIFEST)
    runs = spark.read.schema(MANIFEST).option("basePath", base).json(one)
    for bound in ([F.col("dt") >= first] if first else []) + ([F.col("dt") <= last] if last else []):
        runs = runs.where(bound)
    return runs


def newest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of each day: a grouped arg-max, combined map-side (ties by run id)."""
    return runs.groupBy("dt").agg(F.max_by("run_id", F.struct("written_at", "run_id")).alias("run_id"))


def committed(spark: SparkSession, root: str, topic: str, layer: str, dt: str, run_id: str) -> bool:
    """True once the run's manifest exists (no job)."""
    return exists(spark, f"{manifest_folder(root, topic, layer)}/dt={dt}/{run_id}.json")


def newest_run(spark: SparkSession, root: str, topic: str, layer: str, dt: str) -> str:
    """Directory of the newest committed run of ``dt`` (Q1 if none): one scan of that day's
    manifests, whatever the number of part files.  A run still being published, or one whose
    driver died before its commit, has no manifest and is not seen."""
    top = newest_runs(committed_runs(spark, root, topic, layer, dt, dt)).first()
    day = layer_path(root, topic, layer, dt)
    return require_path(f"{day}/run_id={top['run_id']}" if top else None, day)


def register_runs(spark: SparkSession, root: str, topic: str, layer: str, *,
                  require_success: bool = True) -> int:
    """Commit the runs that other jobs wrote into the layer; returns how many.

    Such a run needs its own ``_SUCCESS``.  A bulk load (one partitioned job over many days) leaves
    only the root's marker, which says nothing of later runs: its caller registers the runs once
    the job has returned, with ``require_success=False``.  Folders are listed, not part files.
    """
    base = layer_root(root, topic, layer)

    def register(day: str) -> int:
        dt, done = day[3:], 0
        known = {n.removesuffix(".json") for n, _ in
                 listing(spark, f"{manifest_folder(root, topic, layer)}/{day}")}
        for run, _ in listing(spark, f"{base}/{day}"):
            if (run.startswith("run_id=") and run[7:] not in known
                    and (not require_success or exists(spark, f"{base}/{day}/{run}/_SUCCESS"))):
                commit_run(spark, root, topic, layer, dt, run[7:], None)
                done += 1
        return done

    days = [n for n, _ in listing(spark, base) if n.startswith("dt=")]
    with ThreadPoolExecutor(16) as several:  # calls to the file system, no work of its own
        return sum(several.map(register, days))


def read_layer(
    spark: SparkSession,
    root: str,
    topic: str,
    layer: str,
    dt: str,
    run_id: str | None = None,
    *,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """All part files of one run of one day of a layer."""
    path = (layer_path(root, topic, layer, dt, run_id) if run_id
            else newest_run(spark, root, topic, layer, dt))
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**LAYER_CSV)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_days(
    spark: SparkSession,
    root: str,
    topic: str,
    layer: str,
    *,
    first: str | None = None,
    last: str | None = None,
    runs: str = "newest",
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """The days ``first``..``last`` (inclusive, all by default) in one read, with ``dt``/``run_id``
    from the folder names: the newest committed run of each day, or with ``runs="all"`` every
    committed run.  Only the chosen run folders are listed; one path per run reaches the driver.
    Raises (Q1) when no run is committed.  A filter on ``dt`` prunes further."""
    if runs not in ("newest", "all"):
        raise ValueError("runs must be 'newest' or 'all'")
    base = layer_root(root, topic, layer)
    chosen = committed_runs(spark, root, topic, layer, first, last)
    chosen = newest_runs(chosen) if runs == "newest" else chosen
    paths = [layer_path(root, topic, layer, r["dt"], r["run_id"])
             for r in chosen.select("dt", "run_id").toLocalIterator()]
    require_path(paths[0] if paths else None, base)
    reader = spark.read.format(fmt).option("basePath", base)
    if fmt == "csv":
        reader = reader.options(**LAYER_CSV)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)
