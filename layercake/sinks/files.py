"""File sinks.

Every write goes through Spark's commit protocol: task outputs are staged and
published by the job commit, so a retried task or a lost executor never leaves
a half-written run visible.  Each run writes a fresh ``run_id=`` folder and
the whole folder (all part files) is the published unit.

Layers and reports are written, audited, then published: the run is staged in the layer's hidden
``_staging`` folder, its rows are counted by the write itself, and only when the audit passes is
the folder moved into place and its manifest written.  A failed audit, or a driver lost at any
step before the manifest, leaves the run that was current before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..commits import delete, exists, move_new
from ..functions.runinfo import RunInfo
from ..names import col
from ..operators.quality import EmptyOutputError, QuarantineError, counted, require_rows
from ..sources.layers import LAYER_CSV, commit_run, committed_runs, layer_path, layer_root


def write_layer(
    df: DataFrame,
    root: str,
    topic: str,
    layer: str,
    run: RunInfo,
    *,
    fmt: str = "parquet",
    dt: str | None = None,
    least_rows: int = 0,
) -> str:
    """K1: publish ``df`` as one run of a dated layer; returns the run folder.

    Parquet by default: text passes with newlines, padding, '' and NULL as they are.
    CSV layers are written with options that keep them too (``LAYER_CSV``).
    A run id is written once, never merged into.  With fewer than ``least_rows`` rows the
    run is not published (Q2): EmptyOutputError, and the day's newest run stays what it was.
    """
    staged, rows = stage_run(df, root, topic, layer, run, fmt=fmt, dt=dt)
    if rows < least_rows:
        delete(df.sparkSession, staged)
        raise EmptyOutputError(f"{rows} rows for {topic}/{layer}, at least {least_rows} expected; "
                               "nothing is published")
    return publish_run(df.sparkSession, staged, root, topic, layer, run, rows, dt=dt)


def stage_run(df: DataFrame, root: str, topic: str, layer: str, run: RunInfo, *,
              fmt: str = "parquet", dt: str | None = None) -> tuple[str, int]:
    """Write ``df`` where no reader looks; returns that folder and the rows written, as observed
    by the write itself."""
    spark = df.sparkSession
    final = layer_path(root, topic, layer, dt or run.dt, run.run_id)
    if exists(spark, final):
        raise FileExistsError(f"{final} is written already")
    staged = f"{layer_root(root, topic, layer)}/_staging/dt={dt or run.dt}/run_id={run.run_id}"
    observed, obs = counted(df, "layer_rows")
    writer = observed.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        writer = writer.options(**LAYER_CSV)
    writer.save(staged)
    return staged, int(obs.get.get("rows", 0) or 0)


def publish_run(spark: SparkSession, staged: str, root: str, topic: str, layer: str, run: RunInfo,
                rows: int, *, dt: str | None = None) -> str:
    """Move a staged run into place and commit it by its manifest."""
    path = layer_path(root, topic, layer, dt or run.dt, run.run_id)
    move_new(spark, staged, path)
    commit_run(spark, root, topic, layer, dt or run.dt, run.run_id, rows)
    return path


def write_report(report: DataFrame, root: str, topic: str, run: RunInfo,
                 *, layer: str = "gold", dt: str | None = None) -> str:
    """K2 + Q2: the one-row report as a single JSON file.  An empty report raises before it is
    published, and the last report stays current.

    The report is the output of a global aggregate (already one partition), so
    ``coalesce(1)`` moves one row, not data.
    """
    return write_layer(report.coalesce(1), root, topic, layer, run, fmt="json", dt=dt, least_rows=1)


def write_quarantine(quarantine: DataFrame, root: str, topic: str, run: RunInfo, *,
                     dt: str | None = None, most: int | None = None) -> int:
    """Publish malformed records as a run of the topic's ``quarantine`` layer and return how many
    there are.  With more than ``most`` nothing else should be loaded: raises once the records
    are published, so that they can be looked at."""
    path = write_layer(quarantine, root, topic, "quarantine", run, dt=dt)
    spark = quarantine.sparkSession
    (rows,) = committed_runs(spark, root, topic, "quarantine", dt or run.dt, dt or run.dt).where(
        F.col("run_id") == run.run_id).select("rows").first()
    if most is not None and rows > most:
        raise QuarantineError(f"{rows} malformed records, at most {most} allowed; see {path}")
    return rows


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """Plain CSV dataset with a header (K11's dimension publish)."""
    df.write.mode(mode).option("header", "true").csv(path)
    return path


def export_by_key(
    df: DataFrame,
    key: str,
    path: str,
    *,
    fmt: str = "csv",
    replace: str = "keys",
    max_records_per_file: int | None = None,
    keep_key: bool = False,
) -> int:
    """K8: one dataset per distinct ``key`` value (``path/key=value/``), in ONE job.

    ``replace="keys"`` overwrites only the folders of keys present in ``df``
    (dynamic partition overwrite); ``"all"`` replaces the whole ``path``.
    A NULL key goes to ``__HIVE_DEFAULT_PARTITION__``.  The key lives in the
    folder name and comes back as a column on read.  ``keep_key`` writes it into
    the files as well, below ``path/by_key=value/``: every file then holds all
    columns of ``df`` and can be read alone.

    Empty input raises (Q2); with ``"all"`` before the old export is touched.

    Layout for scale: the ``rebalance`` hint shuffles by key and lets AQE split
    a hot key over several tasks (and merge small keys), so a key holding a
    third of all rows is written in parallel, not by one task;
    ``max_records_per_file`` bounds file size.  Returns the rows written (Q2).
    """
    if replace not in ("keys", "all"):
        raise ValueError("replace must be 'keys' or 'all'")
    if replace == "all" and df.isEmpty():
        raise EmptyOutputError(f"no rows for {path}; the old export is kept")
    folder = f"by_{key}" if keep_key else key
    if keep_key:
        df = df.withColumn(folder, col(key))
    observed, obs = counted(df.hint("rebalance", col(folder)), "export_rows")
    writer = (observed.write.mode("overwrite").format(fmt).partitionBy(folder)
              .option("partitionOverwriteMode", "dynamic" if replace == "keys" else "static"))
    if fmt == "csv":
        writer = writer.option("header", "true")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(path)
    return require_rows(obs, path)


def select_key_first(df: DataFrame, key: str) -> DataFrame:
    """Put ``key`` first (useful before a per-key export preview)."""
    return df.select(col(key), *[col(c) for c in df.columns if c != key])
