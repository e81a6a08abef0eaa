"""Newest-file scans (S5, S7) and the input-must-exist gate (Q1).

For files that other systems drop; runs of our own layers are found by their manifests
(:mod:`layercake.sources.layers`).  The listing is a Spark job over ``binaryFile`` metadata only
(the ``content`` column is never selected, so no file body is read), in a bounded number of tasks
whatever the number of files; the arg-max is a one-row aggregate.  Only that one path string
reaches the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import empty_files
from ..operators.quality import NoInputError, require_path
from ..schemas import REPORT


def list_files(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """``path, modificationTime, length`` of every non-hidden file below ``prefix``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(prefix).select("path", "modificationTime", "length")
        # no body is read, so the sizes by which Spark cuts tasks do not count
        return files.coalesce(max(1, spark.sparkContext.defaultParallelism))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame(
                [], "path string, modificationTime timestamp, length long")
        raise


def newest_file(spark: SparkSession, prefix: str, glob: str | None = None, *,
                empty: str = "skip") -> str | None:
    """Path of the non-empty file with the greatest modification time (ties broken by the
    greater path); None when there is none.  With ``empty="raise"`` a newer file of 0 bytes is an
    error (Q1); looking for one costs a call to the file system per file."""
    if empty not in ("skip", "raise"):
        raise ValueError("empty must be 'skip' or 'raise'")
    newest = list_files(spark, prefix, glob).where(F.col("length") > 0).agg(
        F.max_by(F.struct("path", F.unix_millis("modificationTime").alias("at")),
                 F.struct("modificationTime", "path")).alias("f")).first()["f"]
    if empty == "raise":
        late = [e for e in empty_files(spark, prefix, glob) if not newest or e[0] > newest["at"]]
        if late:
            raise NoInputError(f"the newest file under {prefix} is empty: {max(late)[1]}")
    return newest["path"] if newest else None


def read_newest(
    spark: SparkSession,
    prefix: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    glob: str | None = None,
    *,
    empty: str = "skip",
    **options: str,
) -> DataFrame:
    """S5 + Q1: read only the newest file under ``prefix``; raise if there is none (and, with
    ``empty="raise"``, if it has 0 bytes)."""
    path = require_path(newest_file(spark, prefix, glob, empty=empty), prefix)
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A gold report (JSON lines) with its declared schema."""
    return spark.read.schema(REPORT).json(path)
