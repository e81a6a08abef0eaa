"""CSV scans.

Default PERMISSIVE mode: a malformed typed cell reads as NULL and the row
stays; empty cells and ``""`` read as NULL; blank lines (also before the
header) are skipped.  No ``inferSchema`` (that would be an extra pass over
the data): without a schema every column is a string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..names import col

#: Options for files whose quoted cells may hold newlines and doubled quotes.
QUOTED_NEWLINES = {"multiLine": "true", "escape": '"'}
CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    header: bool = True,
    **options: str,
) -> DataFrame:
    """Typed scan when ``schema`` is given (S1/S8), all-string otherwise."""
    reader = spark.read.option("header", header).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    header: bool = True,
    quoted_newlines: bool = False,
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """S1/S2 with the malformed rows apart: (rows, quarantine).

    ``rows`` has the columns of ``schema`` and only records that match it.  ``quarantine`` has
    ``file`` and ``record``, the text of a record with a cell of the wrong type or with too few
    or too many cells.  Every record is in exactly one of the two.  Without a schema all columns
    are strings, named by the first line, and only the number of cells is checked.
    ``quoted_newlines`` reads cells with line breaks; each file is then read by one task.

    Both frames scan the files; write the quarantine first where its counts gate the load
    (:func:`quarantine_counts`).
    """
    if quoted_newlines:
        options = QUOTED_NEWLINES | options
    if schema is None:
        schema = read_csv(spark, path, header=header, **options).schema
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    path_column = "_file_path"
    checked = read_csv(spark, path, T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]),
                       header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
    # Spark parses only the columns that a query asks for, and cells that it skips are never
    # malformed: a test that always holds asks for all of them, whatever is selected later
    fields = [col(f.name) for f in schema.fields]
    whole = checked.select("*", F.col("_metadata.file_path").alias(path_column)).where(
        F.hash(*fields) >= F.lit(-(1 << 31)))
    return (whole.where(F.col(CORRUPT).isNull()).select(*fields),
            whole.where(F.col(CORRUPT).isNotNull()).select(F.col(path_column).alias("file"), F.col(CORRUPT).alias("record")))


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """(file, records): malformed records per file, combined map-side."""
    return quarantine.groupBy("file").agg(F.count("*").alias("records"))
