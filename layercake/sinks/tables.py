"""Catalog table operations.

Writes resolve columns BY NAME (never by position) and are preceded by a
``rebalance`` hint on the partition columns, so AQE sizes the output files
per partition value instead of one file per task per value.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import listing, read_text, write_once
from ..names import col, quote, resolve
from ..operators.projection import conform
from ..operators.quality import counted
from ..schemas import ddl_columns


def qualified(name: str) -> str:
    """``db.table`` -> ``\\`db\\`.\\`table\\```."""
    return ".".join(quote(part) for part in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K3: CREATE DATABASE IF NOT EXISTS."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(name)}{where}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    *,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """K4: CREATE TABLE IF NOT EXISTS, DDL generated from ``schema``.

    Partition on low-cardinality columns: every distinct combination is a
    folder, and a near-unique combination makes one tiny file per row.
    """
    parts = f" PARTITIONED BY ({', '.join(quote(p) for p in partition_by)})" if partition_by else ""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(name)} ({ddl_columns(schema)}) "
              f"USING {fmt}{parts}{where}")


def table_info(spark: SparkSession, name: str) -> dict[str, str]:
    """Provider, Location, Type ... from DESCRIBE TABLE EXTENDED."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(name)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"]}


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The table's partition columns, in partition order (catalog metadata only)."""
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _aligned(spark: SparkSession, df: DataFrame, name: str, fill_missing: bool = False
             ) -> tuple[DataFrame, list[str]]:
    """``df`` projected to the table's column order by name, rebalanced on the
    table's partition columns; and those columns."""
    aligned = conform(df, spark.table(name).schema, fill_missing=fill_missing)
    parts = partition_columns(spark, name)
    return (aligned.hint("rebalance", *map(col, parts)) if parts else aligned), parts


def overwrite_table(df: DataFrame, name: str, mode: str = "static", *,
                    finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K5: INSERT OVERWRITE by name.

    ``static`` replaces every row of the table; ``dynamic`` replaces only the
    partitions present in ``df``.  With ``finish``, ``df`` holds the partition
    columns and is shuffled by them as it is; ``finish`` then makes the table's
    columns.  Lookups in broadcast dimensions and hashes belong there: what they
    add is not shuffled.

    The source must not read ``name`` itself (Spark refuses to overwrite a table it is reading); a dataset that is
    rewritten from itself is kept by :mod:`layercake.sinks.snapshots`.
    """
    if mode not in ("static", "dynamic"):
        raise ValueError("mode must be 'static' or 'dynamic'")
    spark = df.sparkSession
    if finish:
        parts = partition_columns(spark, name)
        gathered = df.hint("rebalance", *map(col, parts)) if parts else df
        aligned = conform(finish(gathered), spark.table(name).schema)
    else:
        aligned, parts = _aligned(spark, df, name)
    if mode == "static" or not parts:
        aligned.write.insertInto(name, overwrite=True)
        return
    # v1 tables ignore a per-write overwrite mode on insertInto; a write to the
    # table's folder honours it.  Then register new partitions, drop caches.
    info = table_info(spark, name)
    (aligned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(info.get("Provider", "parquet")).partitionBy(*parts).save(info["Location"]))
    spark.sql(f"ALTER TABLE {qualified(name)} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def append_by_name(df: DataFrame, name: str, *, fill_missing: bool = False) -> None:
    """INSERT INTO by name; ``fill_missing`` writes NULL to table columns the
    source lacks (source columns unknown to the table still raise)."""
    spark = df.sparkSession
    _aligned(spark, df, name, fill_missing)[0].write.insertInto(name, overwrite=False)


def merge_insert_only(source: DataFrame, name: str, keys: Sequence[str]) -> int:
    """Insert the source rows whose key has no match in the table.

    Matched rows are left untouched; nothing is updated or deleted.  A NULL
    key never matches, so such rows are always inserted; duplicate source keys
    are all inserted.  Where the table format supports MERGE (a row-level
    catalog) the catalog's MERGE runs; otherwise a left-anti join against the
    table's key columns only, then an append by name (single writer assumed;
    :func:`~layercake.sinks.snapshots.merge_snapshot` allows several).
    Table columns the source lacks are inserted as NULL (``INSERT *`` by name
    into a wider landing table).  Returns the number of rows inserted (-1 when
    the catalog MERGE ran).
    """
    spark = source.sparkSession
    provider = table_info(spark, name).get("Provider", "").lower()
    if provider in ("iceberg", "delta"):
        view = f"__merge_source_{uuid.uuid4().hex[:8]}"
        cond = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in keys)
        source.createOrReplaceTempView(view)
        try:
            spark.sql(f"MERGE INTO {qualified(name)} AS t USING {view} AS s ON {cond} "
                      "WHEN NOT MATCHED THEN INSERT *")
        finally:
            spark.catalog.dropTempView(view)
        return -1
    new_rows, obs = counted(rows_to_insert(source, spark.table(name), keys), "merge_inserted")
    append_by_name(new_rows, name, fill_missing=True)
    return int(obs.get.get("rows", 0) or 0)


def rows_to_insert(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key has no match in ``target`` (left-anti join
    against the target's key columns only).

    A NULL key never matches, so NULL-key rows are always kept; duplicate
    source keys are all kept.  When the join is shuffled (a target too big to
    broadcast), a key holding a third of the source rows (NULL included) makes
    one skewed partition, which AQE's skew-join handling splits over several
    tasks (``tests/test_skew.py``).
    """
    tkeys = target.select(*[col(resolve(target, k) or k).alias(f"__k{i}")
                            for i, k in enumerate(keys)])
    cond = None
    for i, k in enumerate(keys):
        c = source[quote(resolve(source, k) or k)] == tkeys[f"__k{i}"]
        cond = c if cond is None else cond & c
    return source.join(tkeys, cond, "left_anti")


def add_column(spark: SparkSession, name: str, column: str, dtype: str) -> bool:
    """K9: ALTER TABLE ADD COLUMNS; old rows read NULL.  Idempotent: returns
    False (and changes nothing) when the column already exists."""
    if resolve(spark.table(name), column) is not None:
        return False
    spark.sql(f"ALTER TABLE {qualified(name)} ADD COLUMNS ({quote(column)} {dtype.upper()})")
    return True


def evolve_partitioning(spark: SparkSession, name: str, field: str, expr: Column | str) -> bool:
    """Add a derived partition field (e.g. month name of a timestamp).

    Plain file tables cannot change their partition spec in place, so the
    table is rewritten once into a new table partitioned by the old columns
    plus ``field`` (computed from ``expr`` for every row, which also
    backfills an existing NULL column), then swapped in under the old name.
    The swap is two renames (old -> backup, rewrite -> name) and the backup
    is dropped last, so a driver lost at any step leaves every row readable
    under the name, the backup name or the staging name (named in the error).
    Idempotent: False when ``field`` is already a partition column.
    """
    parts = partition_columns(spark, name)
    if field in parts:
        return False
    info = table_info(spark, name)
    fmt = info.get("Provider", "parquet")
    value = F.expr(expr) if isinstance(expr, str) else expr
    src = spark.table(name)
    rewritten = src.withColumn(field, value)
    data_cols = [c for c in rewritten.columns if c not in parts and c != field]
    rewritten = rewritten.select(*[col(c) for c in data_cols], *[col(c) for c in parts], col(field))
    tag = uuid.uuid4().hex[:8]
    staging, backup = f"{name}__evolve_{tag}", f"{name}__before_{tag}"
    (rewritten.hint("rebalance", *map(col, [*parts, field])).write.format(fmt)
     .partitionBy(*parts, field).saveAsTable(staging))
    spark.sql(f"ALTER TABLE {qualified(name)} RENAME TO {qualified(backup)}")
    try:
        spark.sql(f"ALTER TABLE {qualified(staging)} RENAME TO {qualified(name)}")
    except AnalysisException as e:
        raise RuntimeError(f"evolved table left as {staging}, the old one as {backup}; "
                           f"rename {staging} to {name}") from e
    # a rename moves the folder; re-register the partitions at their new place
    spark.sql(f"ALTER TABLE {qualified(name)} RECOVER PARTITIONS")
    spark.sql(f"DROP TABLE {qualified(backup)}")
    return True


def evolve_in_steps(spark: SparkSession, name: str, field: str, expr: Column | str, *,
                    per_step: int = 32, max_steps: int | None = None) -> bool:
    """K10 as a resumable rewrite: as :func:`evolve_partitioning`, ``per_step`` partitions at a time.

    The new table ``{name}__evolve_{field}`` fills up beside the old one; after each step one
    small file in its ``_progress`` folder names the partitions that are done.  A run that is
    killed leaves the old table in use, and the next call with the same arguments rewrites only
    what is not yet marked: an unmarked step starts over, its folders are replaced.  ``max_steps``
    ends a call early (a maintenance window); the next one goes on.  True when the table is
    partitioned by ``field`` in the end (also when it was before), False when steps are left.

    Writers must pause for the whole time: rows that arrive in a partition already done are
    noticed by their count, and the swap is refused.  An unpartitioned table is one step.
    """
    staging, backup = f"{name}__evolve_{field}", f"{name}__before_{field}"
    if not spark.catalog.tableExists(name):
        if not (spark.catalog.tableExists(staging) and spark.catalog.tableExists(backup)):
            raise ValueError(f"no table {name}, and no unfinished evolution of it")
        return _swap_in(spark, name, staging, backup)  # a driver was lost between the two renames
    parts = partition_columns(spark, name)
    if field in parts:
        if spark.catalog.tableExists(backup):
            spark.sql(f"DROP TABLE {qualified(backup)}")
        return True
    source, value = spark.table(name), F.expr(expr) if isinstance(expr, str) else expr
    data = [f for f in source.schema.fields if f.name not in parts and f.name != field]
    kind = source.select(value.alias(field)).schema[field].dataType
    columns = T.StructType([*data, *(source.schema[p] for p in parts), T.StructField(field, kind)])
    fmt = table_info(spark, name).get("Provider", "parquet")
    ensure_table(spark, staging, columns, [*parts, field], fmt=fmt)
    location = table_info(spark, staging)["Location"]
    done, copied = set(), 0
    for file, _ in listing(spark, f"{location}/_progress"):
        step = json.loads(read_text(spark, f"{location}/_progress/{file}"))
        done.update(step["partitions"])
        copied += step["rows"]
    listed = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {qualified(name)}").collect()] if parts else [""]
    todo = [p for p in listed if p not in done]
    steps = [todo[i:i + per_step] for i in range(0, len(todo), per_step)]
    for step in steps[:max_steps]:
        rows = source.where(_is_partition(source, parts, step)) if parts else source
        observed, obs = counted(rows.withColumn(field, value).select(*map(col, columns.fieldNames())), "evolved_rows")
        (observed.hint("rebalance", *map(col, [*parts, field])).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy(*parts, field).save(location))
        n = int(obs.get.get("rows", 0) or 0)
        write_once(spark, f"{location}/_progress/{uuid.uuid4().hex}.json", json.dumps({"partitions": step, "rows": n}))
        copied += n
    if max_steps is not None and len(steps) > max_steps:
        return False
    have = source.count()
    if have != copied:
        raise RuntimeError(f"{name} has {have} rows, {copied} were copied: it was written to meanwhile. "
                           f"Drop {staging} and start over")
    return _swap_in(spark, name, staging, backup)


def _is_partition(source: DataFrame, parts: Sequence[str], step: Sequence[str]) -> Column:
    """The partitions named ``a=1/b=x``, as a filter on their columns that prunes folders."""
    out = F.lit(False)
    for spec in step:
        one = F.lit(True)
        for part, text in zip(parts, spec.split("/")):
            shown = unquote(text.split("=", 1)[1])
            null = shown == "__HIVE_DEFAULT_PARTITION__"
            one = one & (col(part).isNull() if null else col(part) == F.lit(shown).cast(source.schema[part].dataType))
        out = out | one
    return out


def _swap_in(spark: SparkSession, name: str, staging: str, backup: str) -> bool:
    """``staging`` takes the name of the table; the old table goes last."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {qualified(name)} RENAME TO {qualified(backup)}")
    spark.sql(f"ALTER TABLE {qualified(staging)} RENAME TO {qualified(name)}")
    spark.sql(f"ALTER TABLE {qualified(name)} RECOVER PARTITIONS")
    spark.sql(f"DROP TABLE IF EXISTS {qualified(backup)}")
    return True
