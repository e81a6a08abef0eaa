"""Versioned datasets: new folder, then one commit (K5, K6, K8 with snapshot isolation).

Layout below ``root``: ``data/snapshot_run={run}/`` holds what one write made and never changes;
``_log/{version}.json`` is one small file per commit that names the folders of that version.  The
highest version is the current one.  A write goes to a fresh folder, is audited, and becomes
visible through the commit alone, so

- a DataFrame read before a commit keeps its folders: readers see the old rows to their end;
- a write may read the dataset it replaces;
- a failed audit or a lost driver leaves the version that was current before.

Commits are optimistic: version n + 1 is created only if nobody else has created it (see
:mod:`layercake.commits`).  A blind overwrite that loses takes the next number; a merge that loses
is computed again on the version that won; a write with ``expect`` raises :class:`CommitConflict`.
Folders are kept until :func:`drop_versions`.

Spark stores an empty text in a partition column as NULL; leave such columns out of
``partition_by``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import delete, listing, read_text, write_once
from ..functions.runinfo import new_run
from ..names import col, quote, resolve
from ..operators.projection import conform
from ..operators.quality import EmptyOutputError, NoInputError, counted
from .tables import qualified, rows_to_insert

#: Name of the data folders; reading them gives a column of that name, which is dropped.
RUN = "snapshot_run="


class CommitConflict(RuntimeError):
    """Another writer has committed since the version that a write is based on."""


@dataclass(frozen=True)
class Snapshot:
    """One version: the folders whose rows it holds, and how to read them."""

    version: int
    folders: tuple[str, ...]
    schema: T.StructType
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ()
    rows: int = 0                              # of all folders
    indexed: dict[str, int] = field(default_factory=dict)   # folder -> its keys in the key index

    def text(self, operation: str) -> str:
        return json.dumps({
            "version": self.version, "operation": operation, "folders": self.folders,
            "schema": self.schema.jsonValue(), "format": self.fmt, "rows": self.rows,
            "partition_by": self.partition_by, "indexed": self.indexed,
            "written_at": datetime.now(timezone.utc).isoformat()})


def _log_path(root: str, version: int) -> str:
    return f"{root}/_log/{version:012d}.json"


def _data(root: str, folder: str) -> str:
    return f"{root}/data/{RUN}{folder}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, oldest first (a listing of the log; no job)."""
    return [int(n[:12]) for n, _ in listing(spark, f"{root}/_log")]


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot | None:
    """A version of the dataset, the current one by default; None before the first commit."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if not version:
        return None
    e = json.loads(read_text(spark, _log_path(root, version)))
    return Snapshot(e["version"], tuple(e["folders"]), T.StructType.fromJson(e["schema"]), e["format"],
                    tuple(e["partition_by"]), e["rows"], e["indexed"])


def _load(spark: SparkSession, root: str, snap: Snapshot, folders: Sequence[str] | None = None) -> DataFrame:
    reader = spark.read.format(snap.fmt).schema(snap.schema).option("basePath", f"{root}/data")
    if snap.fmt == "csv":
        reader = reader.option("header", "true")
    paths = [_data(root, f) for f in (snap.folders if folders is None else folders)]
    return reader.load(paths).select(*map(col, snap.schema.fieldNames()))


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of one version; the DataFrame keeps to it whatever is committed later."""
    snap = snapshot(spark, root, version)
    if snap is None:
        raise NoInputError(f"nothing is committed under {root}")
    return _load(spark, root, snap)


def _write(df: DataFrame, root: str, fmt: str, partition_by: Sequence[str],
           max_records_per_file: int | None = None) -> tuple[str, int]:
    """A fresh data folder and the rows written, counted by the write."""
    folder = new_run().run_id
    shaped = df.hint("rebalance", *map(col, partition_by)) if partition_by else df
    observed, obs = counted(shaped, "snapshot_rows")
    writer = observed.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.save(_data(root, folder))
    return folder, int(obs.get.get("rows", 0) or 0)


def write_snapshot(df: DataFrame, root: str, *, partition_by: Sequence[str] = (), fmt: str = "parquet",
                   least_rows: int = 0, expect: int | None = None,
                   max_records_per_file: int | None = None) -> int:
    """K5: replace all rows by ``df``, which may be read from ``root`` itself; returns the version.

    With fewer than ``least_rows`` rows nothing is committed (EmptyOutputError).  ``expect``: the
    version that ``df`` was made from (0: none yet); raises :class:`CommitConflict` when another
    one is current at the commit.  Without it the last writer wins."""
    spark = df.sparkSession
    folder, rows = _write(df, root, fmt, partition_by, max_records_per_file)
    if rows < least_rows:
        delete(spark, _data(root, folder))
        raise EmptyOutputError(f"{rows} rows for {root}, at least {least_rows} expected; the old version stays")
    made = Snapshot(0, (folder,), T.StructType([replace_null(f) for f in df.schema.fields]), fmt, tuple(partition_by), rows)
    while True:
        version = (max(versions(spark, root), default=0) if expect is None else expect) + 1
        made = replace(made, version=version)
        if write_once(spark, _log_path(root, version), made.text("overwrite")):
            return version
        if expect is not None:
            delete(spark, _data(root, folder))
            raise CommitConflict(f"{root}: version {version} was committed by another writer")


def replace_null(f: T.StructField) -> T.StructField:
    """The field as it can be read back: files make every column nullable."""
    return T.StructField(f.name, f.dataType, True)


def merge_snapshot(source: DataFrame, root: str, keys: Sequence[str], *, retries: int = 10,
                   index: str | None = None, buckets: int | None = None, bits: int = 1 << 26) -> int:
    """Append the source rows whose key has no match; returns how many.

    A NULL key never matches and duplicate source keys are all inserted, as in
    :func:`~layercake.sinks.tables.merge_insert_only`.  When another writer commits first, the
    rows are computed again on its version, so two merges insert each key once.

    ``index``: the name of a bucketed catalog table that keeps the keys of the dataset (made on
    first use, see :func:`_index_table`).  The join then reads its buckets in place: only source
    rows are shuffled, and of them only those whose key a bitmap of ``bits`` bits does not rule out.
    """
    spark = source.sparkSession
    for _ in range(retries):
        base = snapshot(spark, root)
        if base is None:
            raise NoInputError(f"nothing is committed under {root}; write_snapshot makes the first version")
        if index:
            _index_table(spark, index, root, base, keys, buckets)
            base = _indexed(spark, index, root, base, keys, bits)
            fresh = rows_by_index(source, root, base, keys, index, bits)
        else:
            fresh = rows_to_insert(source, _load(spark, root, base), keys)
        folder, rows = _write(conform(fresh, base.schema, fill_missing=True), root, base.fmt, base.partition_by)
        made = replace(base, version=base.version + 1, rows=base.rows + rows, folders=(*base.folders, folder))
        if index and rows:
            made = _indexed(spark, index, root, made, keys, bits)
        if not rows and made.indexed == base.indexed:
            delete(spark, _data(root, folder))
            return 0
        if write_once(spark, _log_path(root, made.version), made.text("merge")):
            return rows
        delete(spark, _data(root, folder))  # its keys in the index are of no committed folder
    raise CommitConflict(f"{root}: {retries} merges in a row lost to other writers")


# -- the key index
def _index_table(spark: SparkSession, index: str, root: str, base: Snapshot, keys: Sequence[str],
                 buckets: int | None) -> None:
    """The key index: a table of the keys alone, bucketed by them, with a partition per folder.

    ``buckets`` (the session's shuffle partitions by default) is fixed when the table is made."""
    if spark.catalog.tableExists(index):
        return
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [quote(resolve_field(base.schema, k).name) for k in keys]
    types = [resolve_field(base.schema, k).dataType.simpleString() for k in keys]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(index)} ({', '.join(f'{a} {t}' for a, t in zip(names, types))}, "
              f"folder STRING) USING parquet PARTITIONED BY (folder) "
              f"CLUSTERED BY ({', '.join(names)}) INTO {n} BUCKETS LOCATION '{root}/keys'")


def resolve_field(schema: T.StructType, name: str) -> T.StructField:
    return next(f for f in schema.fields if f.name.lower() == name.lower())


def _buckets(spark: SparkSession, index: str) -> int:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(index)}").collect():
        if row["col_name"] == "Num Buckets":
            return int(row["data_type"])
    raise ValueError(f"{index} is not bucketed")


def _known(df: DataFrame, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & col(resolve(df, k) or k).isNotNull()
    return out


def _bit(df: DataFrame, keys: Sequence[str], bits: int) -> Column:
    """A key's place (from 1) among ``bits`` bits."""
    return F.pmod(F.xxhash64(*[col(resolve(df, k) or k) for k in keys]), F.lit(bits)) + 1


def _indexed(spark: SparkSession, index: str, root: str, snap: Snapshot, keys: Sequence[str], bits: int) -> Snapshot:
    """``snap`` with every folder's keys in the index.  A folder's keys are written before the
    commit that names it; a folder that is lost leaves a partition that nobody reads.  A folder
    never changes, so keys or bits that a lost or a second writer left there are its own too."""
    todo = [f for f in snap.folders if f not in snap.indexed]
    if not todo:
        return snap
    n, done = _buckets(spark, index), dict(snap.indexed)
    for folder in todo:
        rows = _load(spark, root, snap, [folder])
        held = rows.where(_known(rows, keys)).select(*[col(resolve_field(snap.schema, k).name) for k in keys])
        observed, obs = counted(held.distinct().repartition(n, *map(col, held.columns)), "index_keys")
        observed.withColumn("folder", F.lit(folder)).write.insertInto(index)
        place = held.select(_bit(held, keys, bits).alias("at"))
        place.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).write.parquet(
            f"{root}/bits/{bits}/folder={folder}/attempt={uuid.uuid4().hex}")
        done[folder] = int(obs.get.get("rows", 0) or 0)
    return replace(snap, indexed=done)


def rows_by_index(source: DataFrame, root: str, snap: Snapshot, keys: Sequence[str], index: str,
                  bits: int = 1 << 26) -> DataFrame:
    """J4 against the key index: the source rows whose key is not in ``snap``.

    Rows with a NULL key and rows whose bit is not set are new for certain and skip the join.  The
    bitmap is at most ``bits`` bits, so it may be broadcast; it is left out once it holds more
    than one key per four bits, where it would rule out little."""
    spark = source.sparkSession
    target = spark.table(index).where(F.col("folder").isin(list(snap.folders))).drop("folder")
    known = source.where(_known(source, keys))
    new = [source.where(~_known(source, keys))]
    if sum(snap.indexed.values()) * 4 <= bits:
        held = spark.read.schema("bucket long, bits binary").option("basePath", f"{root}/bits/{bits}").parquet(
            *[f"{root}/bits/{bits}/folder={f}" for f in snap.folders]).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        at = _bit(known, keys, bits)
        marked = known.select(F.struct(*map(col, known.columns)).alias("row"), at.alias("at")).join(
            F.broadcast(held.withColumnRenamed("bits", "held")), F.bitmap_bucket_number("at") == F.col("bucket"), "left")
        place = F.bitmap_bit_position("at")
        byte = F.conv(F.hex(F.substring("held", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        maybe = F.coalesce(F.bit_get(byte, (place % 8).cast("int")) == 1, F.lit(False))
        new.append(marked.where(~maybe).select("row.*"))
        known = marked.where(maybe).select("row.*")
    new.append(rows_to_insert(known, target, keys))
    out = new[0]
    for part in new[1:]:
        out = out.unionByName(part)
    return out


# -- exports and housekeeping
def export_generation(df: DataFrame, key: str, root: str, *, fmt: str = "csv", keep_key: bool = False,
                      max_records_per_file: int | None = None) -> int:
    """K8: one dataset per ``key`` value as a new generation of the whole export; returns its
    version.  Readers (:func:`read_snapshot`) move from the old generation to the new one at the
    commit; an empty export raises and the old one stays.  ``keep_key`` writes the key into the
    files too, below ``by_key=value/``."""
    folder = f"by_{key}" if keep_key else key
    if keep_key:
        df = df.withColumn(folder, col(key))
    return write_snapshot(df, root, partition_by=[folder], fmt=fmt, least_rows=1,
                          max_records_per_file=max_records_per_file)


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Forget all but the newest ``keep`` versions and delete the folders only they named; returns
    the folders deleted.  Folders newer than the current version's are left: a write may be using them."""
    every = versions(spark, root)
    kept = [snapshot(spark, root, v) for v in every[-keep:]]
    needed = {f for s in kept for f in s.folders}
    newest = max(needed, default="")
    for v in every[:-keep]:
        delete(spark, _log_path(root, v))
    there = [n.removeprefix(RUN) for n, _ in listing(spark, f"{root}/data")]
    gone = [n for n in there if n not in needed and n < newest]
    for n in gone:
        delete(spark, f"{root}/data/{RUN}{n}")
    return len(gone)
