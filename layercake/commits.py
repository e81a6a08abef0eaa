"""Small commit files on the session's file system.

A commit file appears whole or not at all: its text goes to a hidden name first and is then
renamed, without overwriting.  Where the file system renames atomically (HDFS, local disks) of
two writers of one name exactly one succeeds, which is what the version check of
:mod:`layercake.sinks.snapshots` rests on.  An object store without such a rename needs a store-
side condition (or one writer at a time).

Only names and texts of a few hundred bytes pass through the driver; data is read and written by
Spark jobs.
"""

from __future__ import annotations

import fnmatch
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class _Java:
    """The Hadoop classes in use, looked up once (every lookup is a call to the JVM)."""

    def __init__(self, spark: SparkSession):
        hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsc.hadoopConfiguration()
        self.path, self.context, rename = hadoop.Path, hadoop.FileContext, hadoop.Options.Rename
        self.no_overwrite = spark._sc._gateway.new_array(rename, 1)
        self.no_overwrite[0] = rename.NONE
        self.contexts: dict = {}


_java: dict[int, _Java] = {}


def _classes(spark: SparkSession) -> _Java:
    key = id(spark._jvm)
    if key not in _java:
        _java.clear()  # a stopped session's classes go
        _java[key] = _Java(spark)
    return _java[key]


def _fs(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path`` and the path as its object."""
    java = _classes(spark)
    where = java.path(path)
    return where.getFileSystem(java.conf), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def listing(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of what lies directly in ``folder``, hidden names left out; [] without it."""
    fs, where = _fs(spark, folder)
    if not fs.exists(where):
        return []
    found = ((s.getPath().getName(), s.getLen()) for s in fs.listStatus(where))
    return sorted((n, size) for n, size in found if n[0] not in "._")


def empty_files(spark: SparkSession, folder: str, glob: str | None = None) -> list[tuple[int, str]]:
    """(modification time in ms, path) of the files of 0 bytes anywhere below ``folder``, which
    Spark's file scans leave out; one call to the file system per file, on the driver."""
    fs, where = _fs(spark, folder)
    if not fs.exists(where):
        return []
    found, files = [], fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().getName()
        if not f.getLen() and name[0] not in "._" and fnmatch.fnmatch(name, glob or "*"):
            found.append((f.getModificationTime(), f.getPath().toString()))
    return found


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` in one step; False (and no change) if it is there already."""
    fs, where = _fs(spark, path)
    java = _classes(spark)
    hidden = java.path(where.getParent(), f".commit-{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)  # makes the folder as well
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    root = fs.getUri().toString()
    if root not in java.contexts:
        java.contexts[root] = java.context.getFileContext(fs.getUri(), java.conf)
    try:
        java.contexts[root].rename(fs.makeQualified(hidden), fs.makeQualified(where), java.no_overwrite)
        return True
    except Py4JJavaError as e:
        fs.delete(hidden, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise


def move_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that must be free."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise FileExistsError(f"{source} cannot be published as {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)
