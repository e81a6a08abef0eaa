"""Compare registered queries with their DuckDB oracles (used by the test
suite and ``scripts/check_oracles.py``)."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@dataclass
class Outcome:
    """Result of one Spark-vs-DuckDB comparison."""

    name: str
    ok: bool
    rows: int
    seconds: float
    detail: str = ""


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def _sorted(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=repr)


def duck(sf_dir: str):
    """A DuckDB connection with every test table of ``sf_dir`` as a view."""
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark type -> DuckDB result types that hold the same values
SAME_TYPE = {"int": {"INTEGER"}, "bigint": {"BIGINT"}, "string": {"VARCHAR"},
             "double": {"DOUBLE"}, "boolean": {"BOOLEAN"}, "date": {"DATE"},
             "timestamp_ntz": {"TIMESTAMP"}, "timestamp": {"TIMESTAMP WITH TIME ZONE", "TIMESTAMP"},
             "float": {"FLOAT"}}


def compare(spark: SparkSession, sf_dir: str, name: str, query, sql: str | None, con
            ) -> Outcome:
    """Column names (any order), column types, row count and sorted values must agree."""
    t0 = time.time()
    df = query(spark, sf_dir)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    secs = time.time() - t0
    if sql is None:
        return Outcome(name, True, len(got), secs, "no oracle")
    res = con.sql(sql)
    ocols, want = res.columns, res.fetchall()
    if sorted(cols) != sorted(ocols):
        return Outcome(name, False, len(got), secs, f"columns {cols} vs {ocols}")
    otypes = dict(zip(ocols, (str(t) for t in res.types)))
    for f in df.schema.fields:
        spark_type = f.dataType.simpleString()
        if otypes[f.name] not in SAME_TYPE.get(spark_type, {spark_type.upper()}):
            return Outcome(name, False, len(got), secs,
                           f"type of {f.name}: {spark_type} vs {otypes[f.name]}")
    order = [ocols.index(c) for c in cols]
    want = [tuple(r[i] for i in order) for r in want]
    if len(got) != len(want):
        return Outcome(name, False, len(got), secs, f"rows {len(got)} vs {len(want)}")
    a, b = _sorted(got), _sorted(want)
    if a != b:
        i = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        return Outcome(name, False, len(got), secs, f"first difference: {a[i]} vs {b[i]}")
    return Outcome(name, True, len(got), secs)
