"""Helpers shared by the operators: ASCII words, row keys, written tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..names import col as named
from ..session import scratch_path

#: The ASCII white space of the word definition, as a Java regex class body.
SPACE = r"\x20\x09-\x0D"
#: Words of 64 bits that the filter of ``sifted`` has at most.
SIEVE = 1 << 19
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage and survives lost executors; the reread table has a known
    size, so the planner's own broadcast threshold applies to it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_rows(spark: SparkSession, rows: list[tuple], **kinds: pa.DataType) -> DataFrame:
    """Rows of the driver as a frame with the named columns.

    They go as Arrow, which the JVM reads: a list of tuples would be unpickled by Python workers,
    which stay on every executor, idle, beside those of the operators.
    """
    values = list(zip(*rows)) or [()] * len(kinds)
    return spark.createDataFrame(pa.table({n: pa.array(v, k) for (n, k), v in zip(kinds.items(), values)}))


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` (a written table) marked for broadcast if it has at most ``rows`` rows; beyond
    that the planner chooses and may shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def sifted(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``column`` is among ``keys`` (a written table of that one column)
    and a few others, without a shuffle of ``df``.

    A Bloom filter of 16 bits a key, two of them set in one word of 64, is broadcast; beyond
    ``SIEVE`` words it only lets more other rows pass.  An exact join decides afterwards.
    """
    words = min(SIEVE, 1 << max(4, (keys.count() // 4).bit_length()))

    def spot(of: str) -> tuple[Column, Column]:
        h = F.xxhash64(F.col(of), F.lit(words))
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, k).bitwiseAND(63).cast("int"))
                for k in (58, 52)]
        return F.pmod(h, F.lit(words)), bits[0].bitwiseOR(bits[1])

    at, mask = spot(keys.columns[0])
    sieve = keys.select(at.alias("sieve_at"), mask.alias("mask")).groupBy("sieve_at").agg(
        F.bit_or("mask").alias("sieve_bits"))
    at, mask = spot(column)
    return df.join(F.broadcast(sieve), (at == F.col("sieve_at")) & (
        mask.bitwiseAND(F.col("sieve_bits")) == mask), "left_semi")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, gap: str = f"[{SPACE}]+") -> Column:
    """The words between gaps as an array; NULL and gap-only texts give an empty array."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), f"^{gap}", ""), gap)
    # a closing gap leaves one empty last part; an empty text is one empty part
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)
                  ).otherwise(parts)


def row_key(id_col: str, text_col: str) -> Column:
    """A key of a row's content: equal for repeated rows, which get equal results anyway."""
    return F.xxhash64(named(id_col).cast("string"), named(text_col))


def id_crc(id_col: str) -> Column:
    """crc32 of the id as text (a NULL id counts as the empty text)."""
    return F.crc32(F.coalesce(named(id_col).cast("string"), F.lit("")).cast("binary"))


def keep_columns(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct named ``row``: names added later cannot clash."""
    return F.struct(*[named(c) for c in df.columns]).alias("row")
