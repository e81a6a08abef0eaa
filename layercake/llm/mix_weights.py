"""Operator 1: mixing sources to target weights.

Words are packed into fixed-length blocks per source; every output shard draws its
source counts from a multinomial over what the sources still owe; slot ``j`` of a
source is mapped through that source's pseudorandom permutation of block indexes
(a fresh one per pass over the source), and blocks join documents by index.

Edge cases: NULL or word-free texts have size 0 and are in no block; a NULL source
is a source of its own, ordered last; repeated rows are packed one after another
(each is a document); an empty table gives an empty mix; extra columns are ignored.
There may be as many sources as documents: they stay in tables, the driver holds sums.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.window import Window

from ..names import col as named
from .common import keep_columns, local_rows, materialize, row_key, split_words

#: Documents per packing bucket: the unit of the two-level prefix sum.
BUCKET_DOCS = 1024
#: Slots (or repeated rows) made by one plan row, so that no row expands without bound.
SLOT_RUN = 8192
#: Slots made by one task, and documents numbered by one.
SLOT_TASK, DOC_TASK = 65_536, 100_000
#: Groups of neighbouring sources to which the driver deals shards; up to as many sources, each is one.
GROUPS = 1024
#: Sources whose groups one task deals out, and sources sent to every executor instead of shuffled.
SOURCE_TASK, SENT_SOURCES = 8192, 10_000


@dataclass
class Mix:
    """``source_rows``: one row per source, ``n_sources`` of them
    (src, source, source_size, target, block, blocks, slots);
    ``spans``: one row per document (row id columns, src, size, start and, of its source,
    block_len, source_size, target);
    ``pieces``: one row per document part of every slot
    (shard, slot, src, block, doc_id, start, first_word, n_words)."""

    source_rows: DataFrame
    n_sources: int
    spans: DataFrame
    pieces: DataFrame

    @property
    def sources(self) -> Iterator[dict]:
        """The sources as dicts, of which the driver holds a partition at a time."""
        return (r.asDict() for r in self.source_rows.toLocalIterator())


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, cap: float,
            counts: Sequence[int] | None = None) -> list[float]:
    """``share`` of all sizes dealt by weight; a source stops at ``cap`` times its size and
    the excess is dealt again by weight until none is above.

    ``counts``: for how many sources each size and weight stands, one if not given.
    """
    size, weight = np.asarray(sizes, dtype=np.int64), np.asarray(weights, dtype=np.float64)
    n = np.ones_like(size) if counts is None else np.asarray(counts, dtype=np.int64)
    total = share * int((size * n).sum())
    out, open_ = np.zeros(len(size)), size > 0
    while open_.any() and total > 0:
        unit = total / math.fsum((weight * n)[open_])
        over = open_ & (unit * weight > cap * size)
        if not over.any():
            out[open_] = unit * weight[open_]
            break
        out[over] = cap * size[over]
        total -= math.fsum((out * n)[over])
        open_ &= ~over
    return out.tolist()


def shard_sizes(total: int, shards: int) -> list[int]:
    """``total`` slots cut into shards that differ by one at most."""
    edges = [total * s // shards for s in range(shards + 1)]
    return [b - a for a, b in zip(edges, edges[1:])]


def draw_shards(slots: Sequence[int], sizes: Sequence[int], seed: int | list[int]) -> np.ndarray:
    """Per source its first slot in every shard, and the end: each shard of ``sizes`` draws a
    multinomial over the slots the sources still owe, so the totals end exactly at ``slots``."""
    rng, left = np.random.default_rng(seed), np.array(slots, dtype=np.int64)
    cuts = np.zeros((len(left), len(sizes) + 1), dtype=np.int64)
    for shard, size in enumerate(sizes):
        want, got = int(size), np.zeros_like(left)
        while want > 0:
            draw = np.minimum(rng.multinomial(want, left / left.sum()), left)
            left, got, want = left - draw, got + draw, want - int(draw.sum())
        cuts[:, shard + 1] = cuts[:, shard] + got
    return cuts


def group_dealer(sizes: np.ndarray, seed: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Deals the slots that a group has in every shard (a row of ``sizes``) to its sources."""
    def deal(key: tuple, rows: pa.Table) -> pa.Table:
        group, rows = key[0].as_py(), rows.sort_by("src")
        cuts = draw_shards(rows["slots"].to_numpy(), sizes[group], [seed, group])
        ends = np.arange(len(cuts) + 1, dtype=np.int32) * cuts.shape[1]
        return pa.table({"src": rows["src"], "blocks": rows["blocks"],
                         "cuts": pa.ListArray.from_arrays(ends, cuts.ravel())})
    return deal


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed bijection of [0, n) by a four-round Feistel network with cycle walking."""
    index, n, key = (np.asarray(a).astype(np.uint64) for a in (index, n, key))
    half = np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2).astype(np.uint64)
    half = np.maximum(half, np.uint64(1))
    mask, out = (np.uint64(1) << half) - np.uint64(1), index.copy()
    todo = np.arange(len(index))
    with np.errstate(over="ignore"):
        while len(todo):
            h, m, x = half[todo], mask[todo], out[todo]
            left, right = x >> h, x & m
            for r in range(4):
                salt = key[todo] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1)
                left, right = right, left ^ (_mix64(right ^ _mix64(salt)) & m)
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


@F.pandas_udf(LongType())
def _permuted(slot: pd.Series, blocks: pd.Series, src: pd.Series, seed: pd.Series) -> pd.Series:
    turn, index = np.divmod(slot.to_numpy(), blocks.to_numpy())
    # arrays wrap around where SQL would fail, which products of many sources reach
    key = (src.to_numpy().astype(np.int64) * 1048576 + turn) * 1000003 + seed.to_numpy()
    return pd.Series(permute(index, blocks.to_numpy(), key))


# else the planner calls it a second time, in a filter for blocks that are not NULL, and every
# task holds two Python workers
_permuted = _permuted.asNondeterministic()


def sent(sources: DataFrame, n: int) -> DataFrame:
    """``n`` rows of sources for a join: few are broadcast, many are shuffled, which lets adaptive
    execution split the documents of a large source."""
    return F.broadcast(sources) if n <= SENT_SOURCES else sources.hint("merge")


def numbered(sized: DataFrame) -> tuple[DataFrame, int, int]:
    """The sources (src, source, source_size) numbered in code-point order, NULL last; how many
    they are, and how many documents.

    Every task of the sort writes a stretch of the order; the driver adds up their lengths.
    """
    at = materialize(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
        .orderBy(F.col("source").asc_nulls_last())
        .withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33).cast("int")
    lengths = {r.part: r for r in at.groupBy(part.alias("part")).agg(
        F.count("*").alias("sources"), F.sum("n").alias("docs")).collect()}
    firsts, n = [], 0
    for p in range(max(lengths, default=0) + 1):
        firsts.append(n)
        n += lengths[p].sources if p in lengths else 0
    first = F.array(*[F.lit(x).cast("long") for x in firsts])
    src = (F.element_at(first, part + 1) + F.col("at").bitwiseAND((1 << 33) - 1)).cast("int")
    return at.select(src.alias("src"), "source", "source_size"), n, sum(r.docs for r in lengths.values())


def target_of(sources: DataFrame, cycle: Sequence[float], share: float, cap: float) -> Column:
    """The target of a source by its ``src`` and ``source_size``.

    The driver gets the sizes that sources of one weight have, each once: as sizes of n words
    in all, these are at most the root of 2 n per weight.  What comes back is one size per
    weight, up to which sources stop at ``cap`` times their size, and the target of the others.
    """
    of = F.col("src") % len(cycle)
    seen = sources.groupBy(of.alias("of"), "source_size").agg(F.count("*").alias("n")).toArrow()
    at, size, n = (seen[c].to_numpy() for c in ("of", "source_size", "n"))
    goal = np.array(targets(size, np.asarray(cycle, dtype=np.float64)[at], share, cap, n))
    stops = goal == cap * size
    upto = [max((int(x) for x in size[(at == i) & stops]), default=-1) for i in range(len(cycle))]
    rest = [max(goal[(at == i) & ~stops].tolist(), default=0.0) for i in range(len(cycle))]
    return F.when(F.col("source_size") <= F.element_at(F.array(*[F.lit(x).cast("long") for x in upto]), of + 1),
                  F.lit(float(cap)) * F.col("source_size")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in rest]), of + 1))


def pack(docs: DataFrame, sources: DataFrame, n_docs: int, seed: int) -> DataFrame:
    """Each document's start in its source's sequence of words.

    A two-level prefix sum: documents are hashed into buckets of bounded size, summed
    within their bucket and offset by the buckets before it, so no source passes
    through one task.  Repeated rows are counted first and numbered as they are dealt
    out again, so that they too spread over all buckets.
    """
    buckets = max(1, math.ceil(n_docs / BUCKET_DOCS))
    alike = docs.groupBy("source", "doc_id", "key", "size").agg(F.count("*").alias("n"))
    dealt = (alike.withColumn("run", F.explode(F.expr(f"sequence(0L, n - 1, {SLOT_RUN}L)")))
             .repartition(max(1, math.ceil(n_docs / DOC_TASK)), "key", "run")
             .withColumn("copy", F.explode(F.expr(f"sequence(run, least(run + {SLOT_RUN}, n) - 1)"))))
    placed = materialize(
        dealt.join(sources, F.col("source").eqNullSafe(F.col("source_name")), "inner")
        .withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "size", "key", "copy"))
        .withColumn("bucket", F.pmod("place", F.lit(buckets)).cast("int"))
        .select("doc_id", "key", "src", "size", "place", "copy", "bucket",
                "block_len", "source_size", "target"), "mix-sized")
    in_order = Window.partitionBy("src", "bucket").orderBy("place", "doc_id", "size", "key", "copy").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    sums = placed.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    base = sums.withColumn("base", F.sum("words").over(before) - F.col("words")).drop("words")
    inner = placed.withColumn("within", F.sum("size").over(in_order) - F.col("size"))
    return inner.join(base, ["src", "bucket"]).select(
        "doc_id", "key", "src", "size", (F.col("base") + F.col("within")).alias("start"),
        "block_len", "source_size", "target")


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", cycle: tuple[float, ...] = (5, 2, 1),
                share: float = 1.5, cap: float = 2.0, block_words: int = 64,
                min_blocks: int = 64, shards: int = 64, seed: int = 20) -> Mix:
    """Mix the sources of ``docs`` to their target words.

    ``cycle`` gives the weights of the sources in code-point order, repeating.
    ``min_blocks``: a source too small for that many blocks is cut into shorter ones.
    The driver holds the sizes that sources have and ``shards`` x ``GROUPS`` slot counts.
    """
    spark = docs.sparkSession
    sized = docs.select(
        named(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), named(source_col).cast("string").alias("source"),
        F.size(split_words(named(text_col))).cast("long").alias("size"))
    sources, n_sources, n_docs = numbered(sized)
    size, target = F.col("source_size"), F.col("target")
    whole = F.rint((target - F.col("rest")) / size).cast("long")  # passes over the source
    sources = (sources.withColumn("target", target_of(sources, cycle, share, cap))
               .withColumn("block", F.expr(f"greatest(1, least({block_words}, source_size div {min_blocks}))").cast("int"))
               .withColumn("blocks", F.expr("(source_size + block - 1) div block"))
               .withColumn("rest", F.when(size > 0, target % size).otherwise(0.0))
               .withColumn("slots", F.when(size > 0, whole * F.col("blocks") + F.least(
                   "blocks", F.rint(F.col("rest") / F.col("block")).cast("long"))).otherwise(0))
               .drop("rest"))
    spans = materialize(pack(sized, sent(sources.select(
        "src", F.col("source").alias("source_name"), F.col("block").alias("block_len"), "source_size", "target"),
        n_sources), n_docs, seed), "mix-spans")

    # whole blocks of a source, cut into the parts that each document holds
    at = F.col("block") * F.col("block_len")
    first = F.greatest(F.col("start"), at)
    end = F.least(F.col("start") + F.col("size"), at + F.col("block_len"))
    parts = (spans.filter("size > 0")
             .withColumn("block", F.explode(F.sequence(
                 F.expr("start div block_len"), F.expr("(start + size - 1) div block_len"))))
             .select("src", "block", "doc_id", "start", (first - F.col("start")).alias("first_word"),
                     (end - first).alias("n_words")))

    # shards are dealt to groups of neighbouring sources, and what a group has of each to its sources
    width = max(1, math.ceil(n_sources / GROUPS))
    group = F.expr(f"src div {width}").cast("int").alias("group")
    owed = [0] * math.ceil(n_sources / width)
    for r in sources.groupBy(group).agg(F.sum("slots").alias("slots")).collect():
        owed[r["group"]] = r.slots
    cuts = draw_shards(owed, shard_sizes(sum(owed), shards), seed)
    if width == 1:
        plan = sources.select("src", "blocks").join(F.broadcast(local_rows(
            spark, list(enumerate(cuts.tolist())), src=pa.int32(), cuts=pa.list_(pa.int64()))), "src")
    else:
        plan = (sources.select(group, "src", "slots", "blocks")
                .repartition(math.ceil(n_sources / SOURCE_TASK), "group").groupBy("group")
                .applyInArrow(group_dealer(np.diff(cuts), seed), "src int, blocks bigint, cuts array<bigint>"))
    # a stated number of tasks: without one the few plan rows are merged into one before they expand
    tasks = max(1, math.ceil(sum(owed) / SLOT_TASK))
    slots = (plan.withColumn("run", F.explode(F.expr(
                 f"if(cuts[{shards}] > 0, sequence(0L, cuts[{shards}] - 1, {SLOT_RUN}L), array())")))
             .repartition(tasks, F.col("src"), F.col("run"))
             .withColumn("of", F.explode(F.expr(f"""filter(transform(sequence(0, {shards - 1}), s -> struct(
                 s AS shard, greatest(cuts[s], run) AS first, least(cuts[s + 1], run + {SLOT_RUN}) - 1 AS last)),
                 x -> x.first <= x.last)""")))
             .withColumn("slot", F.explode(F.expr("sequence(of.first, of.last)")))
             .withColumn("block", _permuted(F.col("slot"), F.col("blocks"), F.col("src"), F.lit(seed)))
             .select("of.shard", "src", "slot", "block"))
    # the planner takes rows that expand for the few they come from and would broadcast all slots
    pieces = slots.hint("merge").join(parts, ["src", "block"]).select(
        "shard", "slot", "src", "block", "doc_id", "start", "first_word", "n_words")
    return Mix(sources, n_sources, spans, pieces)


def taken_per_document(mix: Mix) -> DataFrame:
    """doc_id, key, src, size, source_size, target, taken: the mix summed up by document."""
    taken = mix.pieces.groupBy(F.col("src").alias("in_src"), F.col("start").alias("at")).agg(
        F.sum("n_words").alias("words"))
    has_words: Column = F.col("size") > 0  # (src, start) names a document that has words
    return (mix.spans.join(taken, has_words & (F.col("src") == F.col("in_src"))
                           & (F.col("start") == F.col("at")), "left")
            .select("doc_id", "key", "src", "size", "source_size", "target",
                    F.coalesce("words", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The documents with what the mix takes of them: size, source_size, target, taken.

    Rows of equal id, text and source take the mean of their group, as they are alike.
    """
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    digest = taken_per_document(mix).groupBy("key", "src").agg(
        F.max("size").alias("m_size"), F.max("source_size").alias("m_source_size"),
        F.max("target").alias("m_target"), F.avg("taken").cast("long").alias("m_taken"))
    names = mix.source_rows.select(F.col("src").alias("m_src"), F.col("source").alias("m_source"))
    taken = materialize(digest.join(sent(names, mix.n_sources), F.col("src") == F.col("m_src"))
                        .withColumnRenamed("key", "m_key").drop("src", "m_src"), "mix-digest")
    rows = docs.select(keep_columns(docs), row_key(id_col, text_col).alias("key"),
                       named(source_col).cast("string").alias("source"))
    new = [c for c in ("size", "source_size", "target", "taken")
           if c not in {n.lower() for n in docs.columns}]
    return rows.join(taken, (F.col("key") == F.col("m_key")) & F.col("source").eqNullSafe(F.col("m_source"))).select(
        "row.*", *[F.col(f"m_{c}").alias(c) for c in new])
