"""Operator 9: benchmark decontamination by a prefix-filtered set join, native functions only.

Every benchmark item is cut into windows of ``window`` words (a shorter item is one window).
Tokens are word shingles, ordered by how rare they are in the documents.  Containment asks
for every token of a window, so the one rarest token is the necessary prefix: only documents
that hold it are joined.  The token's place in the window fixes where the window must start
(positional bound) and end (length bound), and that stretch is compared word by word.

Edge cases: NULL texts and texts without words have no words and no hits; items without
words have no window; repeated rows get equal results; windows that several items share
count for each; empty tables work; extra columns are ignored or carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..names import col as named
from .common import ascii_lower, keep_columns, materialize, row_key, split_words

#: Fixed value: what lies between words here, as a Java regex.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of the window table up to which it is broadcast; beyond, the joins shuffle.
BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), GAP)


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows: (window_id, words) and the items that hold them, as two tables."""
    w = items.select(F.col("item_id"), words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return w.withColumn("at", F.explode(starts)).select(
        "item_id", F.slice("words", F.col("at"), F.lit(window)).alias("words")).distinct().withColumn(
        "window_id", F.xxhash64("words"))


def shingles(words: Column, k: int) -> Column:
    """Structs of ``k`` neighbouring words; with fewer words, the whole text is one."""
    n = F.size(words)
    parts = [F.slice(words, i + 1, F.greatest(n - k + 1, F.lit(0))).alias(f"w{i}") for i in range(k)]
    return F.arrays_zip(*parts)


def occurrences(docs: DataFrame, tokens: DataFrame, small: bool, k: int) -> DataFrame:
    """Places in the documents of the given tokens: key, words, pos and the token's columns."""
    side = F.broadcast(tokens) if small else tokens
    zipped = docs.select("key", "words", F.posexplode(shingles(F.col("words"), k)).alias("pos", "s"))
    return zipped.withColumn("token", F.xxhash64(*[F.col(f"s.w{i}") for i in range(k)])).drop("s").join(
        side, "token")


def find(docs: DataFrame, items: DataFrame, *, window: int = 10, k: int = 2) -> DataFrame:
    """(key, n_hit, n_items, items_sha256) of the documents (key, words) that hold a window."""
    found = materialize(windows_of(items, window), "leak-windows")
    held = found.select("window_id", "item_id")
    wins = found.select("window_id", "words").distinct()
    hits = None
    for size in range(1, k + 1):  # windows of fewer than k words are their own single token
        some = wins.filter(F.size("words") == size if size < k else F.size("words") >= size)
        tokens = some.select("window_id", F.col("words").alias("w"), F.posexplode(
            shingles(F.col("words"), size)).alias("offset", "s")).select(
            "window_id", "w", "offset", F.xxhash64(*[F.col(f"s.w{i}") for i in range(size)]).alias("token"))
        tokens = materialize(tokens, "leak-tokens")
        count = tokens.count()
        if not count:
            continue
        small = count <= BROADCAST_ROWS
        rarity = materialize(occurrences(docs, tokens.select("token").distinct(), small, size)
                             .groupBy("token").agg(F.count("*").alias("n")), "leak-rarity")
        rarest = Window.partitionBy("window_id").orderBy(
            F.coalesce("n", F.lit(0)), "token", "offset")  # the tokens of one window
        prefix = materialize(tokens.join(rarity, "token", "left").withColumn(
            "rank", F.row_number().over(rarest)).filter("rank = 1 AND n IS NOT NULL")
            .select("window_id", "w", "offset", "token"), "leak-prefix")
        near = occurrences(docs, prefix, small, size)
        start, length = F.col("pos") - F.col("offset"), F.size("w")
        exact = near.filter((start >= 0) & (start + length <= F.size("words"))).filter(
            F.slice("words", start + 1, length) == F.col("w")).select(
            "key", "window_id", start.alias("start"), length.alias("len"))
        hits = exact if hits is None else hits.union(exact)
    if hits is None:
        return docs.select("key", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                           F.lit("").alias("items_sha256")).filter("false")
    hits = materialize(hits, "leak-hits")
    # union of the stretches: each adds what lies beyond the furthest end so far
    per_place = hits.groupBy("key", "start").agg(F.max("len").alias("len"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.col("start") + F.col("len")).over(before), F.lit(0))
    covered = per_place.withColumn("n", F.greatest(
        F.lit(0), F.col("start") + F.col("len") - F.greatest("start", reach))).groupBy("key").agg(
        F.sum("n").cast("long").alias("n_hit"))
    ids = hits.select("key", "window_id").distinct().join(held, "window_id").select("key", "item_id").distinct()
    named_items = ids.groupBy("key").agg(
        F.count("*").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(F.col("item_id").cast("string")))), 256
               ).alias("items_sha256"))
    return covered.join(named_items, "key")


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  carry: list[str] | None = None, **options) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default) with n_words, n_hit, n_items,
    items_sha256 (of the empty text without items) and contaminated."""
    bench = items.select(named(item_id_col).alias("item_id"), named(item_text_col).alias("text"))
    keyed = docs.select(keep_columns(docs.select(*map(named, carry or docs.columns))),
                        row_key(id_col, text_col).alias("key"), words_of(named(text_col)).alias("words"))
    found = materialize(find(keyed.select("key", "words"), bench, **options), "leak-found")
    none = F.sha2(F.lit(""), 256)
    return keyed.select("row", "key", F.size("words").cast("long").alias("n_words")).join(
        found, "key", "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of any item, with their own columns."""
    return decontaminate(docs, items, **options).filter(~F.col("contaminated")).select("row.*")
