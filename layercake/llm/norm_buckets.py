r"""Operator 13: ranked lexical search over impact vectors in buckets of vector length.

Every document is a sparse vector: the impact of a term is its integer contribution to a score,
``w * ((10**9 * tf) div (1000 * tf + 20 * m))``.  An item is the 0/1 vector of its terms, so a
score is an inner product.  Only terms that some item holds are kept; no score needs others.

Documents are range-partitioned by vector length, longest first, and each partition is cut into
buckets of neighbouring lengths.  For an item whose 50th best score so far is ``t``:

- Cauchy-Schwarz: a bucket whose longest vector gives ``length * sqrt(terms) < t`` ends the
  search, since all later buckets hold shorter vectors;
- coordinate bounds: the item's rarest terms are its focus coordinates; a document's partial sum
  over them plus ``sqrt(other terms) * rest of its length`` bounds its score;
- survivors are rescored over all terms in 64-bit integers.

The longest vectors are searched first, and the scores they reach prune the rest.  Bounds are
doubles with a relative slack of 1e-9, and only a bound strictly below ``t`` prunes, so ties are
never lost.  Items are taken in groups of at most ``max_terms`` terms, so what a task is sent is
bounded whatever the number of items.

Edge cases: NULL and empty texts have no term; such documents are never returned and such items
have no rows.  Repeated documents are separate results; repeated item rows are one item, and an
item id with two texts is ranked once per text.  Ids may have any sortable type, NULL last.
Empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..names import col as named
from .common import materialize
from .streams import task_count

#: Bytes between terms, and the upper-case letters.
_GAP = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(0x20 if b in _GAP else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Documents of one bucket, and the item's rarest terms that bound before rescoring.
BUCKET, FOCUS = 4096, 12


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased."""
    return (text or "").encode().translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    """A term's integer weight."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _vectors(vocab) -> object:
    """Rows (id, no_id, text) -> (id, no_id, n, terms, tf): term numbers of the vocabulary with their counts."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = vocab.value
        for pdf in batches:
            n, terms, tfs = [], [], []
            for text in pdf["text"]:
                words = terms_of(text)
                held = Counter(x for x in map(number.get, words) if x is not None)
                n.append(len(words))
                terms.append(np.fromiter(held.keys(), dtype=np.int32, count=len(held)))
                tfs.append(np.fromiter(held.values(), dtype=np.int64, count=len(held)))
            yield pd.DataFrame({"id": pdf["id"], "no_id": pdf["no_id"], "n": n, "terms": terms, "tf": tfs})
    return cut


def _impacts(sent) -> object:
    """Rows (id, no_id, n, terms, tf) -> (id, no_id, terms, impact, length), without empty vectors."""
    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, n_docs, total = sent.value
        for pdf in batches:
            pdf = pdf[pdf["terms"].str.len() > 0]
            if not len(pdf):
                continue
            sizes = pdf["terms"].str.len().to_numpy(dtype=np.int64)
            terms = np.concatenate(pdf["terms"].to_numpy())
            tf = np.concatenate(pdf["tf"].to_numpy()).astype(np.int64)
            m = 100 - 50 + (50 * pdf["n"].to_numpy(dtype=np.int64) * n_docs) // total
            impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes)))
            ends = np.cumsum(sizes)
            length = np.sqrt(np.add.reduceat(impact.astype(np.float64) ** 2, ends - sizes))
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "no_id": pdf["no_id"].to_numpy(), "terms": np.split(terms, ends[:-1]),
                                "impact": np.split(impact, ends[:-1]), "length": length})
    return weigh


def _search(sent, k: int) -> object:
    """Sorted rows (id, no_id, terms, impact, length) -> (item, score, id, no_id): per task and item the ``k``
    best of those that reach the item's threshold."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, least = sent.value
        least = dict(least)
        best: dict[int, pd.DataFrame] = {}
        for pdf in _buckets(batches):
            sizes = pdf["terms"].str.len().to_numpy(dtype=np.int64)
            terms = np.concatenate(pdf["terms"].to_numpy())
            impact = np.concatenate(pdf["impact"].to_numpy()).astype(np.int64)
            rows = np.repeat(np.arange(len(pdf)), sizes)
            by_term = np.argsort(terms, kind="stable")
            terms, impact, rows = terms[by_term], impact[by_term], rows[by_term]
            length = pdf["length"].to_numpy()
            for item, own in enumerate(items):
                floor = least.get(item, 1)
                if length[0] * math.sqrt(len(own)) * (1 + 1e-9) < floor:
                    continue  # no vector of the bucket is long enough
                lo, hi = np.searchsorted(terms, own, "left"), np.searchsorted(terms, own, "right")
                focus = [slice(a, b) for a, b in zip(lo[:FOCUS], hi[:FOCUS]) if a < b]
                rest = [slice(a, b) for a, b in zip(lo[FOCUS:], hi[FOCUS:]) if a < b]
                score = np.zeros(len(pdf), dtype=np.int64)
                used = np.zeros(len(pdf))
                for s in focus:  # a term is once in a document: no row is twice in a slice
                    score[rows[s]] += impact[s]
                    used[rows[s]] += impact[s].astype(np.float64) ** 2
                left = np.sqrt(np.maximum(length * length * (1 + 1e-9) - used, 0) * len(rest))
                alive = score + left * (1 + 1e-9) + 1 >= floor
                if not alive.any():
                    continue
                for s in rest:
                    hit = alive[rows[s]]
                    score[rows[s][hit]] += impact[s][hit]
                found = np.flatnonzero(alive & (score >= floor))
                if not len(found):
                    continue
                new = pdf[["id", "no_id"]].iloc[found].assign(score=score[found])
                both = pd.concat([best[item], new]) if item in best else new
                best[item] = both.sort_values(["score", "no_id", "id"], ascending=[False, True, True]).head(k)
                if len(best[item]) == k:
                    least[item] = max(floor, int(best[item]["score"].iloc[-1]))
        for item, rows_ in best.items():
            yield rows_.assign(item=np.int32(item))[["item", "score", "id", "no_id"]]
    return search


def _buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for a in range(0, len(pdf), BUCKET):
            yield pdf.iloc[a:a + BUCKET]


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item, ranked; Spark cuts each task's rows before the shuffle."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("no_id"), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_group(docs: DataFrame, items: list, k: int) -> DataFrame:
    """(item, score, id, no_id, rank) for a bounded list of term lists."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    vocab = {t: i for i, t in enumerate(sorted({t for own in items for t in own}))}
    ids = [docs.schema["id"], T.StructField("no_id", T.BooleanType())]
    sent = sc.broadcast(vocab)
    vectors = materialize(docs.mapInPandas(_vectors(sent), T.StructType([
        *ids, T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("tf", T.ArrayType(T.LongType()))])), "search-vectors")
    sent.destroy()
    n_docs, total = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # one row per term
    if not df:
        return vectors.select(F.lit(0).alias("item"), F.lit(0).cast("long").alias("score"), "id", "no_id",
                              F.lit(0).alias("rank")).filter("false")
    weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(vocab))], dtype=np.int64)
    sent = sc.broadcast((weights, n_docs, total))
    lengths = materialize(vectors.mapInPandas(_impacts(sent), T.StructType([
        *ids, T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("impact", T.ArrayType(T.LongType())), T.StructField("length", T.DoubleType())])),
        "search-lengths")
    sent.destroy()
    # an item's terms that occur, rarest (heaviest) first: the first ones are its focus coordinates
    asked = [np.array(sorted((vocab[t] for t in own if vocab[t] in df), key=lambda i: (-weights[i], i)), dtype=np.int32)
             for own in items]
    head = lengths.agg(F.percentile_approx("length", 0.95, 1000)).first()[0]
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("score", T.LongType()),
                           *ids])

    def ranked(part: DataFrame, least: dict, name: str) -> DataFrame:
        # equal lengths (groups of copies) are split by the id
        order = [F.col("length").desc(), F.xxhash64(F.col("id").cast("string"))]
        bounds = sc.broadcast((asked, least))
        return materialize(part.repartitionByRange(task_count(spark), *order).sortWithinPartitions(
            F.col("length").desc()).mapInPandas(_search(bounds, k), schema), name)

    longest = ranked(lengths.filter(F.col("length") >= head), {}, "search-longest")
    least = {r.item: r.score for r in _top(longest, k).filter(F.col("rank") == k).collect()}  # one row per item
    others = ranked(lengths.filter(F.col("length") < head), least, "search-others")
    return _top(longest.union(others), k)


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", k: int = 50,
           max_terms: int = 500_000) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    # pandas has no NULL among whole numbers: such ids travel as 0 with a mark
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    source = docs.select((F.coalesce(named(id_col), F.lit(0)).cast(docs.schema[id_col].dataType) if whole else named(id_col)).alias("id"),
                         named(id_col).isNull().alias("no_id"), named(text_col).alias("text"))
    doc_id = F.when(~F.col("no_id"), F.col("id")).alias("doc_id")
    asked = materialize(items.select(named(item_id_col).alias("item_id"), named(item_text_col).alias("text")).distinct()
                        .withColumn("chars", F.coalesce(F.length("text"), F.lit(0))), "search-items")
    # a text of c characters has at most c terms; groups by hash hold about max_terms characters
    groups = 1 + (asked.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0] // max_terms)
    out = None
    for g in range(groups):
        own = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).select("item_id", "text")
        rows = [(r, sorted(set(terms_of(r.text)))) for r in own.toLocalIterator()]
        rows = [(r, t) for r, t in rows if t]
        if not rows:
            continue
        names = docs.sparkSession.createDataFrame(
            [(i, r.item_id) for i, (r, _) in enumerate(rows)],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema[item_id_col].dataType)]))
        got = _search_group(source, [t for _, t in rows], k).join(F.broadcast(names), "item").select(
            "item_id", "rank", doc_id, "score")
        out = got if out is None else out.unionByName(got)
    if out is None:
        return docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", items.schema[item_id_col].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())]))
    return out
