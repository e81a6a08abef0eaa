"""Operator 3: quality classifier by naive Bayes support vectors.

Features are indicators of n-grams (one to three words) of the lower-cased words and of their
shapes (a word equal to the one before it has a shape of its own), and of the share of the text
that a shape makes up.  They are scaled by the class log-count ratios of naive Bayes, the vector is brought to unit length
and a linear hinge-loss model is fitted by dual coordinate descent.  Margins become scores
through a logistic curve fitted on the training rows.

The fit takes at most ``max_train`` labelled rows, those with the smallest hash of their id;
every row is scored on its whole text.  Labels, language, source and id are never features.
Features that no training row has count for nothing, so new words do not dilute a margin.

Edge cases: NULL and empty texts have only the constant feature; labels that are NULL or
belong to no document are not used, repeated ones count once; without labels of both classes
every score is the share of label 1 (0.5 without labels); empty tables give empty results.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..names import col as named
from .common import id_crc, materialize

BITS = 20
#: Words whose numbers a task remembers, texts it holds as Python objects at once.
REMEMBERED, SLICE = 100_000, 256
#: Shares of the words from which a shape counts as a level of its own.
LEVELS = (0.02, 0.1, 0.3, 0.6)
RUNS = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Letters, capitals and digits become a, A, 0; runs are shortened to one character."""
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return RUNS.sub(r"\1", kinds)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def features(text: str | None, known: dict[str, int]) -> np.ndarray:
    """Sorted distinct feature numbers of a text; ``known`` remembers words: the hash of a word's
    shape in the high half of one number, that of the lower-cased word in the low half."""
    words = (text or "").split()
    if len(known) > REMEMBERED:
        known.clear()
    for w in set(words).difference(known):
        known[w] = zlib.crc32(shape(w).encode()) << 32 | zlib.crc32(w.lower().encode("utf-8", "surrogatepass"))
    if not words:
        return np.zeros(1, dtype=np.int32)
    both = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    s, word = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    same = np.r_[False, word[1:] == word[:-1]]
    s[same] = 1
    with np.errstate(over="ignore"):
        one, n = np.unique(_mix(s + np.uint64(1)), return_counts=True)
        grams = [one, _mix(word + np.uint64(1 << 40))]
        for items, kind in ((s, 0), (word, 10)):
            for size in (2, 3):
                g = np.full(max(len(s) - size + 1, 0), size + kind, dtype=np.uint64)
                for i in range(size):
                    g = _mix(g * np.uint64(0x9E3779B97F4A7C15) + items[i:i + len(g)])
                grams.append(g)
        for k, level in enumerate(LEVELS):
            grams.append(_mix(one[n >= level * len(s)] + np.uint64(k + 77)))
        hashed = np.concatenate(grams) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
    return np.unique(np.r_[np.int32(0), hashed.astype(np.int32)])


def slices(batches: Iterable) -> Iterator:
    """Arrow batches or arrays, SLICE rows at a time: so many texts are Python objects at once."""
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


@dataclass
class Model:
    """``weight`` per feature (log-count ratio times model weight), ``ratio``, logistic a, b."""

    weight: np.ndarray | None
    ratio: np.ndarray | None
    a: float
    b: float

    def margin(self, ids: np.ndarray) -> float:
        return float(self.weight[ids].sum() / max(np.linalg.norm(self.ratio[ids]), 1e-9))

    def score(self, ids: np.ndarray) -> float:
        z = self.a * self.margin(ids) + self.b if self.weight is not None else self.b
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, *, c: float,
                 epochs: int, seed: int = 3) -> np.ndarray:
    """min |w|^2/2 + c * sum of hinge losses, one dual variable at a time.

    Rows at a bound whose slope points beyond it by more than any row moved by in the pass
    before are passed over until the others have settled.
    """
    w, alpha = np.zeros(size), np.zeros(len(rows))
    norm = np.array([np.einsum("i,i", v, v) for v in values])
    rng = np.random.default_rng(seed)
    active, far = np.flatnonzero(norm > 0), np.inf
    every = active
    for _ in range(epochs):
        worst, stay = 0.0, []
        for i in rng.permutation(active):
            at, v = rows[i], values[i]
            held = w[at]
            slope = y[i] * np.einsum("i,i", held, v) - 1  # BLAS threads cost more than such short sums
            if alpha[i] == 0 and slope > far or alpha[i] == c and slope < -far:
                continue
            stay.append(i)
            new = min(max(alpha[i] - slope / norm[i], 0.0), c)
            if new != alpha[i]:
                w[at] = held + (new - alpha[i]) * y[i] * v
                worst, alpha[i] = max(worst, abs(new - alpha[i]) * norm[i]), new
        if worst < 1e-4:
            if len(active) == len(every):
                break
            active, far = every, np.inf
        else:
            active, far = np.array(stay), worst
    return w


def fit(sample: list[tuple[int, np.ndarray]], *, c: float = 1.0, epochs: int = 20, prior: float = 1.0) -> Model:
    """The model of (label, feature numbers) rows."""
    y = np.array([1.0 if q else -1.0 for q, _ in sample])
    if not len(y) or abs(y.sum()) == len(y):
        share = (float((y > 0).mean()) * len(y) + 1e-6) / (len(y) + 2e-6) if len(y) else 0.5
        return Model(None, None, 0.0, float(np.log(share / (1 - share))))
    size, rows = 1 << BITS, [ids for _, ids in sample]
    counts = {s: np.full(size, prior, np.float32) for s in (1, -1)}
    for ids, s in zip(rows, y):
        counts[int(s)][ids] += 1
    ratio = np.log(counts[1] / counts[1].sum(dtype=float))
    ratio -= np.log(counts[-1] / counts[-1].sum(dtype=float))
    ratio[(counts[1] == prior) & (counts[-1] == prior)] = 0
    ratio = ratio.astype(np.float32)
    del counts
    # one array for the values of all rows: freed at once, while many small ones stay with the process
    ends = np.cumsum([len(ids) for ids in rows])
    flat = np.empty(int(ends[-1]), dtype=np.float32)
    values = [flat[end - len(ids):end] for ids, end in zip(rows, ends)]
    for ids, v in zip(rows, values):
        v[:] = ratio[ids] / max(np.linalg.norm(ratio[ids]), 1e-9)
    w = dual_descent(rows, values, y, size, c=c, epochs=epochs)
    m = np.array([np.einsum("i,i", w[ids], v) for ids, v in zip(rows, values)])
    a, b = 1.0, 0.0  # logistic curve by Newton steps, with a small pull to keep it finite
    t = np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y < 0).sum()))
    x = np.c_[m, np.ones(len(m))]
    theta = np.array([a, b])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - t) + 1e-3 * theta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(hess, grad)
    return Model((w * ratio).astype(np.float32), ratio, float(theta[0]), float(theta[1]))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", folds: int = 5, held_fold: int = 0, max_train: int = 12_000) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    picked = labels.select(named(id_col).alias("label_id"), named(label_col).alias("label")).filter(
        "label_id IS NOT NULL AND label IS NOT NULL").filter(
        F.pmod(id_crc("label_id"), F.lit(folds)) != held_fold).groupBy("label_id").agg(
        F.max("label").alias("label")).orderBy(F.xxhash64("label_id"), "label_id").limit(max_train)
    # the ids are bounded by max_train, so they are broadcast
    rows = docs.select(named(id_col).alias("doc_id"), named(text_col).alias("text")).join(
        F.broadcast(picked), F.col("doc_id") == F.col("label_id")).select("label_id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for part in slices(batches):
            label_id, label, texts = part.columns
            ids = pa.array([features(t, known).tobytes() for t in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([label_id.cast(pa.int64()), label.cast(pa.int32()), ids], ["id", "label", "ids"])

    # written in parallel, then read file by file: the driver holds the features once, in one
    # array; the order of the rows is that of (id, label, content)
    found = materialize(rows.mapInArrow(run, "id long, label int, ids binary"), "nb-sample")
    flat, spans = array("i"), []
    for r in found.toLocalIterator():
        spans.append((r.id, r.label, zlib.crc32(r.ids), len(flat), len(flat) + len(r.ids) // 4))
        flat.frombytes(r.ids)
    every = np.frombuffer(flat, dtype=np.int32)
    return fit([(label, every[lo:hi]) for _, label, _, lo, hi in sorted(spans)])


def score_column(model: Model, text: Column, spark) -> Column:
    """The score of a text column; the model has a fixed size and is broadcast."""
    shared = spark.sparkContext.broadcast((model.weight, model.ratio, model.a, model.b))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, model = {}, Model(*shared.value)
        for texts in batches:
            scores = [model.score(features(t, known)) for part in slices([texts]) for t in part.to_pylist()]
            yield pa.array(scores, pa.float64())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, DoubleType())(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           folds: int = 5, held_fold: int = 0, cutoff: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, folds=folds, held_fold=held_fold, **options)
    return docs.select(
        named(id_col).alias("doc_id"), (F.pmod(id_crc(id_col), F.lit(folds)) == held_fold).alias("held_out"),
        score_column(model, named(text_col), docs.sparkSession).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= cutoff, 1).otherwise(0))


def good_documents(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", cutoff: float = 0.3,
                   **options) -> DataFrame:
    """The documents whose score reaches the cutoff, with their own columns."""
    model = train(docs, labels, text_col=text_col, **options)
    return docs.filter(score_column(model, named(text_col), docs.sparkSession) >= cutoff)
