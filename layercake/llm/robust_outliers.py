"""Operator 2: quality rules with robust multivariate outliers, native SQL functions only.

Every document has a vector of variance-stabilised statistics.  Per language and source
a minimum-covariance-determinant estimate is found by concentration steps from a robust
start (medians, scaled absolute deviations): keep the ``coverage`` share of documents
nearest by Mahalanobis distance, re-estimate mean and covariance, repeat.  A document
whose squared distance lies beyond the chi-square ``confidence`` quantile is rejected.
Each statistic has a noise floor added to its variance, as most documents have no symbol
or repeated line at all and the plain determinant would be zero.

Edge cases: NULL and empty texts have no words and fail the base rules; NULL language or
source is a value of its own; groups under ``min_group`` documents are pooled, and if even
the pool is smaller no document is rejected by distance; repeated rows count as often as
they occur; an empty table gives an empty result; columns of the same names pass untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import col as named
from .common import SPACE, broadcast_if_small, keep_columns, materialize, split_words

WINDOW = 8
#: The symbol class of the base rules.
SYMBOLS = r"[#*$%&|<>]"
#: Statistics and their noise floors (standard deviations on the transformed scale).
STATS = {"word_len": 0.10, "symbols": 0.06, "dup_lines": 0.06, "repeats": 0.10, "upper": 0.10}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pair_hash(items: Column, gap: int) -> Column:
    """Hashes of the items ``gap`` apart: doubles the width of hashed windows."""
    def pairs(x: Column) -> Column:
        n = F.greatest(F.size(x) - gap, F.lit(0))
        return F.zip_with(F.slice(x, 1, n), F.slice(x, gap + 1, n), lambda a, b: F.xxhash64(a, b))
    return _let(items, pairs)


def _covered(ordered: Column) -> Column:
    """Words covered by the windows whose hash has an equal neighbour in sorted order."""
    twins = F.filter(ordered, lambda x, k: (
        (k > 0) & (F.get(ordered, k - 1)["h"] == x["h"])) | (
        (k < F.size(ordered) - 1) & (F.get(ordered, k + 1)["h"] == x["h"])))
    def span(hits: Column) -> Column:
        gaps = F.zip_with(F.slice(hits, 2, F.size(hits)), F.slice(hits, 1, F.size(hits) - 1),
                          lambda b, a: F.least(b - a, F.lit(WINDOW)))
        return F.when(F.size(hits) > 0, F.aggregate(gaps, F.lit(WINDOW), lambda t, x: t + x)
                      ).otherwise(F.lit(0))
    return _let(F.sort_array(F.transform(twins, lambda x: x["i"])), span)


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight that occur twice or more in the array.

    Windows of eight can only repeat where windows of four do.  Equal hashes are neighbours
    after sorting (hash, position), so the cost is n log n for any text.
    """
    def some_twice(x: Column) -> Column:
        return F.size(F.array_distinct(x)) < F.size(x)

    def eights(h8: Column) -> Column:
        ordered = F.sort_array(F.transform(h8, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(some_twice(h8), _let(ordered, _covered)).otherwise(F.lit(0))

    return _let(_pair_hash(_pair_hash(words, 1), 2), lambda h4: F.when(
        some_twice(h4), _let(_pair_hash(h4, 4), eights)).otherwise(F.lit(0)))


def with_base(docs: DataFrame, text: Column) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, base_failed."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    counts = _let(split_words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("r")))
    df = docs.withColumns({
        "counts": counts,
        "word_chars": F.length(F.regexp_replace(t, f"[{SPACE}]+", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "n_upper": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")})
    return (materialize(df.drop("text0"), "mcd-counts")
            .withColumns({"n_words": F.col("counts.n"), "n_repeat_words": F.col("counts.r")})
            .withColumn("base_failed", (F.col("n_words") < 20)
                        | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).drop("counts"))


def with_vector(df: DataFrame) -> DataFrame:
    """The transformed statistics (log and square-root scales); zero words give zeros."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return (df.withColumn("word_len", F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n))
            .withColumn("symbols", F.sqrt(F.col("n_symbols") / n))
            .withColumn("dup_lines", F.sqrt(F.col("n_dup_lines") / n))
            .withColumn("repeats", F.sqrt(F.col("n_repeat_words") / n))
            .withColumn("upper", F.sqrt(F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)))))


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function by the series of the incomplete gamma function."""
    a, z = k / 2, x / 2
    if z <= 0:
        return 0.0
    term = total = 1 / a
    i = a
    while term > total * 1e-15:
        i += 1
        term *= z / i
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def _inverse_factor(stats: DataFrame, scale: float) -> DataFrame:
    """From means and covariances per group to the inverse Cholesky factor ``w_ij``."""
    d, floors = len(STATS), list(STATS.values())
    for i in range(d):
        for j in range(i + 1):
            cov = F.coalesce(F.col(f"c_{i}_{j}"), F.lit(0.0)) * scale
            cov = cov + floors[i] ** 2 if i == j else cov
            for k in range(j):
                cov = cov - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            stats = stats.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(cov, F.lit(1e-12))) if i == j
                                     else cov / F.col(f"l_{j}_{j}"))
    for i in range(d):
        for j in range(i + 1):
            if i == j:
                stats = stats.withColumn(f"w_{i}_{j}", 1 / F.col(f"l_{i}_{i}"))
            else:
                s = sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)), F.lit(0.0))
                stats = stats.withColumn(f"w_{i}_{j}", -s / F.col(f"l_{i}_{i}"))
    return stats.drop(*[f"{x}_{i}_{j}" for x in "cl" for i in range(d) for j in range(i + 1)])


def squared_distance() -> Column:
    """Squared Mahalanobis distance from the joined estimate's ``m_i`` and ``w_ij``."""
    names = list(STATS)
    total = F.lit(0.0)
    for i in range(len(names)):
        y = sum((F.col(f"w_{i}_{j}") * (F.col(names[j]) - F.col(f"m_{j}")) for j in range(i + 1)),
                F.lit(0.0))
        total = total + y * y
    return total


def estimates(vectors: DataFrame, *, coverage: float, steps: int, min_group: int) -> DataFrame:
    """One row (g_lang, g_source, size, m_i, w_ij) per group; ``pooled`` marks the common group.

    ``vectors``: lang, source and the statistics of the documents that passed the base rules.
    """
    names, d = list(STATS), len(STATS)
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("size"))
    groups = materialize(sizes.select(
        "lang", "source", (F.col("size") < min_group).alias("pooled")), "mcd-groups")
    groups = broadcast_if_small(groups)
    same = lambda a, b: a["lang"].eqNullSafe(b["lang"]) & a["source"].eqNullSafe(b["source"])
    labelled = vectors.join(groups, same(vectors, groups)).select(
        F.when(groups["pooled"], F.lit("")).otherwise(F.to_json(F.struct(
            vectors["lang"], vectors["source"]))).alias("g"), *names)
    labelled = materialize(labelled, "mcd-vectors")

    def medians(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
        return df.groupBy("g").agg(*[F.percentile_approx(c, 0.5).alias(n) for n, c in cols.items()])

    def factor(stats: DataFrame, scale: float, k: object) -> DataFrame:
        return broadcast_if_small(materialize(_inverse_factor(stats, scale), f"mcd-estimate-{k}"))

    centre = broadcast_if_small(materialize(medians(labelled, {f"m_{i}": F.col(n) for i, n in enumerate(names)}), "mcd-medians"))
    spread = medians(labelled.join(centre, "g"), {
        f"s_{i}": F.abs(F.col(n) - F.col(f"m_{i}")) for i, n in enumerate(names)})
    start = centre.join(spread, "g")
    for i in range(d):
        for j in range(i + 1):
            start = start.withColumn(f"c_{i}_{j}", (1.4826 * F.col(f"s_{i}")) ** 2 if i == j else F.lit(0.0))
    current = factor(start.drop(*[f"s_{i}" for i in range(d)]), 1.0, "start")
    # the kept share of a normal sample has smaller spread by a known factor
    scale = coverage / chi2_cdf(chi2_quantile(coverage, d), d + 2)
    for k in range(steps):
        far = labelled.join(current, "g").withColumn("d2", squared_distance()).select("g", "d2", *names)
        cut = broadcast_if_small(materialize(far.groupBy("g").agg(F.percentile_approx("d2", coverage).alias("cut")),
                          f"mcd-cut-{k}"))
        aggs = [F.avg(n).alias(f"m_{i}") for i, n in enumerate(names)] + [
            F.covar_pop(names[i], names[j]).alias(f"c_{i}_{j}") for i in range(d) for j in range(i + 1)]
        kept = far.join(cut, "g").filter("d2 <= cut").groupBy("g").agg(*aggs)
        current = factor(kept, scale, k)
    count = labelled.groupBy("g").agg(F.count("*").alias("size"))
    final = current.join(count, "g")
    key = F.when(F.col("pooled"), F.lit("")).otherwise(F.to_json(F.struct("lang", "source")))
    return broadcast_if_small(materialize(groups.withColumn("g", key).join(final, "g")
                       .withColumnRenamed("lang", "g_lang").withColumnRenamed("source", "g_source"),
                       "mcd-final"))


def judge(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", coverage: float = 0.75, steps: int = 3,
          min_group: int = 100, confidence: float = 1 - 1e-7,
          carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default) with the base counts,
    base_failed, distance (squared, NULL where not estimated) and kept.

    The statistics are written once and reread for the estimates and the verdict.
    """
    base = with_vector(with_base(docs.select(
        keep_columns(docs.select(*map(named, carry or docs.columns))),
        named(lang_col).cast("string").alias("lang"),
        named(source_col).cast("string").alias("source"), named(text_col).alias("text0")),
        F.col("text0")))
    passed = base.filter(~F.col("base_failed")).select("lang", "source", *STATS)
    est = estimates(passed, coverage=coverage, steps=steps, min_group=min_group)
    cutoff = chi2_quantile(confidence, len(STATS))
    joined = base.join(est, ~F.col("base_failed") & F.col("lang").eqNullSafe(F.col("g_lang"))
                       & F.col("source").eqNullSafe(F.col("g_source")), "left")
    distance = F.when(F.col("size") >= min_group, squared_distance())
    return (joined.withColumn("distance", distance)
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True)))
            .select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "distance", "kept"))


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows that the rules keep, with their own columns."""
    return judge(docs, **options).filter("kept").select("row.*")
