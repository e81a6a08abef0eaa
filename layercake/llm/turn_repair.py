"""Operator 11: repair of conversation structure by one shortest path with integer weights.

The rows of a conversation, by turn, are edited so that the first letters of the roles read
``(s?(ua)+)?``: keep a row (cost 0), rerole it to user or assistant (3), delete it (4), or insert
an empty user or assistant turn (3).  Blank and duplicate rows must go; a truncated row that
stays adds 3.  Among the cheapest edits the audit (their initials in order) is ASCII-least.

The graph's nodes are (rows read, state): 0 nothing yet, 1 after s, 2 after u, 3 after a.  A
path's weight is ONE integer: its high digits are the cost, its low digits (base 8, of a fixed
width) the audit, the first letter highest and zeros at the end.  So the smaller integer is the
cheaper path and, of equal costs, the ASCII-least audit, and the dynamic programme takes plain
minima of integers.  Two paths of one cost that read the same rows never have audits of which one
begins the other (the longer would hold a further insertion, which costs), so the choice holds
whatever follows.

Hence stretches of rows can be solved apart: each yields the 4 x 4 weights from state to state,
and stretches join like matrices, with sums of weights and minima.  A long conversation is range-
partitioned over tasks, cut into stretches of ``STRETCH`` rows and joined by halves.  Its texts
are not part of that; they stream through one task once, in order, to be hashed.

Edge cases: NULL roles and texts count as one space, a NULL conversation id or turn as one space
in the damage key; a NULL id is a conversation of its own, a NULL turn comes first.  Rows of one
turn are taken by role and then by the SHA-256 of the text; equal rows are duplicates.  An empty
role has no initial and fits nowhere.  Conversations without rows after damage give zeros, an
empty audit and the hash of the empty text.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import operator
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import col as named
from .common import materialize
from .streams import task_count

#: The digits of the audit letters, in their ASCII order, and the edits' costs.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: From which states a role's initial may follow, and the state that it leads to.
FROM = {"s": (0,), "u": (0, 1, 3), "a": (2,)}
TO = {"s": 1, "u": 2, "a": 3}
STATES, STRETCH = 4, 128
LETTER = {v: k for k, v in DIGIT.items()}


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the test: by crc32 of ``conv:turn`` modulo 20, 0 drops a row, 1 empties its
    text, 2 takes its ``.!?``, 3 repeats it, 4 makes its role user.  (conv, turn, role, text)"""
    key = F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.withColumn("kind", kind).filter("kind <> 0").select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Every row (conv, turn, role, text) with digest and fault: blank, duplicate, truncated or ''.

    Equal rows of a turn are counted first, so many copies of a row are one row here; a text's
    first place is an aggregate, and no window ranks all copies of a text in one task."""
    own = rows.withColumn("digest", F.sha2("text", 256)).groupBy("conv", "turn", "role", "text", "digest").agg(
        F.count("*").alias("n"))
    first = own.groupBy("conv", "role", "digest").agg(F.min("turn").alias("at"), F.max(F.col("turn").isNull()).alias("null_turn"))
    first = first.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                         F.when(~F.col("null_turn"), F.col("at")).alias("t"), F.lit(True).alias("is_first"))
    met = own.join(first, F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
                   & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    last = F.right(F.regexp_replace("text", r"[\x20\x09-\x0D]+$", ""), F.lit(1))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")
    return met.select("conv", "turn", "role", "text", "digest", "is_first", last.alias("last"), each).select(
        "conv", "turn", "role", "text", "digest",
        F.when(F.col("last") == "", "blank").when(F.col("is_first").isNull() | (F.col("copy") > 1), "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated").otherwise("").alias("fault"))


# -- weights: cost * 8**width + audit digits
def _letters(digits: int, width: int) -> int:
    """How many letters stand before the zero padding."""
    return width - ((digits & -digits).bit_length() - 1) // 3 if digits else 0


def solve(rows: list[tuple[str, str]]) -> tuple[list[list[int | None]], int]:
    """The least weights from state to state over rows of (initial, fault), and their width."""
    width = 4 * len(rows) + 4
    low = (1 << 3 * width) - 1

    def add(w: int, cost: int, letter: str) -> int:
        return w + (cost << 3 * width) + (DIGIT[letter] << 3 * (width - 1 - _letters(w & low, width)))

    def insert(now: list[int | None]) -> list[int | None]:
        for role in ("u", "a"):  # a second round would only add cost
            ways = [add(now[q], INSERT, "I") for q in FROM[role] if now[q] is not None]
            now[TO[role]] = min([w for w in (now[TO[role]], *ways) if w is not None], default=None)
        return now

    out = []
    for start in range(STATES):
        now = insert([0 if q == start else None for q in range(STATES)])
        for initial, fault in rows:
            ways: list[list[int]] = [[] if w is None else [add(w, DELETE, "D")] for w in now]
            if fault in ("", "truncated"):
                more = TRUNCATED if fault else 0
                for role, cost, letter in ((initial, 0, "K"), ("u", REROLE, "R"), ("a", REROLE, "R")):
                    for q in FROM.get(role, ()):
                        if now[q] is not None:
                            ways[TO[role]].append(add(now[q], cost + more, letter))
            now = insert([min(w, default=None) for w in ways])
        out.append(now)
    return _trim(out, width)


def _trim(weights: list[list[int | None]], width: int) -> tuple[list[list[int | None]], int]:
    """The same weights at the width of their longest audit."""
    low = (1 << 3 * width) - 1
    most = max((_letters(w & low, width) for row in weights for w in row if w is not None), default=0)
    return [[None if w is None else w >> 3 * (width - most) for w in row] for row in weights], most


def join(a: tuple, b: tuple) -> tuple[list[list[int | None]], int]:
    """The weights over the rows of ``a`` and then those of ``b``."""
    (wa, na), (wb, nb) = a, b

    def both(x: int, y: int) -> int:
        digits = x & ((1 << 3 * na) - 1)
        after = (y & ((1 << 3 * nb) - 1)) << 3 * (na - _letters(digits, na))
        return (((x >> 3 * na) + (y >> 3 * nb)) << 3 * (na + nb)) + (digits << 3 * nb) + after

    return _trim([[min((both(row[m], wb[m][q]) for m in range(STATES)
                        if row[m] is not None and wb[m][q] is not None), default=None)
                   for q in range(STATES)] for row in wa], na + nb)


def join_all(parts: list[tuple]) -> tuple[list[list[int | None]], int]:
    """Neighbours joined in rounds, so that long integers meet only in the last ones."""
    while len(parts) > 1:
        parts = [join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def decide(weights: list[list[int | None]], width: int) -> tuple[int, str]:
    """Cost and audit of the least path from nothing to an accepted end."""
    w = min(x for x in (weights[0][0], weights[0][3]) if x is not None)
    n = _letters(w & ((1 << 3 * width) - 1), width)
    return w >> 3 * width, "".join(LETTER[w >> 3 * (width - 1 - i) & 7] for i in range(n))


def _legal(left: str, right: str) -> bool:
    return left + right in ("su", "ua", "au")


def _by_key(batches: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple]:
    """(key, its rows as tuples of ``columns``) of a stream sorted by key; the rows come one by
    one, so a long conversation is never gathered."""
    rows = (r for pdf in batches for r in zip(*(pdf[c].tolist() for c in ("key", *columns))))
    for key, group in itertools.groupby(rows, key=operator.itemgetter(0)):
        yield key, (r[1:] for r in group)


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (key, part, initial, fault) -> per conversation and task: first and last initial,
    illegal neighbours, weights as hex and their width."""
    columns = ["key", "part", "first", "last", "illegal", "weights", "width"]
    done: list[tuple] = []
    met: dict[tuple, tuple] = {}  # short stretches have few patterns of initials and faults
    for key, rows in _by_key(batches, "part", "initial", "fault"):
        first, last, illegal, stretch, solved = None, None, 0, [], []
        for part, initial, fault in rows:
            if last is None:
                first = initial
            elif not _legal(last, initial):
                illegal += 1
            last = initial
            stretch.append((initial, fault))
            if len(stretch) == STRETCH:
                solved.append(solve(stretch))
                stretch = []
        if stretch:
            pattern = tuple(stretch)
            if pattern not in met:
                if len(met) == 20_000:
                    met.clear()
                met[pattern] = solve(stretch)
            solved.append(met[pattern])
        weights, width = join_all(solved)
        done.append((key, part, first, last, illegal, ["" if w is None else f"{w:x}" for row in weights for w in row], width))
        if len(done) == 1000:
            yield pd.DataFrame(done, columns=columns)
            done = []
    if done:
        yield pd.DataFrame(done, columns=columns)


def _decided(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (key, part, ...) of :func:`_solved` -> (key, illegal, cost, audit)."""
    done = []
    for key, rows in _by_key(batches, "first", "last", "illegal", "weights", "width"):
        parts, illegal, before = [], 0, None
        for first, last, n, weights, width in rows:
            w = [int(x, 16) if x else None for x in weights]
            parts.append(([w[i:i + STATES] for i in range(0, STATES * STATES, STATES)], width))
            illegal += n + (before is not None and not _legal(before, first))
            before = last
        done.append((key, illegal, *decide(*join_all(parts))))
    yield pd.DataFrame(done, columns=["key", "illegal", "cost", "audit"]).astype({"illegal": "int64", "cost": "int64"})


class _Edited:
    """One conversation's rows edited by its audit, as they stream by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, ""

    def _next(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _put(self, role: str, text: str) -> tuple[str, str]:
        self.last = role[:1]
        return role, text

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._put(self._next(), "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter != "D":
            yield self._put(role if letter == "K" else self._next(), text)


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple[str, str]]:
    """The turns (role, text) that the audit, in the first row, leaves of the others."""
    edit = _Edited(next(rows)[0])
    for _, role, text in rows:
        yield from edit.row(role, text)
    yield from edit.inserted()


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (key, kind, audit, role, text), the audit first -> (key, repaired_sha256)."""
    done = []
    for key, rows in _by_key(batches, "audit", "role", "text"):
        sha, gap = hashlib.sha256(), ""
        for role, text in _repaired(rows):
            sha.update(f"{gap}{role}:{text}".encode())
            gap = "\n"
        done.append((key, sha.hexdigest()))
    yield pd.DataFrame(done, columns=["key", "repaired_sha256"])


def _turns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """As :func:`_hashed`, but -> (key, place, role, text): the repaired turns."""
    turns = ((key, place, role, text) for key, rows in _by_key(batches, "audit", "role", "text")
             for place, (role, text) in enumerate(_repaired(rows)))
    while some := list(itertools.islice(turns, 1000)):
        yield pd.DataFrame(some, columns=["key", "place", "role", "text"])


def _key(conv: Column) -> Column:
    """The id as text, which keeps NULL apart from every text."""
    return F.concat(F.lit("="), conv.cast("string"))


def audits(judged: DataFrame) -> DataFrame:
    """(key, illegal, cost, audit) of the conversations of :func:`faults`."""
    spark = judged.sparkSession
    order = ["conv", "turn", "role", "digest"]
    sorted_rows = judged.select(*order, "fault").repartitionByRange(task_count(spark), *order).sortWithinPartitions(
        *order).select(_key(F.col("conv")).alias("key"), F.spark_partition_id().alias("part"),
                       F.left("role", F.lit(1)).alias("initial"), "fault")
    solved = sorted_rows.mapInPandas(_solved, "key string, part int, first string, last string, illegal long, "
                                              "weights array<string>, width int")
    return materialize(solved.repartition(task_count(spark), "key").sortWithinPartitions("key", "part").mapInPandas(
        _decided, "key string, illegal long, cost long, audit string"), "turns-audits")


def _streamed(judged: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows, sorted within partitions."""
    spark = judged.sparkSession
    lead = found.select("key", F.lit(0).alias("kind"), "audit", *[
        F.lit(None).cast(judged.schema[c].dataType).alias(c) for c in ("turn", "role", "digest", "text")])
    rows = judged.select(_key(F.col("conv")).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"),
                         "turn", "role", "digest", "text")
    return lead.unionByName(rows).repartition(task_count(spark), "key").sortWithinPartitions(
        "key", "kind", "turn", "role", "digest").select("key", "audit", "role", "text")


def repair(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", damage: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(report, judged, found): the report has a row per conversation with its counts, cost and
    audit; the other two feed :func:`hashes` and :func:`repaired_turns`."""
    given = rows.select(named(conv_col).alias("conv"), named(turn_col).alias("turn"),
                        named(role_col).alias("role"), named(text_col).alias("text"))
    ready = damaged(given) if damage else given.withColumns(
        {"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    judged = materialize(faults(ready), "turns-judged")
    found = audits(judged)
    counts = judged.groupBy("conv").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    turns = judged.select("conv", "turn").distinct().groupBy("conv").agg(F.coalesce(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long"), F.lit(0).cast("long")).alias("gaps"))

    def by_key(df: DataFrame) -> DataFrame:
        return df.withColumn("k", F.coalesce(_key(F.col("conv")), F.lit(""))).drop("conv")

    every = given.select("conv").distinct().withColumn("k", F.coalesce(_key(F.col("conv")), F.lit("")))
    report = every.join(by_key(counts), "k", "left").join(by_key(turns), "k", "left").join(
        found.withColumn("k", F.coalesce("key", F.lit(""))).drop("key"), "k", "left").select(
        "conv", "k", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"))
    return report, judged, found


def hashes(judged: DataFrame, found: DataFrame) -> DataFrame:
    """(key, repaired_sha256): of the repaired ``role:text`` lines of each conversation."""
    return _streamed(judged, found).mapInPandas(_hashed, "key string, repaired_sha256 string")


def repaired_turns(judged: DataFrame, found: DataFrame) -> DataFrame:
    """(key, place, role, text): the repaired conversations; key is the id as text after ``=``."""
    return _streamed(judged, found).mapInPandas(_turns, "key string, place long, role string, text string")


def repair_report(rows: DataFrame, **options) -> DataFrame:
    """One row per conversation id: counts, cost, audit and the hash of what the repair leaves."""
    report, judged, found = repair(rows, **options)
    sums = hashes(judged, found).withColumn("k", F.coalesce("key", F.lit(""))).drop("key")
    return report.join(sums, "k", "left").select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
