r"""Operator 12: substring dedup by automata of repeated phrases.

A window is ``WINDOW`` consecutive words of one text.  A window whose word sequence also starts
earlier (smaller id, or the same document at an earlier word) is repeated, and its words go.

1. Anchors.  Of the 8-word phrases inside a window, the one with the smallest hash is its
   anchor: equal windows have equal anchors, and a text has about one anchor per seven words.
   Only documents and windows whose anchor occurs twice can repeat.  Hashes serve as this filter
   alone; a collision costs work and changes no result.
2. Stretches.  Neighbouring windows with one anchor form a stretch, sent to the shard of that
   anchor.  All windows that could be equal meet there.
3. Confirmed phrases.  In a shard, windows that occur twice are confirmed where they occur first.
   Anchors of more than ``HOT`` stretches have shards of their own; there the confirmed windows
   come from a native aggregate with map-side combining, and the stretches are salted over
   several tasks.
4. Automata.  Each shard writes words as characters, an exact one-to-one code, and compiles its
   confirmed windows into an Aho-Corasick automaton.  All stretches stream through it; every
   window that it locates elsewhere than at its first place is repeated.  A place matches one
   confirmed window at most, so the work follows the words and no pairs of copies are made.

Edge cases: NULL texts and texts without words have no windows and keep no words; texts of fewer
words than a window keep all.  Rows with equal id and text get equal results.  Rows with one id
and different texts count as documents in the order of their text hashes; NULL ids come last.
Copies of a whole text (at least one window long) lose every word except where the id is
smallest.  Ids may have any sortable type; other columns pass through, whatever their names.
Empty tables work.  A text may have at most 2**28 words, which Spark's 2 GB rows keep it under
in practice; longer ones raise an error.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..names import col as named
from .common import keep_columns, materialize, split_words
from .streams import runs, task_count, text_slices

#: Words of a window and of an anchor.
WINDOW, ANCHOR = 20, 8
#: Stretches of one anchor beyond which it gets shards of its own, and words of one shard.
HOT, SHARD_WORDS = 5_000, 200_000
#: Low bits of a position hold the word's number in its document.
AT = 28


#: Bytes that are hashed at a time, and the powers of the word hash's base for their places.
CHUNK = 1 << 20
_BASE = 0x9E6C63D0676A9A99
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.append(np.uint64(1), np.cumprod(np.full(CHUNK, b, dtype=np.uint64))) for b in (_BASE, inverse))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _rolled(codes: np.ndarray, k: int, base: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` neighbouring codes."""
    h = np.zeros(max(len(codes) - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        h = h * np.uint64(base) + codes[j:j + len(h)]
    return _mix(h)


def _words(texts, powers: tuple) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one buffer; each word's first byte, end and hash; each text's end in words.
    ``powers``: those of :func:`_powers`, made once per task."""
    parts = [(t or "").encode() for t in texts]
    data = b"\n".join(parts) + b"\n"
    powers, inverse = powers
    begins, ends, hashes = [], [], []
    at = 0
    while at < len(data):  # whole words at a time; one longer than a chunk is hashed by pieces
        stop = at + CHUNK
        if stop < len(data):
            stop = max((data.rfind(c, at, stop) for c in (b" ", b"\n", b"\t", b"\v", b"\f", b"\r")), default=-1) + 1 or stop
        raw = np.frombuffer(data, dtype=np.uint8, count=min(stop, len(data)) - at, offset=at)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _BLANK[raw], [True]]).astype(np.int8)))
        lo, hi = edge[::2], edge[1::2]
        total = np.append(np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:len(raw)]))
        begins.append(lo + at)
        ends.append(hi + at)
        hashes.append(_mix((total[hi] - total[lo]) * inverse[lo]))
        at = min(stop, len(data))
    begin, end, hashes = np.concatenate(begins), np.concatenate(ends), np.concatenate(hashes)
    first = np.flatnonzero(np.append(True, begin[1:] != end[:-1])[:len(begin)])
    if len(first) < len(begin):  # pieces of one word
        begin, end = begin[first], end[np.append(first[1:], len(end)) - 1]
        hashes = np.add.reduceat(hashes, first)
    text_ends = np.searchsorted(begin, np.cumsum([len(x) + 1 for x in parts]))
    return data, begin, end, hashes, text_ends


def _anchors(hashes: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The stretches of the texts that end at ``ends``: text, anchor, first and last window, and
    whether the anchor is in the stretch at two places (the text then repeats itself there)."""
    grams = _rolled(hashes, ANCHOR, 0x100000001B3)
    span = WINDOW - ANCHOR + 1
    n = len(grams) - span + 1
    if n <= 0:
        return {c: np.zeros(0, dtype=np.int64) for c in ("text", "anchor", "first", "last", "twice")}
    least, left, right = grams[:n].copy(), np.arange(n), np.arange(n)
    for j in range(1, span):
        here = grams[j:j + n]
        lower, equal = here < least, here == least
        left[lower] = np.flatnonzero(lower) + j
        lower |= equal
        right[lower] = np.flatnonzero(lower) + j
        np.minimum(least, here, out=least)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:n]
    at = np.flatnonzero(np.arange(n) + WINDOW <= ends[text])
    if not len(at):
        return _anchors(hashes[:0], ends)
    text, anchor, left, right = text[at], least[at].view(np.int64), left[at], right[at]
    begin = np.append(0, np.flatnonzero((anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])) + 1)
    return {"text": text[begin], "anchor": anchor[begin], "first": at[begin],
            "last": at[np.append(begin[1:], len(at)) - 1],
            "twice": np.minimum.reduceat(left, begin) != np.maximum.reduceat(right, begin)}


def _pair(anchor: np.ndarray, text: np.ndarray) -> np.ndarray:
    """(text of a slice, anchor) as one number; a collision only lets needless work through."""
    return anchor + np.int64(0x9E3779B97F4A7C1) * text


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(k1, text) -> (anchor, k1, often): a document's distinct anchors; often: at two places."""
    powers = _powers()
    for pdf in batches:
        for part in text_slices(pdf, "text", CHUNK):
            *_, hashes, ends = _words(part["text"], powers)
            found = _anchors(hashes, ends)
            _, first, group, n = np.unique(_pair(found["anchor"], found["text"]), return_index=True,
                                           return_inverse=True, return_counts=True)
            twice = np.bincount(group, weights=found["twice"], minlength=len(first)) > 0
            yield pd.DataFrame({"anchor": found["anchor"][first], "k1": part["k1"].to_numpy()[found["text"][first]],
                                "often": (n > 1) | twice})


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(no, text, anchors) -> (anchor, pos, n, words): the stretches of the given anchors, the
    number of their words and the words."""
    powers = _powers()
    for pdf in batches:
        for part in text_slices(pdf, "text", CHUNK):
            data, begin, end, hashes, ends = _words(part["text"], powers)
            most = int(np.diff(ends, prepend=0).max())
            if most >= 1 << AT:
                raise ValueError(f"a text has {most} words; at most 2**{AT} are supported")
            found, lists = _anchors(hashes, ends), part["anchors"].to_numpy()
            asked = _pair(np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            held = np.isin(_pair(found["anchor"], found["text"]), asked)
            text, first, last = (found[c][held] for c in ("text", "first", "last"))
            pos = (part["no"].to_numpy(dtype=np.int64)[text] << AT) + first - np.append(0, ends)[text]
            yield pd.DataFrame({"anchor": found["anchor"][held], "pos": pos,
                                "n": (last - first + WINDOW).astype(np.int32),
                                "words": [data[a:b].decode() for a, b in zip(begin[first], end[last + WINDOW - 1])]})


def _single_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(anchor, pos, words) of hot anchors -> one row per window."""
    for pdf in batches:
        for anchor, pos, text in zip(pdf["anchor"], pdf["pos"], pdf["words"]):
            w = text.encode().split()
            n = len(w) - WINDOW + 1
            yield pd.DataFrame({"anchor": np.full(n, anchor), "pos": np.arange(pos, pos + n),
                                "words": [b" ".join(w[i:i + WINDOW]).decode() for i in range(n)]})


class _Texts:
    """Stretches or single windows: positions, sizes in words, and all words in one list."""

    def __init__(self, parts: list[pd.DataFrame]):
        whole = pd.concat(parts) if parts else pd.DataFrame({"pos": [], "n": [], "words": []})
        self.pos, self.size = whole["pos"].to_numpy(dtype=np.int64), whole["n"].to_numpy(dtype=np.int64)
        self.words = "\n".join(whole["words"]).encode().split()
        self.end = np.cumsum(self.size)


def _spread(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For segments (begin, size): the segment and the place of each element."""
    pick = np.repeat(np.arange(len(size)), size)
    return pick, np.arange(len(pick)) - np.repeat(np.cumsum(size) - size, size) + begin[pick]


def _chars(codes: np.ndarray) -> str:
    """One character per word; the range that holds no characters is left out."""
    c = codes.astype(np.uint32)
    return (c + (c >= 0xD800) * np.uint32(0x800)).astype("<u4").tobytes().decode("utf-32-le")


class _Phrases:
    """The confirmed windows of one shard, as an automaton over words written as characters."""

    def __init__(self, known: _Texts, own: _Texts):
        """known: confirmed windows; own: stretches in the order of position, whose windows are
        confirmed here."""
        codes, vocabulary = pd.factorize(np.array(known.words + own.words, dtype=object))
        # a word of the stretches that is met once is in no repeated window and stays 0
        often = np.bincount(codes, minlength=len(vocabulary)) > 1
        often[codes[:len(known.words)]] = True
        number = np.where(often, np.cumsum(often), 0)
        if len(number) and number.max() > 1_100_000:
            raise ValueError("a shard has more distinct words than there are characters")
        codes = number[codes].astype(np.int32)
        self.vocabulary, self.number = pd.Index(vocabulary), np.append(number, 0).astype(np.int32)
        self.own, self.own_codes = own, codes[len(known.words):]
        places, pos = self._confirm()
        self.pos = np.concatenate([known.pos, pos])
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        begin, texts = known.end - known.size, _chars(codes)
        for i, at in enumerate(np.concatenate([begin, places + len(known.words)]).tolist()):
            self.automaton.add_word(texts[at:at + WINDOW], i)
        if len(self.pos):
            self.automaton.make_automaton()

    def _confirm(self) -> tuple[np.ndarray, np.ndarray]:
        """The windows at their first place that occur again: first word among the stretches'
        words, and position."""
        own, every = self.own, self.own_codes
        if not len(own.pos):
            return own.pos, own.pos
        mixed = _mix((every.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        pick, at = _spread(own.end - own.size, own.size - WINDOW + 1)
        some = np.append(0, np.cumsum(every == 0))
        whole = some[at + WINDOW] == some[at]  # no word that is met once
        pick, at = pick[whole], at[whole]
        h1, h2 = (_rolled(mixed, WINDOW, base)[at] for base in (0x100000001B3, 0xD6E8FEB86659FD93))
        order = np.argsort(h1, kind="stable")
        met = h1[order][1:] == h1[order][:-1]
        if (met & (h2[order][1:] != h2[order][:-1])).any():
            order = np.lexsort((np.arange(len(at)), h2, h1))
            met = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
        first = order[(np.append(True, ~met) & np.append(met, False))[:len(order)]]  # a group's first of several
        return at[first], own.pos[pick[first]] + at[first] - (own.end - own.size)[pick[first]]

    def repeated_own(self) -> pd.DataFrame:
        return self._find(self.own, self.own_codes)

    def repeated(self, targets: _Texts) -> pd.DataFrame:
        return self._find(targets, self.number[self.vocabulary.get_indexer(pd.Index(targets.words, dtype=object))])

    def _find(self, targets: _Texts, codes: np.ndarray) -> pd.DataFrame:
        """(pos, n): runs of the targets' windows that repeat a confirmed window."""
        none = pd.DataFrame({"pos": np.zeros(0, dtype=np.int64), "n": np.zeros(0, dtype=np.int32)})
        if not len(self.pos) or not len(targets.pos):
            return none
        text = _chars(np.insert(codes, targets.end, 0))  # a 0 after each target keeps windows inside one
        end = targets.end + np.arange(1, len(targets.end) + 1)
        hits = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
        at, phrase = hits[:, 0] - WINDOW + 1, hits[:, 1]
        where = np.searchsorted(end, at, side="right")
        here = targets.pos[where] + at - (end - targets.size - 1)[where]
        found = np.unique(here[here != self.pos[phrase]])
        if not len(found):
            return none
        cut = np.append(0, np.flatnonzero(np.diff(found) != 1) + 1)
        return pd.DataFrame({"pos": found[cut], "n": np.diff(np.append(cut, len(found))).astype(np.int32)})


def _match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (shard, salt, kind, pos) -> (pos, n) of repeated windows.

    kind 0: a confirmed window, 1: a stretch to confirm and to search, 2: a stretch to search.
    What is held is the shard's windows and its stretches of kind 1, both bounded, and one batch."""
    phrases, known, own, current = None, [], [], None
    for (shard, salt, kind), _, part in runs(batches, ["shard", "salt", "kind"]):
        if (shard, salt) != current:
            if own:
                yield _Phrases(_Texts([]), _Texts(own)).repeated_own()
            phrases, known, own, current = None, [], [], (shard, salt)
        if kind == 0:
            known.append(part)
        elif kind == 1:
            own.append(part)
        else:
            phrases = phrases or _Phrases(_Texts(known), _Texts([]))
            yield phrases.repeated(_Texts([part]))
    if own:
        yield _Phrases(_Texts([]), _Texts(own)).repeated_own()


def _kept(spans: list, words: list[bytes]) -> tuple[int, str]:
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for pos, n in spans:
        at = pos & ((1 << AT) - 1)
        gone[at] += 1
        gone[at + n + WINDOW - 1] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    return int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g).decode()


def _cut(digest: bool) -> object:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(k1, k2, text, spans) -> (k1, k2, n_removed, kept)"""
        for pdf in batches:
            done = [_kept([(s["pos"], s["n"]) for s in spans], t.encode().split())
                    for spans, t in zip(pdf["spans"], pdf["text"])]
            kept = [k for _, k in done]
            yield pd.DataFrame({"k1": pdf["k1"].to_numpy(), "k2": pdf["k2"].to_numpy(),
                                "n_removed": np.array([n for n, _ in done], dtype=np.int64),
                                "kept": [hashlib.sha256(k.encode()).hexdigest() for k in kept] if digest else kept})
    return cut


def _numbered(texts: DataFrame) -> DataFrame:
    """``texts`` with ``no``: 0, 1, 2 ... in the order of id (NULL last) and text hash."""
    order = [F.col("no_id"), F.col("id"), F.col("k1"), F.col("k2")]
    placed = materialize(texts.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"part": F.spark_partition_id(), "row_no": F.monotonically_increasing_id()}), "phrases-order")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = placed.groupBy("part").agg(F.count("*").alias("rows"), F.min("row_no").alias("low")).select(
        "part", "low", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").withColumn(
        "no", F.col("row_no") - F.col("low") + F.col("offset")).drop("part", "row_no", "low", "offset")


def repeated_windows(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From rows (id, no_id, ids, k1, k2, text): the documents that may repeat (no, k1, k2, text),
    and runs of repeated windows (pos, n); pos is ``no << AT`` plus the word's number."""
    spark = keyed.sparkSession
    hits = keyed.select("k1", "text").mapInPandas(_anchor_rows, "anchor long, k1 long, often boolean")
    twice = hits.groupBy("anchor").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"), F.max("often").alias("often")
                                       ).filter((F.col("lo") != F.col("hi")) | F.col("often")).select("anchor")
    lists = hits.select("anchor", "k1").join(twice, "anchor").groupBy("k1").agg(F.collect_set("anchor").alias("anchors"))
    # of each text the row with the smallest id stands for all copies
    firsts = keyed.groupBy("k1", "k2").agg(F.min(F.struct("no_id", "id", "ids")).alias("f")).select(
        "k1", "k2", "f.no_id", "f.id", "f.ids")
    asked = _numbered(firsts.join(lists, "k1")).select("k1", "k2", "ids", "no", "anchors")
    docs = materialize(keyed.select("k1", "k2", "ids", "text").dropDuplicates(["k1", "k2", "ids"])
                       .join(asked, ["k1", "k2", "ids"]).select("no", "k1", "k2", "text", "anchors"), "phrases-documents")
    found = materialize(docs.select("no", "text", "anchors").mapInPandas(
        _stretches, "anchor long, pos long, n int, words string"), "phrases-stretches")
    per_anchor = found.groupBy("anchor").count()
    hot = materialize(per_anchor.filter(F.col("count") > HOT), "phrases-hot")
    words = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = 1 + int(words // SHARD_WORDS)
    marked = found.join(hot, "anchor", "left") if hot.count() else found.withColumn("count", F.lit(None).cast("long"))
    cold = marked.filter("count IS NULL").select(
        F.pmod("anchor", F.lit(shards)).alias("shard"), F.lit(-1).cast("long").alias("salt"), F.lit(1).alias("kind"), "pos", "n", "words")
    salts = 1 + F.floor(F.col("count") / HOT)
    busy = marked.filter("count IS NOT NULL").select(
        F.col("anchor").alias("shard"), F.pmod(F.xxhash64("pos"), salts).alias("salt"), F.lit(2).alias("kind"), "pos", "n", "words")
    confirmed = marked.filter("count IS NOT NULL").select("anchor", "pos", "words").mapInPandas(
        _single_windows, "anchor long, pos long, words string").groupBy("anchor", "words").agg(
        F.min("pos").alias("pos"), F.count("*").alias("met")).filter("met > 1").join(hot, "anchor").select(
        F.col("anchor").alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("count") / HOT))).alias("salt"),
        F.lit(0).alias("kind"), "pos", F.lit(WINDOW).alias("n"), "words")
    rows = cold.unionByName(busy).unionByName(confirmed)
    spans = rows.repartition(task_count(spark), "shard", "salt").sortWithinPartitions(
        "shard", "salt", "kind", "pos").mapInPandas(_match, "pos long, n int")
    return docs.select("no", "k1", "k2", "text"), materialize(spans, "phrases-spans")


def strip_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                  digest: bool = False) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default), n_words, n_removed and kept: the
    words that stay joined by one space, or with ``digest`` the SHA-256 of that text."""
    text = F.coalesce(named(text_col), F.lit(""))
    keyed = docs.select(
        named(id_col).alias("id"), named(id_col).isNull().alias("no_id"),
                        F.coalesce(F.concat(F.lit("="), named(id_col).cast("string")), F.lit("")).alias("ids"), F.xxhash64(text).alias("k1"),
                        F.xxhash64(F.lit(1), text).alias("k2"), text.alias("text"))
    some, spans = repeated_windows(keyed)
    lists = spans.withColumn("no", F.shiftright("pos", AT)).groupBy("no").agg(
        F.collect_list(F.struct("pos", "n")).alias("spans"))
    cut = materialize(some.join(lists, "no").select("k1", "k2", "text", "spans").mapInPandas(
        _cut(digest), "k1 long, k2 long, n_removed long, kept string"), "phrases-cut")
    # a whole copy of a text with a smaller id repeats all its windows
    copies = keyed.groupBy("k1", "k2").agg(F.min(F.struct("no_id", "id", "ids")).alias("f"), F.min("ids").alias("lo"),
                                           F.max("ids").alias("hi")).filter("lo <> hi").select("k1", "k2", F.col("f.ids").alias("own"))
    info = materialize(copies.join(cut, ["k1", "k2"], "full"), "phrases-info")
    words = split_words(text)
    base = docs.select(keep_columns(docs.select(*map(named, carry or docs.columns))), 
                       F.coalesce(F.concat(F.lit("="), named(id_col).cast("string")), F.lit("")).alias("ids"),
                       F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"),
                       F.size(words).cast("long").alias("n_words"), F.concat_ws(" ", words).alias("base"))
    if digest:
        base = base.withColumn("base", F.sha2("base", 256))
    gone = F.coalesce(F.col("own") != F.col("ids"), F.lit(False)) & (F.col("n_words") >= WINDOW)
    none = F.sha2(F.lit(""), 256) if digest else F.lit("")
    return base.join(info, ["k1", "k2"], "left").select(
        "row", "n_words", F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, none).otherwise(F.coalesce("kept", "base")).alias("kept"))
