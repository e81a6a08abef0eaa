"""Operator 5: LM scoring by online logistic mixing of hashed-context bit predictors.

The text (A-Z lower-cased, UTF-8, one end symbol) is coded bit by bit along a Huffman tree of
its bytes.  It is cut after every white space byte and the end into units.  Two contexts
(the last four bytes, up to two bytes before the unit, and the unit so far) predict each bit
from the counts of all training documents; a third predictor follows the unit that came after
the last same unit of the document, as sure as its hits in a row make it.  The predictions, as
log-odds, are combined by weights gated by the place of the bit in its code and by whether
training documents hold the unit so far; the weights start alike for every document
and are refined on the document itself, block by block, before the next block is predicted.
The score is the log10 probability of all bits.

The counts grow with the corpus: every distinct (context, symbol) is kept, contexts of bytes
exactly and units by 55 bits of their hash.  Contexts depend on a unit and the two bytes before
it, so a chunk of documents counts and looks up its distinct units only.  It sends pre-added
counts to shards of the key space and gets back the sums for its contexts: no task or
driver holds the whole model.  A chunk and a shard exchange one row; chunks and shards stand
for a stated number of bytes, and a chunk sends at most as many rows as it has contexts.

The base score is the unigram score of the words: exact sums over all training documents by
64-bit word hashes, in the same exchange.

Edge cases: NULL and empty texts are the end symbol alone; a NULL id counts as the empty text
for the fold and an id that is no number is NULL in the result; repeated rows are scored each;
without training documents every bit has probability one half; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..names import col as named
from .common import id_crc, materialize

#: Bytes of text per chunk row, per shard of the counts, and counted, scored or coded at once.
CHUNK, SHARD, GROUP, SCORED, CODED = 16 << 20, 64 << 20, 256 << 10, 256 << 10, 512 << 10
#: Keys that a chunk gathers before it adds those that are equal.
GATHERED = 1 << 20
#: Shards that small inputs are dealt to, where they have as many chunks.
SHARDS = 64
END = 0xFF  # in no UTF-8 text
#: Bytes before a unit that its contexts see, bytes of the byte context.
BEFORE, BACK = 2, 4
#: Stands for bytes further back; in no UTF-8 text.
FAR = 0xFE
SCALE = 12.0
#: Weights of the last bytes, the unit so far, the unit after the last same unit, where training
#: documents lack the unit so far and where they hold it.
START_WEIGHTS = ((1.0, 0.0, 0.1), (0.35, 0.65, 0.05))
#: Count that a bit has before any text; step of the weights; gates per state: steps of a code.
SMOOTH, RATE, STEPS = 0.05, 1.0, 4
GATES = STEPS * len(START_WEIGHTS)
#: Hits in a row that the fourth predictor counts.
RUN = 32
#: Mixed log-odds end at EDGE and are rounded to 1 / GRADES, alike for both bits.
EDGE, GRADES = 14, 256
#: Units after which the weights move.
BLOCKS = (0, 8, 16, 32, 64, 128, 256, 512, 1024)
MULT = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
BYTE = np.uint64(0xFF)
#: log2 of the places of a lookup table.
PLACES = 22


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each with END bytes before it and one after it, and where the
    symbols of each begin and stop."""
    pad, end = bytes([END]) * BEFORE, bytes([END])
    data = np.frombuffer(b"".join(pad + t + end for t in texts), dtype=np.uint8)
    sizes = np.fromiter((len(t) + BEFORE + 1 for t in texts), dtype=np.int64, count=len(texts))
    stop = np.cumsum(sizes)
    return data, stop - sizes + BEFORE, stop


def _gaps(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13)) | (data == END)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return (np.cumprod(np.full(size, MULT, dtype=np.uint64)),
                np.cumprod(np.r_[np.uint64(1), np.full(size, INVERSE, dtype=np.uint64)]),
                np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64))


_USUAL_POWERS: list[tuple] = []  # of the slices that nearly all calls stay within


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of byte values times powers of an odd number, and the inverse powers."""
    if not _USUAL_POWERS:
        _USUAL_POWERS.append(_powers(2 * GROUP))
    up, down, value = _USUAL_POWERS[0] if len(data) <= 2 * GROUP else _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(value[data] * up[:len(data)], out=sums[1:])
    return sums, down


def _stir(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def scored_places(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    sizes = stop - start
    return np.repeat(start - np.cumsum(sizes, dtype=start.dtype) + sizes, sizes) + np.arange(sizes.sum(), dtype=start.dtype)


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``data``, one after the other; their places are listed slice by slice."""
    out, at = np.empty(int(size.sum()), data.dtype), 0
    for g in groups(size, GROUP):
        part = data[scored_places(start[g], start[g] + size[g])]
        out[at:at + len(part)] = part
        at += len(part)
    return out


@dataclass
class Units:
    """Distinct units, each with the bytes before it: sorted hashes, counts in training texts,
    and their bytes, one after the other."""

    keys: np.ndarray
    counts: np.ndarray
    size: np.ndarray
    data: np.ndarray

    @staticmethod
    def merged(parts: list[Units]) -> Units:
        parts = parts or [Units(np.zeros(0, np.uint64), *np.zeros((2, 0), np.int64), np.zeros(0, np.uint8))]
        keys, counts, size, data = (np.concatenate([getattr(u, f) for u in parts]) for f in (
            "keys", "counts", "size", "data"))
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        start = (np.cumsum(size) - size)[first]
        return Units(distinct, np.bincount(inverse, counts, len(distinct)).astype(np.int64), size[first],
                     gathered(data, start, size[first]))

    def slices(self, limit: int) -> Iterator[Units]:
        ends = np.r_[0, np.cumsum(self.size)]
        for g in groups(self.size, limit):
            yield Units(self.keys[g], self.counts[g], self.size[g], self.data[ends[g.start]:ends[g.stop]])

    def words(self) -> np.ndarray:
        """The 64-bit hash of every unit's word; 0 where it has none."""
        stop = np.cumsum(self.size)
        start, some = stop - self.size + BEFORE, self.size > BEFORE + 1
        return np.where(some, span_hashes(self.data, start, stop - 1) | np.uint64(1), np.uint64(0))

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Where every unit begins, after the bytes before it, and stops."""
        stop = np.cumsum(self.size)
        return stop - self.size + BEFORE, stop

    def contexts(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Every symbol of every unit and the keys of its contexts; their low 8 bits are free."""
        start, stop = self.spans()
        place = scored_places(start, stop)
        begin = np.repeat(start, stop - start)
        seen = place - begin + BEFORE
        back = np.zeros(len(place), np.uint64)
        for k in range(1, BACK + 1):
            byte = np.where(seen >= k, self.data[place - np.minimum(seen, k)], FAR).astype(np.uint64)
            back |= byte << np.uint64(8 * k)
        return self.data[place], [back, span_hashes(self.data, begin, place) >> np.uint64(1) & ~BYTE | np.uint64(1 << 63)]


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    sums, down = _sums(data)
    with np.errstate(over="ignore"):
        return _stir((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64))


def units_of(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' units: hash, first byte, end, and how many units each text has."""
    places = scored_places(start, stop)
    end = places[_gaps(data[places])] + 1
    count = np.diff(np.searchsorted(end, np.r_[start[:1], stop], "right")) if len(start) else start
    begin = np.r_[start[:1], end[:-1]] if len(end) else end
    begin[np.cumsum(count) - count] = start
    return span_hashes(data, begin - BEFORE, end), begin, end, count


@dataclass
class Code:
    """Huffman code of the symbols: where each code starts in ``node`` and ``bit``, its length."""

    first: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @staticmethod
    def of(freq: np.ndarray) -> Code:
        heap = [(int(f) + 1, s, s) for s, f in enumerate(freq)]
        heapq.heapify(heap)
        children = {}
        for inner in range(256, 511):
            (f, _, a), (g, _, b) = heapq.heappop(heap), heapq.heappop(heap)
            children[inner] = (a, b)
            heapq.heappush(heap, (f + g, inner, inner))
        paths, todo = {}, [(510, ())]
        while todo:
            at, path = todo.pop()
            if at < 256:
                paths[at] = path
            else:
                todo += [(c, (*path, (at - 256, bit))) for bit, c in enumerate(children[at])]
        length = np.array([len(paths[s]) for s in range(256)])
        flat = [step for s in range(256) for step in paths[s]]
        return Code(np.cumsum(length) - length, length, np.array([n for n, _ in flat], dtype=np.int32),
                    np.array([b for _, b in flat], dtype=np.int8))


@dataclass
class Found:
    """Places of keys in a list of distinct 64-bit keys, by a table of hashed places."""

    keys: np.ndarray
    places: np.ndarray
    order: np.ndarray
    ranked: np.ndarray

    @staticmethod
    def of(keys: np.ndarray) -> Found:
        order = np.argsort(keys)
        places = np.zeros(1 << PLACES, np.int32)
        places[Found._place(keys)] = np.arange(len(keys), dtype=np.int32)
        return Found(keys, places, order, keys[order])

    @staticmethod
    def _place(keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys ^ keys >> np.uint64(32)) * MULT >> np.uint64(64 - PLACES)).astype(np.int64)

    def at(self, wanted: np.ndarray) -> np.ndarray:
        """Where each key stands in the list; -1 where it does not."""
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int64)
        at = self.places[self._place(wanted)]
        other = np.flatnonzero(self.keys[at] != wanted)  # of two keys with one place, the first
        rank = np.minimum(np.searchsorted(self.ranked, wanted[other]), len(self.keys) - 1)
        at[other] = np.where(self.ranked[rank] == wanted[other], self.order[rank], -1)
        return at


@dataclass
class Predictions:
    """Quantised log-odds of a 1 at the nodes that each context has reached."""

    keys: Found
    first: np.ndarray
    size: np.ndarray
    node: np.ndarray
    odds: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, size: np.ndarray, node: np.ndarray, odds: np.ndarray) -> Predictions:
        size = size.astype(np.int64)
        return Predictions(Found.of(keys), np.cumsum(size) - size, size, node, odds)

    def table(self, keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """A table of 256 odds per context that occurs in ``keys``, first a row of zeros, and
        where the row of every key begins."""
        at = [self.keys.at(k) for k in keys]
        row = np.zeros(len(self.first) + 1, np.int64)  # the last one is for absent contexts
        for a in at:
            row[a[a >= 0]] = 1
        used = np.flatnonzero(row)
        row[used] = np.arange(1, len(used) + 1) * 256
        table = np.zeros((len(used) + 1) * 256, np.int8)
        size = self.size[used]
        entry = scored_places(self.first[used], self.first[used] + size)
        table[np.repeat(row[used], size) + self.node[entry]] = self.odds[entry]
        return table, [row[a] for a in at]


def odds_of(pairs: np.ndarray, counts: np.ndarray, code: Code) -> tuple[np.ndarray, ...]:
    """From sorted distinct pairs (context key with a symbol in its low bits) and their counts:
    the distinct keys, how many nodes each reached, those nodes and their log-odds."""
    context, symbol = pairs & ~BYTE, (pairs & BYTE).astype(np.int64)
    fresh = np.flatnonzero(np.r_[True, context[1:] != context[:-1]][:len(context)])
    ends, size, nodes, odds = np.r_[fresh, len(pairs)], [], [], []
    for a in range(0, len(fresh), 4096):
        rows = slice(ends[a], ends[min(a + 4096, len(fresh))])
        sym, n = symbol[rows], np.minimum(len(fresh) - a, 4096)
        owner = np.repeat(np.arange(n), np.diff(ends[a:a + n + 1]))
        length = code.length[sym]
        step = scored_places(code.first[sym], code.first[sym] + length)
        place = np.repeat(owner * 256, length) + code.node[step]
        weight, one = np.repeat(counts[rows], length).astype(float), code.bit[step] > 0
        ones, every = np.bincount(place[one], weight[one], n * 256), np.bincount(place, weight, n * 256)
        reached = np.flatnonzero(every)
        size.append(np.bincount(reached >> 8, minlength=n).astype(np.uint8))
        nodes.append((reached & 255).astype(np.uint8))
        ones, every = ones[reached], every[reached]
        odds.append(np.clip(np.round(np.log((ones + SMOOTH) / (every - ones + SMOOTH)) * SCALE), -127, 127).astype(np.int8))
    empty = np.zeros(0, np.uint8)
    return (context[fresh], np.concatenate([empty, *size]), np.concatenate([empty, *nodes]),
            np.concatenate([empty.astype(np.int8), *odds]))


@dataclass
class Coded:
    """The bits of distinct units: each the odds of the right bit by the two contexts and the
    gate, as four bytes (one is free)."""

    first: np.ndarray
    size: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(units: Units, known: Predictions, code: Code) -> Coded:
        size, at = np.zeros(len(units.size), np.int64), 0
        for part in units.slices(GROUP):
            symbols = part.data[scored_places(*part.spans())]
            size[at:at + len(part.size)] = np.add.reduceat(
                code.length[symbols], np.cumsum(part.size - BEFORE) - part.size + BEFORE)
            at += len(part.size)
        # the bits of all units are the largest array of a chunk: they are filled in, never copied
        bits, done = np.zeros((int(size.sum()), 4), np.int8), 0
        for part in units.slices(CODED):
            symbols, keys = part.contexts()
            table, rows = known.table(keys)
            n = code.length[symbols]
            step = scored_places(code.first[symbols].astype(np.int32), (code.first[symbols] + n).astype(np.int32))
            sign, node = code.bit[step] * np.int8(2) - np.int8(1), code.node[step]
            row = bits[done:done + len(step)]
            for k, r in enumerate(rows):
                np.multiply(table.take(np.repeat(r, n) + node), sign, out=row[:, k])
            state = (rows[1] > 0) * np.int8(STEPS)
            place = step - np.repeat(code.first[symbols].astype(np.int32), n)
            row[:, 3] = np.repeat(state, n) + np.minimum(place, STEPS - 1)
            done += len(step)
        return Coded(np.cumsum(size) - size, size, bits.view(np.uint32).ravel())


@dataclass
class Prefixes:
    """The bits that two units share from their start, by their first eight bytes."""

    head: np.ndarray
    bits: np.ndarray
    shared: np.ndarray

    @staticmethod
    def of(units: Units, code: Code) -> Prefixes:
        start = np.cumsum(units.size) - units.size + BEFORE
        size = units.size - BEFORE
        head, bits = np.zeros((8, len(size)), np.uint8), np.zeros((9, len(size)), np.int16)
        for k in range(8):
            has = size > k
            head[k, has] = units.data[start[has] + k]
            bits[k + 1] = bits[k] + np.where(has, code.length[head[k]], 0)
        paths = np.full((256, code.length.max()), 2, np.int8)
        for s in range(256):
            paths[s, :code.length[s]] = code.bit[code.first[s]:code.first[s] + code.length[s]]
        same = paths[:, None, :] == paths[None, :, :]
        return Prefixes(head, bits, np.minimum.accumulate(same, axis=2).sum(axis=2).astype(np.int32))

    def common(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits that are alike, and whether a bit that differs follows (not: nothing is told)."""
        out, alike = np.zeros(len(a), np.int64), np.ones(len(a), bool)
        for k in range(8):
            x, y = self.head[k, a], self.head[k, b]
            stops = alike & (x != y)
            out[stops] = self.bits[k, a[stops]] + self.shared[x[stops], y[stops]]
            alike &= x == y
        out[alike] = self.bits[8, a[alike]]
        return out, ~alike


def followed(unit: np.ndarray, doc: np.ndarray, n_units: int) -> tuple[np.ndarray, np.ndarray]:
    """Per unit of the texts, the one that came after the last same unit as the one before it
    (-1: none), and how many such guesses in a row came true just before."""
    n, guess = len(unit), np.full(len(unit), -1, np.int64)
    key = doc[:-1].astype(np.int64) * n_units + unit[:-1]
    order = np.argsort(key, kind="stable")  # places before the last, by (document, unit)
    same = np.flatnonzero((key[order[1:]] == key[order[:-1]]) & (doc[order[1:] + 1] == doc[order[1:]]))
    guess[order[same + 1] + 1] = unit[order[same] + 1]
    at = np.arange(n)
    miss = np.maximum.accumulate(np.where((guess == unit) & (np.r_[doc[1:], -1] == doc), -1, at))
    return guess, np.minimum(np.r_[0, (at - miss)[:-1]], RUN)


def score(unit: np.ndarray, count: np.ndarray, coded: Coded, prefixes: Prefixes) -> np.ndarray:
    """log10 probability of every text, given as its units; each refines its own weights.

    A block of every document is coded at once; the weights of a document move after its
    block, by the mean gradient of each gate.
    """
    n, offset = len(count), np.cumsum(count) - count
    guess, run = followed(unit, np.repeat(np.arange(n), count), len(coded.first))
    told = np.flatnonzero(guess >= 0)
    alike, differs = np.zeros(len(unit), np.int64), np.zeros(len(unit), bool)
    alike[told], differs[told] = prefixes.common(unit[told], guess[told])
    sure = (np.log(2 * np.arange(RUN + 1) + 1.6) * SCALE).astype(np.float32)
    weights = np.tile(np.repeat(np.array(START_WEIGHTS, np.float32).T, STEPS, axis=1), (1, n))
    z = np.arange(-EDGE * GRADES, EDGE * GRADES + 1) / GRADES
    loss, miss = np.log1p(np.exp(-z)), (1 / (1 + np.exp(z))).astype(np.float32)
    total, a, turn = np.zeros(n), 0, 1
    while a < count.max():
        b = BLOCKS[turn] if turn < len(BLOCKS) else a + BLOCKS[-1]
        docs = np.flatnonzero(count > a)
        units = np.minimum(count[docs], b) - a
        here = scored_places(offset[docs] + a, offset[docs] + a + units)
        which = unit[here]
        size = coded.size[which]
        bit = scored_places(coded.first[which], coded.first[which] + size)
        row = coded.bits.take(bit).view(np.int8).reshape(-1, 4)
        odds = [row[:, k].astype(np.float32) for k in range(2)]
        odds.append(np.zeros(len(bit), np.float32))
        at = np.cumsum(size) - size
        some = np.flatnonzero(guess[here] >= 0)
        force, same = sure[run[here[some]]], alike[here[some]]
        odds[2][scored_places(at[some], at[some] + same)] = np.repeat(force, same)
        turns = differs[here[some]]
        odds[2][(at[some] + same)[turns]] = -force[turns]
        first = np.cumsum(units) - units
        bits = np.add.reduceat(size, first)
        pick = row[:, 3] + np.repeat(docs * GATES, bits)
        right = np.zeros(len(bit), np.float32)
        for w, o in zip(weights, odds):
            right += w.take(pick) * o
        right *= np.float32(GRADES / SCALE)
        grade = np.rint(np.clip(right, -EDGE * GRADES, EDGE * GRADES)).astype(np.int32) + EDGE * GRADES
        total[docs] -= np.add.reduceat(loss.take(grade), np.cumsum(bits) - bits)
        if b < count.max():
            off, seen = miss.take(grade), np.bincount(pick, minlength=GATES * n) + 16
            for w, o in zip(weights, odds):
                w += RATE / SCALE * np.bincount(pick, off * o, GATES * n) / seen
        a, turn = b, turn + 1
    return total / np.log(10)


def groups(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Consecutive runs of about ``limit`` bytes, each text counted with 16 more."""
    ends, at = np.cumsum(np.asarray(sizes, np.int64) + 16), 0
    while at < len(ends):
        stop = min(int(np.searchsorted(ends, limit + (ends[at - 1] if at else 0))) + 1, len(ends))
        yield slice(at, stop)
        at = stop


def _texts(blob: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes)
    return [blob[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist())]


def packed(values: bytes | np.ndarray, rising: bool = False, level: int = 1) -> bytes:
    """Compressed; rising numbers by their differences, numbers by planes of their bytes."""
    if isinstance(values, np.ndarray):
        values = np.diff(values, prepend=values.dtype.type(0)) if rising else values
        values = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=level).compress(values)


def opened(blob: bytes, kind: type, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    values = np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if rising else values


def chunks(docs: DataFrame, folds: int, held_fold: int) -> DataFrame:
    """Documents packed into rows of about CHUNK bytes: chunk, blob, sizes, train, ids."""
    def pack(part: int, k: int, rows: list) -> dict:
        return {"chunk": [part << 24 | k], "blob": [packed(b"".join(t for t, _, _ in rows), level=3)], "sizes": [np.array(
            [len(t) for t, _, _ in rows], np.int64).tobytes()], "train": [np.array(
                [r[1] for r in rows], np.bool_).tobytes()], "ids": [[r[2] for r in rows]],
            "bytes": [sum(len(t) for t, _, _ in rows)], "n_train": [sum(bool(r[1]) for r in rows)], "freq": [np.bincount(np.frombuffer(b"".join(
                t for t, use, _ in rows if use), np.uint8), minlength=256)]}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, k, rows, size = TaskContext.get().partitionId(), 0, [], 0
        for pdf in batches:
            for text, train, doc_id in zip(pdf["text"], pdf["train"], pdf["doc_id"]):
                rows.append((text.encode("utf-8", "surrogatepass").lower(), train, doc_id))
                size += len(rows[-1][0]) + 16
                if size >= CHUNK:
                    yield pd.DataFrame(pack(part, k, rows))
                    k, rows, size = k + 1, [], 0
        if rows:
            yield pd.DataFrame(pack(part, k, rows))

    return materialize(docs.select(
        named("text"), (F.pmod(id_crc("doc_id"), F.lit(folds)) != held_fold).alias("train"),
        named("doc_id").cast("string").alias("doc_id")).mapInPandas(
        run, "chunk long, blob binary, sizes binary, train binary, ids array<string>, bytes long, n_train long, "
             "freq array<long>"), "cm-chunks")


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    key, count = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    return key[first], np.add.reduceat(count, first) if len(first) else count


def chunk_texts(blob: bytes, sizes: bytes) -> list[bytes]:
    return _texts(zstandard.ZstdDecompressor().decompress(blob), np.frombuffer(sizes, np.int64))


def chunk_units(texts: list[bytes], learn: np.ndarray) -> Units:
    """The distinct units of the texts with their counts in the training texts."""
    sizes, parts = np.array([len(t) for t in texts], np.int64), []
    for g in groups(sizes, GROUP):
        data, start, stop = layout(texts[g])
        keys, begin, end, count = units_of(data, start, stop)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        begin, end = begin[first] - BEFORE, end[first]
        parts.append(Units(distinct, np.bincount(inverse, np.repeat(learn[g], count), len(distinct)).astype(
            np.int64), end - begin, data[scored_places(begin, end)]))
    return Units.merged(parts)


def unit_counts(units: Units) -> tuple[tuple, np.ndarray, tuple]:
    """The pairs of context and symbol in training texts with counts, the contexts that only
    other texts hold, and all words with their counts in training texts."""
    pairs, others, words, room = ([], []), [], ([], []), GATHERED
    for part in units.slices(GROUP):
        symbols, keys = part.contexts()
        n = np.repeat(part.counts, part.size - BEFORE)
        use, symbols = n > 0, symbols.astype(np.uint64)
        for key in keys:
            found = _added([key[use] | symbols[use]], [n[use]])
            pairs[0].append(found[0])
            pairs[1].append(found[1])
            others.append(np.unique(key[~use]))
            room -= len(found[0])
        if room <= 0:
            pairs, room = tuple([x] for x in _added(*pairs)), GATHERED
        word = part.words()
        words[0].append(word[word > 0])
        words[1].append(part.counts[word > 0])
    pairs = _added(*pairs)
    other = np.setdiff1d(np.concatenate([np.zeros(0, np.uint64), *others]), pairs[0] & ~BYTE)
    return pairs, other, _added(*words)


def dealt(shards: int, keys: np.ndarray, *columns: np.ndarray) -> list[list[np.ndarray]]:
    """Each column in pieces, one per shard of its keys, in the order given."""
    with np.errstate(over="ignore"):
        shard = (_stir(keys) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(1, shards))
    return [np.split(c[order], cuts) for c in columns]


def corpus_counts(parts: DataFrame, shards: int) -> DataFrame:
    """(chunk, shard, keys, size, symbol, times, counts, v, n), a row per chunk and shard: the
    corpus counts (times) of the symbols of the chunk's contexts and of its words (sorted) in
    the shard; v and n, in one row of a shard, are its distinct and all training words.

    The chunk makes its predictions of the counts: they take less room than the predictions."""
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                (pairs, n), other, (words, counts) = unit_counts(chunk_units(
                    chunk_texts(r.blob, r.sizes), np.frombuffer(r.train, np.bool_)))
                pieces = zip(*dealt(shards, pairs & ~BYTE, pairs, n.astype(np.int32)), *dealt(shards, other, other),
                             *dealt(shards, words, words, counts.astype(np.int32)))
                rows = [(r.chunk, k, packed(p, True), packed(n), packed(o, True), packed(w, True), packed(c))
                        for k, (p, n, o, w, c) in enumerate(pieces) if len(p) + len(o) + len(w)]
                yield pd.DataFrame(rows, columns=["chunk", "shard", "pairs", "n", "other", "words", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        def column(name: str, kind: type, rising: bool = False) -> list[np.ndarray]:
            return [opened(x, kind, rising) for x in pdf[name]]

        sent, words = column("pairs", np.uint64, True), column("words", np.uint64, True)
        pairs, times = _added(sent, column("n", np.int32))
        context = pairs & ~BYTE
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]][:len(context)])
        keys, size = context[first], np.diff(np.r_[first, len(pairs)])
        every, total = _added(words, column("counts", np.int32))
        out = []
        for pair, other, word in zip(sent, column("other", np.uint64, True), words):
            mine = np.r_[pair & ~BYTE, other]
            at = np.searchsorted(keys, mine)
            at = np.unique(at[np.r_[keys, np.uint64(0)][at] == mine]) if len(keys) else at[:0]
            entry = scored_places(first[at], first[at] + size[at])
            out.append((packed(keys[at], True), packed(size[at].astype(np.uint8)),
                        packed((pairs[entry] & BYTE).astype(np.uint8)), packed(times[entry]),
                        packed(total[np.searchsorted(every, word)]), 0, 0))
        out = pd.DataFrame(out, columns=["keys", "size", "symbol", "times", "counts", "v", "n"])
        out.insert(0, "chunk", pdf["chunk"].to_numpy())
        out.insert(1, "shard", pdf["shard"].to_numpy())
        out.loc[0, ["v", "n"]] = [int((total > 0).sum()), int(total.sum())]
        return out

    return parts.select("chunk", "blob", "sizes", "train").mapInPandas(
        spread, "chunk long, shard long, pairs binary, n binary, other binary, words binary, counts binary"
    ).groupBy("shard").applyInPandas(
        add, "chunk long, shard long, keys binary, size binary, symbol binary, times binary, counts binary, "
             "v long, n long")


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 5,
              held_fold: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    parts = chunks(docs.select(named(id_col).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text")),
                   folds, held_fold)
    facts = parts.agg(F.count("*").alias("chunks"), F.sum("n_train").alias("docs"),
                      F.sum("bytes").alias("bytes")).first()
    train_docs = facts.docs or 0
    freq = np.zeros(256, np.int64)
    for r in parts.select(F.posexplode("freq")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        freq[r.pos] = r.n  # 256 rows at most
    freq[END] = train_docs
    code = Code.of(freq)
    shards = max(1, -(-(facts.bytes or 0) // SHARD), min(facts.chunks, SHARDS))
    counts = corpus_counts(parts, shards)

    def score_chunk(part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        def joined(name: str, kind: type, rising: bool = False) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *(opened(x, kind, rising) for x in found[name])])

        r, empty = part.iloc[0], np.zeros(0, np.uint64)  # a chunk is one row
        texts, learn, sizes = chunk_texts(r.blob, r.sizes), np.frombuffer(r.train, np.bool_), np.frombuffer(r.sizes, np.int64)
        units = chunk_units(texts, learn)

        def known() -> Predictions:
            return Predictions.of(*(np.concatenate(x) for x in zip(odds_of(empty, empty, code), *(
                odds_of(np.repeat(opened(r.keys, np.uint64, True), opened(r.size, np.uint8)) | opened(r.symbol, np.uint8),
                        opened(r.times, np.int64), code) for r in found.drop(columns="shard").itertuples(name="Row")))))

        # the predictions go once the units are coded, before the texts are scored
        coded, prefixes = Coded.of(units, known(), code), Prefixes.of(units, code)
        word = np.concatenate([np.zeros(0, np.uint64), *(u.words() for u in units.slices(GROUP))])
        distinct = np.unique(word[word > 0])
        pieces = dealt(shards, distinct, distinct)[0]
        words = np.concatenate([distinct[:0], *(pieces[k] for k in found["shard"])])
        c = np.r_[joined("counts", np.int64), 0][Found.of(words).at(word)]
        facts = np.array([word > 0, c > 0, np.where(word > 0, np.log10(c + 0.5), 0)])
        index, order = Found.of(units.keys), np.argsort(sizes, kind="stable")
        out = np.zeros((len(texts), 4))
        for g in groups(sizes[order], SCORED):
            at = order[g]
            keys, _, _, count = units_of(*layout([texts[i] for i in at]))
            unit = index.at(keys)
            out[at, :3] = np.add.reduceat(facts[:, unit], np.cumsum(count) - count, axis=1).T
            out[at, 3] = score(unit, count, coded, prefixes)
        out[:, :3] += [1, train_docs > 0, np.log10(train_docs + 0.5)]
        v, n = np.zeros((2, len(texts)), np.int64)
        v[0], n[0] = found["v"].sum(), found["n"].sum()  # every row of the counts reaches one chunk
        return pd.DataFrame({
            "doc_id": list(r.ids), "held_out": ~learn,
            "n_tokens": out[:, 0].astype(np.int64), "n_known": out[:, 1].astype(np.int64),
            "v": v, "n": n, "counts": out[:, 2], "score": out[:, 3],
            "bits_per_byte": -out[:, 3] * np.log2(10) / (sizes + 1)})

    # the corpus totals are needed in the end only: the counts are not written before they are sent
    scores = materialize(parts.select("chunk", "blob", "sizes", "train", "ids").groupBy("chunk").cogroup(
        counts.groupBy("chunk")).applyInPandas(
        score_chunk, "doc_id string, held_out boolean, n_tokens long, n_known long, v long, n long, "
                     "counts double, score double, bits_per_byte double"), "cm-scores")
    totals = scores.agg(F.sum("v").alias("v"), F.sum("n").alias("n")).first()
    v, n = (totals.v or 0) + (train_docs > 0), (totals.n or 0) + train_docs
    return scores.select(
        F.expr("try_cast(doc_id AS BIGINT)").alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("counts") - F.col("n_tokens") * math.log10(n + 0.5 * (v + 1))).alias("base_score"), "score", "bits_per_byte")
