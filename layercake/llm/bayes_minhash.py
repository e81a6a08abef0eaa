"""Operator 10: MinHash near-duplicates with sequential Bayesian verification.

Documents with equal shingle sets collapse to one node first.  Nodes meet in the buckets of
their signature bands.  A candidate pair is compared signature batch by signature batch and
dropped as soon as the posterior probability that its similarity reaches the threshold
falls under ``miss``; survivors are verified on their full sets.  Pairs are never expanded
within a group: first every node is compared with the smallest node of its buckets (the
one it shares most bands with, then the others for nodes still alone) and components are
joined; then only buckets that still hold different components are compared, in blocks of
bounded size: each node with its nearest survivor of another component, at last all survivors
between the components that are left.  These last comparisons carry the full sets with them,
each pair in the first band it shares, so that only links leave a block.

Edge cases: NULL, empty and word-free texts have an empty set and are linked with nothing;
texts with fewer words than a shingle are one shingle; repeated rows and ids share a node;
a NULL id never names a component unless all its ids are NULL; empty tables give empty
results; extra columns are ignored or carried.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..names import col as named
from .common import keep_columns, materialize, row_key, sifted

BANDS, ROWS = 30, 5
#: Signature values compared per step of the sequential test.
BATCH = 25
#: Members of one side of a block comparison, and bytes of their full sets.
BLOCK, BLOCK_BYTES = 1024, 2**23
#: Members of small buckets that are compared in one group of rows, and bytes of their full sets.
GROUP_ROWS, GROUP_BYTES = 4096, 2**24
#: Words whose hashes a worker remembers, texts it holds as Python objects at once.
REMEMBERED, SLICE = 100_000, 256


def hash64(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def words_of(text: str | None) -> bytes:
    """The words, A-Z lower-cased, in UTF-8 and joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def shingle_set(text: str | bytes | None, k: int, known: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of a text or its ``words_of``."""
    words = (text if isinstance(text, bytes) else words_of(text)).split()
    if not words:
        return np.empty(0, np.uint64)
    known = {} if known is None else known
    if len(known) > REMEMBERED:
        known.clear()
    for w in set(words).difference(known):
        known[w] = hash64(w)
    h = np.array([known[w] for w in words], dtype=np.uint64)
    n = max(len(h) - k + 1, 1)
    out = np.full(n, len(h) if len(h) < k else k, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(k, len(h))):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(out)


def node_of(items: np.ndarray) -> int | None:
    """A 64-bit name of the set; None for the empty one."""
    if not len(items):
        return None
    return int.from_bytes(hashlib.blake2b(items.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(items: np.ndarray, size: int) -> np.ndarray:
    """The smallest value under each of ``size`` multiply-shift hashes."""
    rng = np.random.default_rng(7)
    mult = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, size, dtype=np.uint64)
    best = np.full(size, 2**32 - 1, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(items), 512):
            part = _mix(items[at:at + 512])
            values = ((part[:, None] * mult + add) >> np.uint64(32)).astype(np.uint32)
            best = np.minimum(best, values.min(axis=0))
    return best


def prune_table(threshold: float, miss: float, size: int, batch: int) -> list[int]:
    """Fewest matches after each batch for which P(similarity >= threshold | matches) > miss,
    under a uniform prior (a Beta posterior)."""
    grid = (np.arange(4000) + 0.5) / 4000
    least = []
    for n in range(batch, size + 1, batch):
        low, high = 0, n
        while low < high:
            m = (low + high) // 2
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            p = np.exp(log - log.max())
            if p[grid >= threshold].sum() / p.sum() > miss:
                high = m
            else:
                low = m + 1
        least.append(low)
    return least


def survives(a: np.ndarray, b: np.ndarray, least: list[int], batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the row pairs of two signature matrices that pass every batch, and their matches."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int32)
    for k, need in enumerate(least):
        cut = slice(k * batch, (k + 1) * batch)
        matches = matches + (a[alive, cut] == b[alive, cut]).sum(axis=1)
        keep = matches >= need
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive, matches


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """key, doc_id, node (a hash of the set, NULL for empty sets), n_shingles, sig."""
    size = BANDS * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part, found, seen = batch.slice(at, SLICE), [], {}
                for text in part.column("text").to_pylist():
                    if text not in seen:
                        s = shingle_set(text, k, known)
                        seen[text] = (node_of(s), len(s), signature(s, size).tobytes() if len(s) else None)
                    found.append(seen[text])
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("doc_id"), *(
                    pa.array(x, kind) for x, kind in zip(zip(*found), (pa.int64(), pa.int64(), pa.binary())))],
                    ["key", "doc_id", "node", "n_shingles", "sig"])
            batch = part = None
            pa.default_memory_pool().release_unused()  # else idle workers keep it

    # batches are taken slice by slice, as Arrow: a frame of all texts would hold each of them again
    return docs.select("key", "doc_id", "text").mapInArrow(
        run, "key long, doc_id long, node long, n_shingles long, sig binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) with the smallest node reachable, by repeated neighbour minima.

    Each round points every label at the smallest label among its neighbours and shortcuts
    the pointers once, then rewrites the edges between labels; rounds end when none is left.
    """
    pairs = materialize(edges.select("a", "b").filter("a <> b").distinct(), f"{name}-cc")
    labels = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
                         .withColumn("label", F.col("node")), f"{name}-cc-labels")
    while not pairs.isEmpty():
        both = pairs.union(pairs.select("b", "a"))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("to"))
        up = materialize(up, f"{name}-cc-up")
        top = materialize(up.alias("x").join(up.alias("y"), F.col("x.to") == F.col("y.node")).select(
            F.col("x.node").alias("from"), F.least("x.to", "y.to").alias("to")), f"{name}-cc-top")
        labels = materialize(labels.join(top, F.col("label") == F.col("from"), "left").select(
            "node", F.coalesce("to", "label").alias("label")), f"{name}-cc-labels")
        left, right = top.select(F.col("from").alias("a"), F.col("to").alias("la")), top.select(
            F.col("from").alias("b"), F.col("to").alias("lb"))
        pairs = materialize(pairs.join(left, "a").join(right, "b").filter("la <> lb").select(
            F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), f"{name}-cc")
    return labels


def _screen(pairs: DataFrame, sigs: DataFrame, least: list[int]) -> DataFrame:
    """The candidate pairs (a, b) that pass the sequential test."""
    joined = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(
        sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.iloc[survives(_matrix(pdf["sa"]), _matrix(pdf["sb"]), least, BATCH)[0]][["a", "b"]]

    return joined.mapInPandas(run, "a long, b long")


def _matrix(sigs: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), dtype=np.uint32).reshape(len(sigs), -1)


def whole_words(docs: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """(node, items): the words of a document of each wanted node (node, key), compressed; they
    take less room than the shingle sets, which are made of them where they are compared."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(
                    [packer.compress(words_of(t)) for t in part.column("text").to_pylist()], pa.binary())], ["key", "items"])

    held = sifted(docs.select("key", "text"), "key", wanted.select("key")).mapInArrow(pack, "key long, items binary")
    return materialize(held.dropDuplicates(["key"]).join(wanted, "key").select("node", "items"), name)


class Sets:
    """The full shingle sets of packed words, each made once while it is held."""

    def __init__(self, k: int, most: int = 2**25) -> None:
        self.k, self.most, self.size = k, most, 0
        self.known: dict[bytes, int] = {}
        self.held: dict[bytes, np.ndarray] = {}
        self.unpacker = zstandard.ZstdDecompressor()

    def of(self, packed: bytes) -> np.ndarray:
        found = self.held.get(packed)
        if found is None:
            if self.size > self.most:
                self.held.clear()
                self.size = 0
            found = self.held[packed] = shingle_set(self.unpacker.decompress(packed), self.k, self.known)
            self.size += found.nbytes + len(packed)
        return found


def similar(p: np.ndarray, q: np.ndarray, threshold: int) -> bool:
    """Whether 100 * intersection >= threshold * union of two full sets."""
    if 100 * min(len(p), len(q)) < threshold * max(len(p), len(q)):
        return False
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= threshold * (len(p) + len(q) - both)


def _of_nodes(full: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """The rows of ``full`` that belong to ``nodes``."""
    return full.join(materialize(nodes.select("node").distinct(), f"{name}-needed"), "node", "left_semi")


def _verify(pairs: DataFrame, full: DataFrame, k: int, threshold: int, name: str) -> DataFrame:
    """The pairs that are similar on their full sets; no other sets are moved."""
    full = _of_nodes(full, pairs.select(F.explode(F.array("a", "b")).alias("node")), name)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Sets(k)
        for pdf in batches:
            ok = [similar(sets.of(x), sets.of(y), threshold) for x, y in zip(pdf["x"], pdf["y"])]
            yield pdf.loc[ok, ["a", "b"]]

    return materialize(
        pairs.join(full.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
        .join(full.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
        .select("a", "b", "x", "y").mapInPandas(check, "a long, b long"), f"{name}-links")


def _blocks(members: DataFrame, groups: int) -> DataFrame:
    """The members in every group of rows (grp) in which they are compared.

    ``members``: bucket, node, blocks (how many blocks the bucket is cut into) and what the
    comparison needs.  Every member goes to the parts (its block, any block); a part holds
    about two blocks however large its bucket is.  Buckets of one block share ``groups``
    groups.
    """
    spread = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.withColumn("part", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")))
    return spread.withColumn("grp", F.when(F.col("blocks") == 1, F.pmod("bucket", F.lit(groups))).otherwise(
        F.col("part"))).drop("blocks", "other")


def _parts(pdf: pd.DataFrame, *columns: str) -> Iterator[list[np.ndarray]]:
    """node, label, own, signature and ``columns`` of each part that holds different labels."""
    pdf = pdf.sort_values(["part", "node"])
    held = [pdf[c].to_numpy() for c in ("node", "label", "own")] + [_matrix(pdf["sig"])]
    held += [pdf[c].to_numpy() for c in columns]
    edges = np.flatnonzero(np.diff(pdf["part"].to_numpy())) + 1
    for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(pdf)]):
        if (held[1][lo:hi] != held[1][lo]).any():
            yield [h[lo:hi] for h in held]


def _met(node: np.ndarray, label: np.ndarray, own: np.ndarray, r: int, later: bool) -> np.ndarray:
    """Rows of other labels that row ``r`` is compared with; with ``later`` every pair once."""
    other, within = label != label[r], (own == own[0]).all()
    if later:
        other &= node > node[r] if within else own > own[r]
    elif not within:
        other &= own != own[r]
    return np.flatnonzero(other)


def _first_met(sig: np.ndarray, r: int, c: np.ndarray, band: int) -> np.ndarray:
    """Which of the rows ``c`` share ``band`` with row ``r`` and none before it."""
    same = (sig[c] == sig[r]).reshape(len(c), BANDS, ROWS).all(axis=2)
    return np.flatnonzero(same.argmax(axis=1) == band)


def _nearest(members: DataFrame, least: list[int], groups: int) -> DataFrame:
    """(bucket, node, a, b, matches): a node's surviving pair with most matches among other
    labels, per bucket and part in which it has one.  A pair counts in the first band it shares:
    however many buckets two nodes meet in, one of them has rows for it."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for node, label, own, sig, bucket, band in _parts(pdf, "bucket", "band"):
            for r in range(len(node)):
                c = _met(node, label, own, r, later=False)
                alive, m = survives(np.broadcast_to(sig[r], (len(c), sig.shape[1])), sig[c], least, BATCH)
                mine = _first_met(sig, r, c[alive], band[0])
                if len(mine):
                    x = mine[np.argmax(m[mine])]
                    y = node[c[alive[x]]]
                    out.append((bucket[r], node[r], min(node[r], y), max(node[r], y), m[x]))
        return pd.DataFrame(out, columns=["bucket", "node", "a", "b", "matches"], dtype="int64")

    return _blocks(members, groups).groupBy("grp").applyInPandas(
        run, "bucket long, node long, a long, b long, matches long")


def _between(members: DataFrame, least: list[int], k: int, threshold: int, groups: int) -> DataFrame:
    """(a, b): links that join labels, from all surviving pairs verified on their full sets
    (made of items) where they meet.  A pair is left to the first band it shares (band), and goes
    unverified only if links of the same part have joined its labels before."""
    def top(joined: dict[int, int], x: int) -> int:
        while x in joined:
            x = joined[x]
        return x

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, sets = [], Sets(k)
        for node, label, own, sig, items, band in _parts(pdf, "items", "band"):
            joined: dict[int, int] = {}
            for r in range(len(node)):
                c = _met(node, label, own, r, later=True)
                alive, m = survives(np.broadcast_to(sig[r], (len(c), sig.shape[1])), sig[c], least, BATCH)
                c = c[alive]
                mine = _first_met(sig, r, c, band[0])
                for y in c[mine[np.argsort(-m[mine], kind="stable")]]:
                    p, q = top(joined, label[r]), top(joined, label[y])
                    if p != q and similar(sets.of(items[r]), sets.of(items[y]), threshold):
                        joined[max(p, q)] = min(p, q)
                        out.append((node[r], node[y]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return _blocks(members, groups).groupBy("grp").applyInPandas(run, "a long, b long")


def _mixed(marked: DataFrame, nodes: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The members, with their signatures, of buckets that hold different labels, and how many
    groups the small buckets share (0: no such bucket).  Of buckets with the same members only
    that of the first band stays: the others would compare the same pairs again."""
    held = marked.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"), F.min("band").alias("band"),
        F.sum(F.col("n_shingles") * 8).alias("bytes"), F.bit_xor(F.xxhash64("node")).alias("members"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("members2")).filter("lo <> hi")
    once = held.groupBy("n", "bytes", "members", "members2").agg(F.min(F.struct("band", "bucket")).alias("first"))
    mixed = materialize(once.select("first.bucket", "n", "bytes", F.ceil(
        F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).alias("blocks")), name)
    rows, held = mixed.agg(F.sum("n"), F.sum("bytes")).first()
    met = marked.drop("n_shingles").join(mixed.select("bucket", "blocks"), "bucket").join(
        nodes, "node")
    return met, math.ceil(max((rows or 0) / GROUP_ROWS, (held or 0) / GROUP_BYTES))


def link(sigs: DataFrame, docs: DataFrame, *, k: int, threshold: int, miss: float, name: str) -> DataFrame:
    """(node, label): the component of every node that is linked with another one."""
    least = prune_table(threshold / 100, miss, BANDS * ROWS, BATCH)
    width = ROWS * 4
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring(F.hex("sig"), b * (2 * width) + 1, F.lit(2 * width))))
    in_bucket = sigs.filter("node IS NOT NULL").select("node", "n_shingles", F.posexplode(bands).alias("band", "bucket"))
    crowded = materialize(in_bucket.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
                          .filter("low < high").select("bucket", "low"), f"{name}-buckets")
    # nearly all rows of buckets, signatures and texts that meet no other stay where they are
    member = materialize(sifted(in_bucket, "bucket", crowded.select("bucket")).distinct().join(crowded, "bucket").select(
        "bucket", "band", "node", "n_shingles", "low"), f"{name}-members")
    wanted = materialize(sigs.select("node", "key").join(member.select("node").distinct(), "node", "left_semi").groupBy(
        "node").agg(F.min("key").alias("key")), f"{name}-wanted")
    nodes = materialize(sifted(sigs.select("node", "key", "sig"), "key", wanted.select("key")).dropDuplicates(
        ["key"]).join(wanted.select("key"), "key", "left_semi").select("node", "sig"), f"{name}-met")
    full = whole_words(docs, wanted, f"{name}-sets")
    # one link per node is enough to join a group: first with the centre (the smallest node of a
    # bucket) that it shares most bands with, then with any other centre for nodes still alone
    shared = materialize(member.filter("node <> low").groupBy(F.col("low").alias("a"), F.col("node").alias("b")).agg(
        F.count("*").alias("bands")), f"{name}-star")
    best = shared.groupBy("b").agg(F.max_by("a", F.struct("bands", -F.col("a"))).alias("a")).select("a", "b")
    linked = _verify(materialize(_screen(best, nodes, least), f"{name}-best"), full, k, threshold, f"{name}-a")
    alone = shared.select("a", "b").join(linked.select("b"), "b", "left_anti").select("a", "b")
    rest = materialize(_screen(alone, nodes, least).groupBy("b").agg(F.min("a").alias("a")).select("a", "b"),
                       f"{name}-first")
    linked = materialize(linked.union(_verify(rest, full, k, threshold, f"{name}-a2")), f"{name}-linked")
    # then every node's nearest node of another component; then all that still differ
    for turn, nearest in enumerate((True, False)):
        label = components(linked, f"{name}-{turn}")
        marked = member.join(label, "node", "left").select(
            "bucket", "band", "node", "n_shingles", F.coalesce("label", "node").alias("label"))
        met, groups = _mixed(marked, nodes, f"{name}-mixed")
        if not groups:
            break
        found = _nearest(met, least, groups)
        if nearest:
            best = found.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("matches", "a", "b")).alias("s"))
            found = _verify(materialize(best.select("s.a", "s.b").distinct(), f"{name}-cross"), full, k, threshold,
                            f"{name}-b{turn}")
        else:
            # only members with a surviving pair take their full sets along
            open_ = materialize(found.select("bucket", "node").distinct(), f"{name}-open")
            met, groups = _mixed(marked.join(open_, ["bucket", "node"], "left_semi"), nodes, f"{name}-open-mixed")
            if not groups:
                break
            found = _between(met.join(_of_nodes(full, open_, name), "node"), least, k, threshold, groups)
        linked = materialize(linked.union(found), f"{name}-linked")
    return components(linked, f"{name}-end")


def _grouped(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
             threshold: int = 80, miss: float = 1e-5, name: str = "near") -> DataFrame:
    """doc_id, key, n_shingles, node and class (NULL for an empty set) of every row."""
    picked = docs.select(row_key(id_col, text_col).alias("key"), named(id_col).try_cast("long").alias("doc_id"),
                         named(text_col).alias("text"))
    sigs = materialize(signatures(picked, shingle_words), f"{name}-signatures")
    label = link(sigs, picked, k=shingle_words, threshold=threshold, miss=miss, name=name)
    return sigs.select("doc_id", "key", "n_shingles", "node").join(label, "node", "left").withColumn(
        "class", F.coalesce("label", "node"))


def near_duplicates(docs: DataFrame, *, name: str = "near", **options) -> DataFrame:
    """doc_id, n_shingles, node, component_id (smallest id of the component), kept."""
    owner = _grouped(docs, name=name, **options)
    smallest = materialize(owner.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("n")), f"{name}-classes")
    joined = owner.join(smallest.filter("n > 1").drop("n"), "class", "left")
    component = F.coalesce("first_id", "doc_id")
    return joined.select("doc_id", "n_shingles", "node", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", name: str = "near",
             **options) -> DataFrame:
    """Exactly one row of each group of near copies, with its own columns.

    It is the row of the smallest (id, key of id and text); ids that are NULL or no whole
    number come last.  Of rows with equal id and text the one whose columns come first as
    JSON stays.  Rows without words are in no group and all stay.
    """
    owner = _grouped(docs, id_col=id_col, text_col=text_col, name=name, **options).filter("class IS NOT NULL")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    first = materialize(owner.groupBy("class").agg(F.min(row).alias("best"), F.count("*").alias("n"))
                        .filter("n > 1").drop("n"), f"{name}-first-rows")
    marks = materialize(owner.join(first, "class").groupBy(
        F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), (row == F.col("best")).alias("stays")).agg(
        F.count("*").alias("n")).filter("NOT stays OR n > 1").drop("n"), f"{name}-marks")
    rows = docs.select(keep_columns(docs), named(id_col).try_cast("long").alias("id"),
                       F.when(named(text_col).isNotNull(), row_key(id_col, text_col)).alias("key"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    kept = rows.join(marks, same, "left_anti").select("row")
    repeated = marks.filter("stays")
    if not repeated.isEmpty():
        kept = kept.union(rows.join(repeated, same).groupBy("id", "key").agg(
            F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    return kept.select("row.*")
