"""Operator 6: byte-level BPE token counts by rank-synchronous merging of ragged arrays.

Pre-tokens of a batch are held as one flat array of symbol ids with a sequence number per
symbol.  In every step each sequence applies its lowest-rank pair at all its places at once
(left to right where places overlap); the symbols that survive are counted.  A long
pre-token keeps its places by rank instead, in linked arrays, so that a step touches the
places of its rank only and not the whole sequence again.

Edge cases: NULL and empty texts have no bytes and no tokens; special strings inside a text
are one token each; very long pre-tokens are merged like any other; repeated rows are
counted each; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..names import col as named

#: Distinct pre-tokens whose counts a task remembers; symbols merged at once; characters per step.
KNOWN, MERGE_SYMBOLS, STEP_CHARS = 400_000, 2_000_000, 1_000_000
#: Bytes from which a pre-token is merged by itself, with its places held by rank.
LONG = 256
#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The vocabulary's printable character of every byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Merge ranks of a vocabulary file as sorted arrays."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        vocab = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.rank_of: dict[int, int] = {}
        self.first = np.zeros(256, dtype=np.int64)
        for char, byte in byte_symbols().items():
            self.first[byte] = vocab[char]
        special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
                                     ) if special else None
        self.words = regex.compile(PATTERN)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of every pair; ``len(self.keys)`` where the pair has none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def lengths(self, tokens: list[bytes]) -> np.ndarray:
        """The number of symbols that survive in every pre-token."""
        out = np.zeros(len(tokens), dtype=np.int64)
        long = np.fromiter((len(t) >= LONG for t in tokens), dtype=bool, count=len(tokens))
        for i in np.flatnonzero(long):
            out[i] = self.long_length(tokens[i])
        short = np.flatnonzero(~long)
        out[short] = self.short_lengths([tokens[i] for i in short])
        return out

    def long_length(self, token: bytes) -> int:
        """The same for one long pre-token, in time that follows its length: places wait
        under their pair's rank, and a merge looks at its two neighbours only."""
        if not self.rank_of:
            self.rank_of = dict(zip(self.keys.tolist(), self.rank.tolist()))
        rank_of, size, result = self.rank_of, self.size, self.result
        first = self.first[np.frombuffer(token, dtype=np.uint8)]
        n = left = len(first)
        ids, after, before = array("q", first.tolist()), array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        rank = self.ranks(first[:-1], first[1:])
        order = np.argsort(rank, kind="stable")
        order = order[: np.searchsorted(rank[order], len(self.keys))]
        edges = np.r_[0, np.flatnonzero(np.diff(rank[order])) + 1, len(order)]
        places = {int(rank[order[lo]]): order[lo:hi].tolist() for lo, hi in zip(edges, edges[1:]) if lo < hi}
        queue = sorted(places)
        while queue:
            now = heapq.heappop(queue)
            made = int(result[now])
            for i in sorted(places.pop(now)):
                j = after[i]
                # gone (-1), at the end, or changed since the place was noted
                if ids[i] < 0 or j == n or rank_of.get(ids[i] * size + ids[j]) != now:
                    continue
                k = after[j]
                ids[i], ids[j], after[i] = made, -1, k
                left -= 1
                fresh = []
                if k < n:
                    before[k] = i
                    fresh.append((i, made * size + ids[k]))
                h = before[i]
                if h >= 0:
                    fresh.append((h, ids[h] * size + made))
                for at, key in fresh:
                    then = rank_of.get(key)
                    if then is None:
                        continue
                    if then not in places:
                        places[then] = []
                        heapq.heappush(queue, then)
                    places[then].append(at)
        return left

    def short_lengths(self, tokens: list[bytes]) -> np.ndarray:
        """The same for many pre-tokens at once, as one ragged array."""
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        ids = self.first[np.frombuffer(b"".join(tokens), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(tokens)), sizes)
        done = np.ones(len(tokens), dtype=np.int64) * 0
        none = len(self.keys)
        while len(ids):
            joint = seq[1:] == seq[:-1]
            rank = np.full(len(ids), none, dtype=np.int64)
            rank[:-1][joint] = self.ranks(ids[:-1][joint], ids[1:][joint])
            starts = np.flatnonzero(np.r_[True, ~joint])
            least = np.minimum.reduceat(rank, starts)
            count = np.diff(np.r_[starts, len(ids)])
            finished = least == none
            done[seq[starts[finished]]] = count[finished]
            hit = (rank == np.repeat(least, count)) & (rank < none)
            # in a run of neighbouring places every second one is free
            run = np.flatnonzero(hit)
            if len(run):
                head = np.r_[True, np.diff(run) > 1]
                begin = run[head][np.cumsum(head) - 1]
                run = run[(run - begin) % 2 == 0]
            ids[run] = self.result[rank[run]]
            keep = ~np.repeat(finished, count)
            keep[run + 1] = False
            ids, seq = ids[keep], seq[keep]
        return done


def _count(merges: Merges, texts: list[str], known: dict[str, int]) -> list[int]:
    """Tokens of every text; learns the pre-tokens that it has not met."""
    out, cut = [], []
    for text in texts:
        parts = merges.special.split(text) if merges.special else [text]
        cut.append((len(parts) - 1, [w for p in parts for w in merges.words.findall(p)]))
    fresh = list({w for _, ws in cut for w in ws}.difference(known))
    at = 0
    while at < len(fresh):
        end, room = at, MERGE_SYMBOLS
        while end < len(fresh) and (end == at or room > 0):
            room -= 4 * len(fresh[end])
            end += 1
        part = fresh[at:end]
        known.update(zip(part, merges.lengths([w.encode("utf-8", "surrogatepass") for w in part]).tolist()))
        at = end
    for extra, ws in cut:
        out.append(extra + sum(map(known.__getitem__, ws)))
    return out


def count_tokens(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit under the vocabulary file (a path on the driver;
    its content, of a fixed size, is sent to the tasks)."""
    with open(vocabulary, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merges, known = None, {}
        for pdf in batches:
            merges = merges or Merges(content.value)
            texts, counts, at = list(pdf["text"]), [], 0
            while at < len(texts):
                end, room = at, STEP_CHARS
                while end < len(texts) and (end == at or room > 0):
                    room -= len(texts[end])
                    end += 1
                if len(known) > KNOWN:
                    known.clear()
                counts += _count(merges, texts[at:end], known)
                at = end
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": pdf["n_bytes"], "n_tokens": counts})

    text = F.coalesce(named(text_col), F.lit(""))
    counted = docs.select(named(id_col).cast("string").alias("doc_id"), text.alias("text"),
                          F.octet_length(text).cast("long").alias("n_bytes")).mapInPandas(
        run, "doc_id string, n_bytes long, n_tokens long")
    return counted.select(F.col("doc_id").cast("long"), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
