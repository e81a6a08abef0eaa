"""Conversation repair, phrase automata and ranked search against brute force and on odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from layercake.llm import norm_buckets, phrase_automata, queries, turn_repair

SPACES = r"[\x20\x09-\x0D]"


# -- op 11
def all_repairs(rows, most):
    """Every edit sequence of (initial, fault) rows with at most ``most`` insertions: (cost, audit)."""
    def step(i, left, cost, audit, out):
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            yield cost, audit
        if left:
            for role in "ua":
                yield from step(i, left - 1, cost + 3, audit + "I", out + role)
        if i < len(rows):
            initial, fault = rows[i]
            yield from step(i + 1, left, cost + 4, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                if initial:
                    yield from step(i + 1, left, cost + more, audit + "K", out + initial)
                for role in "ua":
                    yield from step(i + 1, left, cost + 3 + more, audit + "R", out + role)
    return step(0, most, 0, "", "")


def test_least_integer_is_the_cheapest_and_then_ascii_least():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice(["s", "u", "a", "a", "u", "t", "", " "]), rng.choice(["", "", "", "truncated", "blank", "duplicate"]))
                for _ in range(rng.randrange(5))]
        assert turn_repair.decide(*turn_repair.solve(rows)) == min(all_repairs(rows, 4)), rows


def test_stretches_join_to_the_whole():
    rng = random.Random(6)
    rows = [(rng.choice("sua"), rng.choice(["", "", "truncated", "duplicate"])) for _ in range(60)]
    whole = turn_repair.decide(*turn_repair.solve(rows))
    for size in (1, 7, 59):
        parts = [turn_repair.solve(rows[i:i + size]) for i in range(0, 60, size)]
        assert turn_repair.decide(*turn_repair.join_all(parts)) == whole


def test_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "STRETCH", 2)
    rows = [(1, 0, "user", "hi."), (1, 1, "assistant", "yo."), (1, 1, "assistant", "yo."), (1, 5, "user", "cut"),
            (2, None, None, None), (None, 3, "user", "a."), (None, 4, "assistant", "b!"), (3, 0, "", " \t"),
            (4, 0, "system", "s."), (4, 1, "assistant", "x" * 70000 + "?")]
    rows = [r + ("clash",) for r in rows]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
    got = {r.conv_id: r for r in turn_repair.repair_report(df).collect()}

    def sha(*lines):
        return hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert tuple(got[1])[1:] == (3, 0, 1, 1, 0 + 1, 8, "KKDD", sha("user:hi.", "assistant:yo."))
    assert tuple(got[2])[1:] == (0, 1, 0, 0, 0, 4, "D", sha(""))
    assert tuple(got[None])[1:] == (0, 0, 0, 0, 0, 0, "KK", sha("user:a.", "assistant:b!"))
    assert tuple(got[3])[1:] == (0, 1, 0, 0, 0, 4, "D", sha(""))
    assert got[4].audit == "KIK" and got[4].cost == 3 and got[4].illegal == 1
    _, judged, found = turn_repair.repair(df)
    turns = [(r.place, r.role) for r in turn_repair.repaired_turns(judged, found).filter("key = '=4'").orderBy("place").collect()]
    assert turns == [(0, "system"), (1, "user"), (2, "assistant")]
    assert turn_repair.repair_report(df.limit(0)).count() == 0
    assert turn_repair.repair_report(df.limit(0), damage=True).count() == 0


def test_long_conversation_spans_tasks(spark):
    rng = random.Random(7)
    rows = [(9, t, rng.choice(["user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"{t}!"])) for t in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = turn_repair.repair_report(df).first()
    seen, codes = set(), []
    for _, _, role, text in rows:
        codes.append((role[0], "blank" if not text else "duplicate" if (role, text) in seen else "" if text[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    assert (r.cost, r.audit) == turn_repair.decide(*turn_repair.solve(codes))


# -- op 12
def brute_strip(rows):
    """(id, text) in document order -> kept words and counts."""
    seen, out = set(), []
    for _, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            x = tuple(w[i:i + 20])
            if x in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(x)
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def mixed_texts(seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(9)) for _ in range(rng.randrange(15, 60))) for _ in range(8)]
    texts = [" \t".join(rng.choice(base) if rng.random() < 0.6 else "".join(rng.choices("xyz ", k=80)) for _ in range(rng.randrange(1, 5)))
             for _ in range(60)]
    return texts + ["w " * 500, "w " * 400, "a b " * 60, base[0], base[0], None, "", " \n", "É é " * 30, "one two"]


@pytest.mark.parametrize("hot", [5000, 2])
def test_repeated_windows(spark, monkeypatch, hot):
    monkeypatch.setattr(phrase_automata, "HOT", hot)
    monkeypatch.setattr(phrase_automata, "SHARD_WORDS", 500)
    rows = [(i, t, "clash") for i, t in enumerate(mixed_texts(hot))]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = {r.row.doc_id: (r.n_words, r.n_removed, r.kept) for r in phrase_automata.strip_repeats(df).collect()}
    assert [got[i] for i, *_ in rows] == brute_strip([r[:2] for r in rows])


def test_words_of_a_buffer(monkeypatch):
    monkeypatch.setattr(phrase_automata, "CHUNK", 16)
    texts = ["one two\tthree " + "x" * 100 + " four", None, "", " \n", "x" * 100, "é two one", "y" * 15 + " z"]
    data, begin, end, hashes, ends = phrase_automata._words(texts, phrase_automata._powers())
    words = [data[a:b] for a, b in zip(begin, end)]
    assert words == [w for t in texts for w in (t or "").encode().split()]
    assert list(ends) == [5, 5, 5, 5, 6, 9, 11]
    assert hashes[0] == hashes[8] and hashes[1] == hashes[7] and len(set(hashes)) >= 8
    assert len(phrase_automata._words([], phrase_automata._powers())[1]) == 0


def test_odd_phrase_rows(spark, odd_docs, no_docs):
    got = phrase_automata.strip_repeats(odd_docs, digest=True)
    assert got.count() == 9
    assert {r.row.doc_id: r.n_removed for r in got.collect()}[6] == 29999
    assert phrase_automata.strip_repeats(no_docs).count() == 0
    text = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([("b", text), ("a", text), (None, text), ("a", text), (None, "w0 w1")], "doc_id string, text string")
    assert sorted((r.row.doc_id or "", r.n_removed) for r in phrase_automata.strip_repeats(df).collect()) == [
        ("", 0), ("", 25), ("a", 0), ("a", 0), ("b", 25)]


# -- op 13
def brute_search(docs, items, k=50):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def cut(t):
        return term.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
    bags = [(i, collections.Counter(cut(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n, total, df = sum(x > 0 for x in sizes), sum(sizes), collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for (i, b), size in zip(bags, sizes):
            m = 50 + (50 * size * n) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m))
                    for t in set(cut(text)) if t in b)
            if s > 0:
                found.append((-s, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket,focus", [(4096, 12), (3, 1)])
def test_search_against_all_scores(spark, monkeypatch, bucket, focus):
    monkeypatch.setattr(norm_buckets, "BUCKET", bucket)
    monkeypatch.setattr(norm_buckets, "FOCUS", focus)
    rng = random.Random(focus)
    words = [a + b for a, b in itertools.product("bcdfgh", "aeiou")]
    docs = [(i, " ".join(rng.choices(words, weights=range(1, 31), k=rng.randrange(0, 60)))) for i in range(300)]
    docs += [(1000 + i, "Ba be, bi! É") for i in range(30)] + [(None, "ba be bi"), (7, "ba be bi"), (400, None), (401, " ")]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(12)] + [(99, None), (100, "nowhere")]
    d = spark.createDataFrame([x + ("clash",) for x in docs], "doc_id long, text string, score string")
    q = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = [tuple(r) for r in norm_buckets.search(d, q, k=10, max_terms=40).collect()]
    assert sorted(got, key=repr) == brute_search(docs, items, 10)


def test_search_of_nothing(spark, odd_docs, no_docs):
    q = spark.createDataFrame([("q", "alpha W")], "item_id string, text string")
    assert norm_buckets.search(no_docs, q).count() == 0
    assert norm_buckets.search(odd_docs, q.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert norm_buckets.search(odd_docs, q.limit(0)).count() == 0
    assert sorted(r.doc_id for r in norm_buckets.search(odd_docs, q).collect()) == [1, 1, 2, 6]


def test_registered_rows_are_whole(spark, sf):
    assert queries.op12_phrase_automata(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    ids = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    assert queries.op11_turn_repair(spark, sf).agg(F.countDistinct("conv_id")).first()[0] == ids
