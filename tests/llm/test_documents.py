"""Operators over documents against brute force, on the small tables and on odd rows."""

import collections
import hashlib
import itertools
import math
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from layercake.llm import (bayes_minhash, bpe_arrays, context_mixing, mix_weights, nbsvm, prefix_join,
                           queries, robust_outliers)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(sf):
    return dict(zip(*pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def base_counts(text):
    w, at = WORD.findall(text or ""), collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit))


def components(sets):
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations([i for i in sets if sets[i]], 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


# -- op 1
def test_targets_reshare_the_excess():
    sizes, weights = [100, 1000, 1000, 0], [5, 2, 1, 5]
    got = mix_weights.targets(sizes, weights, 1.5, 2.0)
    assert got[0] == 200 and got[3] == 0 and math.isclose(sum(got), 1.5 * 2100)
    assert all(t <= 2 * n for t, n in zip(got, sizes))
    assert mix_weights.targets([], [], 1.5, 2.0) == []


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation_is_a_bijection(n):
    got = mix_weights.permute(np.arange(n), np.full(n, n), np.full(n, 9))
    assert sorted(got) == list(range(n))


def test_mix(spark, sf):
    got, want = by_id(queries.op1_mix_sources(spark, sf)), texts(sf)
    assert {i: r.size for i, r in got.items()} == {i: len(WORD.findall(t or "")) for i, t in want.items()}
    assert all(0 <= r.taken <= 2 * r.size for r in got.values())
    per = collections.defaultdict(lambda: [0, 0.0])
    for r in got.values():
        per[r.source_size, r.target][0] += r.taken
    assert all(abs(taken - target) <= max(64, 0.02 * target) for (_, target), (taken, _) in per.items())
    assert by_id(queries.op1_mix_sources(spark, sf)) == got


def test_mix_of_many_repeated_rows(spark):
    n = 3 * mix_weights.SLOT_RUN  # more copies than one row deals out at once
    docs = spark.range(n + 500).selectExpr(
        f"if(id < {n}, NULL, id) AS doc_id", f"if(id < {n}, 'one two three', concat('word ', id)) AS text",
        f"if(id < {n}, 'a', 'b') AS source")
    mix = mix_weights.mix_sources(docs)
    for src, count, size in ((0, n, 3), (1, 500, 2)):
        starts = sorted(r.start for r in mix.spans.filter(f"src = {src}").collect())
        assert starts == [size * i for i in range(count)]
    rows = mix_weights.taken_per_document(mix).collect()
    assert len(rows) == n + 500 and all(r.taken <= 2 * r.size for r in rows)
    for s in mix.sources:
        took = sum(r.taken for r in rows if r.src == s["src"])
        assert abs(took - s["target"]) <= s["block"] + 1
    # the copies of one row are not neighbours in the sequence of a mixed source
    mixed = docs.select("doc_id", "text").withColumn("source", F.lit("a"))
    starts = sorted(r.start for r in mix_weights.mix_sources(mixed).spans.filter("doc_id IS NOT NULL").collect())
    assert starts[0] < n and starts[-1] > 2 * n


def test_mix_of_odd_rows(odd_docs, no_docs):
    got = mix_weights.mixed_documents(odd_docs).collect()
    assert len(got) == odd_docs.count() and {r.taken for r in got if not (r.text or "").strip()} == {0}
    assert mix_weights.mixed_documents(no_docs).count() == 0


def test_mix_of_many_sources_stays_off_the_driver(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat('word ', int(70 + id * id % 50)) AS text", "nullif(concat('é', id), 'é7') AS source")
    tracemalloc.start()
    try:
        mix = mix_weights.mix_sources(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 10e6  # a row per source and shard took 35 MB
    sources = list(mix.sources)
    names = sorted(f"é{i}" for i in range(3000) if i != 7) + [None]
    assert [(s["src"], s["source"]) for s in sources] == list(enumerate(names))
    sizes = [s["source_size"] for s in sources]
    goal = mix_weights.targets(sizes, [(5, 2, 1)[i % 3] for i in range(3000)], 1.5, 2.0)
    assert [s["target"] for s in sources] == goal
    for s, n, t in zip(sources, sizes, goal):
        passes, rest = divmod(t, n)
        assert (s["block"], s["blocks"], s["slots"]) == (1, n, int(passes) * n + min(n, round(rest)))
    assert all(r.taken == r.target or abs(r.taken - r.target) <= 1 for r in mix_weights.taken_per_document(mix).collect())
    shards = collections.Counter(r.shard for r in mix.pieces.select("shard").collect())  # blocks of one word: a piece each
    assert len(shards) == 64 and max(shards.values()) - min(shards.values()) <= 1
    assert mix.pieces.select("src", "slot").distinct().count() == sum(s["slots"] for s in sources)


def test_mix_is_the_same_with_groups_and_shuffled_sources(spark, sf, odd_docs, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")
    docs = docs.union(odd_docs.select("doc_id", "text", "source"))

    def found():
        mix = mix_weights.mix_sources(docs, shards=5)
        shards = collections.Counter(tuple(r) for r in mix.pieces.select("shard", "src", "slot").distinct().select("shard").collect())
        return (sorted(map(tuple, mix_weights.taken_per_document(mix).collect()), key=repr), sorted(shards.items()),
                sorted(map(repr, mix_weights.mixed_documents(docs, shards=5).collect())), list(mix.sources))

    want = found()
    monkeypatch.setattr(mix_weights, "GROUPS", 7)
    monkeypatch.setattr(mix_weights, "SENT_SOURCES", 3)
    monkeypatch.setattr(mix_weights, "SLOT_RUN", 100)
    assert found() == want and len(want[3]) > 14


def test_targets_of_counted_sizes():
    rng = np.random.default_rng(4)
    sizes, weights = rng.integers(0, 40, 500), rng.integers(1, 4, 500)
    alike = collections.Counter(zip(sizes.tolist(), weights.tolist()))
    (size, weight), n = zip(*alike), list(alike.values())
    got = dict(zip(alike, mix_weights.targets(size, weight, 1.5, 2.0, n)))
    assert [got[x] for x in zip(sizes.tolist(), weights.tolist())] == mix_weights.targets(sizes, weights, 1.5, 2.0)


# -- op 2
def test_rules_base_counts(spark, sf):
    got = by_id(queries.op2_robust_outliers(spark, sf))
    for i, t in texts(sf).items():
        r, want = got[i], base_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)


def test_rules_reject_outliers_and_keep_the_rest(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(500)]
    rows = [(i, " ".join(rng.choice(words, 200)), "en", "a") for i in range(300)]
    rows += [(1000 + i, " | ".join(rng.choice(words, 100)), "en", "a") for i in range(20)]
    got = by_id(robust_outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
                                      ).select("row.doc_id", "kept"))
    assert all(r.kept == (i < 1000) for i, r in got.items())


def test_chi_square():
    assert math.isclose(robust_outliers.chi2_quantile(0.95, 5), 11.0705, abs_tol=1e-3)


def test_rules_on_odd_rows(odd_docs, no_docs):
    got = robust_outliers.judge(odd_docs).select("row.doc_id", "row.text", "n_words", "n_repeat_words", "kept").collect()
    assert len(got) == 9 and all(r.n_words == len(WORD.findall(r.text or "")) for r in got)
    assert [r.n_repeat_words for r in got if r.doc_id == 6] == [30000]
    assert robust_outliers.kept_documents(no_docs).columns == no_docs.columns
    assert robust_outliers.kept_documents(no_docs).count() == 0


# -- op 3
def test_dual_descent_separates():
    rows = [np.array([0, 1]), np.array([0, 2])] * 10
    w = nbsvm.dual_descent(rows, [np.ones(2)] * 20, np.array([1.0, -1.0] * 10), 3, c=1.0, epochs=50)
    assert w[1] > 0.5 and w[2] < -0.5


def test_classifier_on_held_out_rows(spark):
    from ..conftest import SF_ORACLE
    got = by_id(queries.op3_nbsvm(spark, SF_ORACLE))
    labels = pq.read_table(f"{SF_ORACLE}/labels.parquet").to_pylist()
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    held = [(r["quality"], got[r["doc_id"]].predicted) for r in labels if got[r["doc_id"]].held_out]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)


def test_classifier_learns_vocabulary(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    rows = []
    for i in range(500):
        own = words[:15] if i % 2 else words[15:30]
        rows.append((i, " ".join(rng.permutation([*rng.choice(own, 8), *rng.choice(words[30:], 60)]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    held = [(r.doc_id % 2, r.score > 0.5) for r in nbsvm.scored(docs, labels).collect() if r.held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) >= 0.97 * len(held)


def test_classifier_on_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (99, 0, 0), (4, None, 0), (None, 1, 1)], none.schema)
    assert {r.score for r in nbsvm.scored(odd_docs, none).collect()} == {0.5}
    assert all(r.score > 0.9 and r.predicted == 1 for r in nbsvm.scored(odd_docs, one).collect())
    assert nbsvm.scored(no_docs, one).count() == 0
    assert nbsvm.good_documents(odd_docs, one).columns == odd_docs.columns


# -- op 5
def test_lm_scores(spark, sf):
    got, all_texts = by_id(queries.op5_context_mixing(spark, sf)), texts(sf)
    train = {i: zlib.crc32(str(i).encode()) % 5 != 1 for i in all_texts}
    count, docs = collections.Counter(), sum(train.values())
    for i, t in all_texts.items():
        count.update((t or "").encode().lower().split() if train[i] else [])
    n, v = sum(count.values()) + docs, len(count) + 1
    for i, t in all_texts.items():
        w, r = (t or "").encode().lower().split(), got[i]
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(count[x] for x in w), docs])
        assert math.isclose(base, r.base_score, rel_tol=1e-9) and r.held_out == (not train[i])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, sum(x in count for x in w) + 1, n)
    held = [got[i] for i in got if got[i].held_out]
    assert sum(r.bits_per_byte for r in held) / len(held) < 3


def trained(texts):
    """The code and the predictions that these training texts give, as one chunk."""
    freq = np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256)
    freq[context_mixing.END] = len(texts)
    code = context_mixing.Code.of(freq)
    (pairs, n), _, _ = context_mixing.unit_counts(context_mixing.chunk_units(texts, np.ones(len(texts), bool)))
    return code, context_mixing.Predictions.of(*context_mixing.odds_of(pairs, n, code))


def lm_score(texts, code, known):
    m = context_mixing
    units = m.chunk_units(texts, np.zeros(len(texts), bool))
    keys, _, _, count = m.units_of(*m.layout(texts))
    return m.score(m.Found.of(units.keys).at(keys), count, m.Coded.of(units, known, code), m.Prefixes.of(units, code))


def test_code_is_a_distribution():
    code, known = trained([b"a tree", b"an apple", b"the thing", b"  "])
    assert math.isclose(sum(2.0 ** -code.length), 1)
    # the end after nothing, and a gap or the end after each other first symbol: under one together
    gaps = [b" ", b"\n", b"\t", b"\v", b"\f", b"\r"]
    texts = [b"", *gaps, *(bytes([s]) for s in range(255) if bytes([s]) not in gaps)]
    assert 0 < sum(10 ** lm_score(texts, code, known)) < 1


def slow_lm_score(text, training, code):
    """The model bit by bit, with plain dictionaries."""
    m = context_mixing

    def places(t):
        """Per unit, its bytes and the context keys before each."""
        before = b"\xff" * m.BEFORE
        for unit in re.findall(rb"[^ \t\n\v\f\r\xff]*[ \t\n\v\f\r\xff]", t + b"\xff"):
            keys = []
            for i in range(len(unit)):
                back = b"\xfe" * m.BACK + before + unit[:i]
                keys.append([(0, back[-m.BACK:]), (1, unit[:i])])
            yield unit, keys
            before = (before + unit)[-m.BEFORE:]

    path = {s: [(code.node[code.first[s] + k], code.bit[code.first[s] + k]) for k in range(code.length[s])]
            for s in range(256)}
    seen = collections.defaultdict(lambda: [0, 0])
    for t in training:
        for unit, keys in places(t):
            for s, both in zip(unit, keys):
                for key in both:
                    for node, bit in path[s]:
                        seen[key, node][bit] += 1
    held = {key for key, _ in seen}
    weights = {(state, step): list(w) for state, w in enumerate(m.START_WEIGHTS) for step in range(m.STEPS)}
    slope, count = collections.defaultdict(lambda: [0.0] * 3), collections.Counter()
    ends, total, run, last, previous, seen_bytes = list(m.BLOCKS[1:]), 0.0, 0, {}, None, b"\xff" * m.BEFORE
    for at, (unit, keys) in enumerate(places(text)):
        if ends and at == ends[0]:
            for gate, g in slope.items():
                weights[gate] = [w + m.RATE / m.SCALE * x / (count[gate] + 16) for w, x in zip(weights[gate], g)]
            slope.clear(), count.clear(), ends.pop(0)
        this = seen_bytes + unit  # a unit is the same one if the bytes before it are, too
        guess = last.get(previous)
        bits = [b for s in unit for _, b in path[s]]
        told = [b for s in guess[m.BEFORE:m.BEFORE + 8] for _, b in path[s]] if guess else []
        k, agrees = 0, guess is not None
        for s, both in zip(unit, keys):
            state = int(both[1] in held)
            for step, (node, bit) in enumerate(path[s]):
                odds = []
                for key in both:
                    zero, one = seen[key, node] if (key, node) in seen else (0, 0)
                    odds.append(max(-127, min(127, round(math.log((one + m.SMOOTH) / (zero + m.SMOOTH)) * m.SCALE))))
                agrees = agrees and k < len(told)
                odds.append((1 if told[k] else -1) * math.log(2 * min(run, m.RUN) + 1.6) * m.SCALE if agrees else 0)
                sign, gate = 1 if bit else -1, (state, min(step, m.STEPS - 1))
                z = max(-m.EDGE, min(m.EDGE, sign * sum(w * o for w, o in zip(weights[gate], odds)) / m.SCALE))
                z = round(z * m.GRADES) / m.GRADES
                total -= math.log1p(math.exp(-z))
                count[gate] += 1
                slope[gate] = [g + sign * o / (1 + math.exp(z)) for g, o in zip(slope[gate], odds)]
                agrees = agrees and told[k] == bits[k]
                k += 1
        run = run + 1 if guess == this else 0
        if previous is not None:
            last[previous] = this
        previous, seen_bytes = this, this[-m.BEFORE:]
    return total / math.log(10)


def test_lm_score_equals_a_bit_by_bit_loop():
    rng = np.random.default_rng(5)
    words = ["the", "then", "thing", "a", "é", "ing", "\n", " ", "漢字", "x1", "the thing and the other thing"]
    some = [" ".join(rng.choice(words, n)).encode() for n in (0, 1, 3, 20, 60, 150)]
    new = [" ".join(rng.choice([*words, "zebra", "qu"], n)).encode() for n in (1, 5, 50, 200)] + [b"", b"\x00 \x7f"]
    code, known = trained(some)
    for texts in (some + new, new):  # with and without company: documents do not meet
        for t, got in zip(texts, lm_score(texts, code, known)):
            assert math.isclose(got, slow_lm_score(t, some, code), rel_tol=2e-4, abs_tol=2e-3), t


def test_lm_score_gains_from_more_text(spark, sf):
    """Held-out texts: the whole corpus predicts them better than a tenth of it."""
    every = texts(sf)
    low = {i: (t or "").encode().lower() for i, t in every.items()}
    held = [t for i, t in low.items() if zlib.crc32(str(i).encode()) % 5 == 1][:40]
    train = [t for i, t in low.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    few, many = trained(train[:len(train) // 10]), trained(train)
    assert lm_score(held, *many).sum() > 0.95 * lm_score(held, *few).sum()


def test_lm_counts_do_not_depend_on_chunks_and_shards(spark, monkeypatch):
    rows = [(i, f"the thing {i % 7} and {'other ' * (i % 5)}words {i}") for i in range(300)] + [(None, "a"), (7, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted(map(str, context_mixing.lm_scores(docs.coalesce(1)).collect()))
    monkeypatch.setattr(context_mixing, "CHUNK", 1000)
    monkeypatch.setattr(context_mixing, "SHARDS", 5)
    assert sorted(map(str, context_mixing.lm_scores(docs.coalesce(3)).collect())) == one


def test_lm_scores_of_odd_rows(odd_docs, no_docs):
    got = context_mixing.lm_scores(odd_docs).collect()
    assert len(got) == 9 and all(r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert context_mixing.lm_scores(no_docs).count() == 0


# -- op 6
def test_token_counts(spark, sf, odd_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)

    def same(rows, by):
        for r in rows:
            t = by(r) or ""
            assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids))
            assert r.over_limit == (r.n_tokens > 1024)

    want = texts(sf)
    same(queries.op6_bpe_arrays(spark, sf).collect(), lambda r: want[r.doc_id])
    odd = {r.doc_id: r.text for r in odd_docs.collect()}
    same(bpe_arrays.count_tokens(odd_docs, path).collect(), lambda r: odd[r.doc_id])
    assert bpe_arrays.count_tokens(no_docs, path).count() == 0
    merges = bpe_arrays.Merges(open(path).read())
    rng = np.random.default_rng(4)
    for _ in range(200):
        s = "".join(map(chr, rng.choice([*range(1, 128), 160, 233, 0x3000, 0x4E2D, 0x1F600, 0x85, 0x2028], 30)))
        assert bpe_arrays._count(merges, [s], {}) == [len(lib.encode(s, add_special_tokens=False).ids)], repr(s)


def test_long_pre_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, merges = Tokenizer.from_file(path), bpe_arrays.Merges(open(path).read())
    rng = np.random.default_rng(6)
    kinds = [list("abcdefghijklmnopqrstuvwxyz"), list("ab"), ["the", "ing", "anti", "er"], list("é漢字a"), ["="], [" "]]
    for parts in kinds:
        for n in (bpe_arrays.LONG - 1, bpe_arrays.LONG, 700):
            s = "".join(rng.choice(parts, n))
            assert bpe_arrays._count(merges, [s, "a " + s], {}) == [
                len(lib.encode(x, add_special_tokens=False).ids) for x in (s, "a " + s)], s
    word = "".join(rng.choice(kinds[0], 100_000))
    began = time.process_time()
    assert bpe_arrays._count(merges, [word], {}) == [len(lib.encode(word, add_special_tokens=False).ids)]
    assert time.process_time() - began < 4  # the old rescan of the whole sequence took 32 s


# -- op 9
def test_decontamination_on_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(10, "BETA gamma"), (9, "zeta"), (8, None), (7, "--"), (11, "beta gamma"),
         (12, "beta gamma delta epsilon zeta eta theta iota kappa lamda my beta")], "item_id long, text string")
    got = prefix_join.decontaminate(odd_docs, items).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    ids = "10,11,12,9"
    for r in got:
        if r.doc_id in (1, 2):
            assert (r.n_words, r.n_hit, r.n_items) == (12, 11, 4) and r.contaminated
            assert r.items_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        else:
            assert (r.n_hit, r.n_items, r.contaminated) == (0, 0, False)
    assert len(got) == 9
    assert prefix_join.clean_documents(odd_docs, items).columns == odd_docs.columns
    assert prefix_join.clean_documents(no_docs, items).count() == 0
    assert prefix_join.clean_documents(odd_docs, items.limit(0)).count() == 9


# -- op 10
def test_near_duplicates(spark, sf):
    sets = {i: shingle_set(t, 2) for i, t in texts(sf).items()}
    want, got = components(sets), by_id(queries.op10_bayes_minhash(spark, sf))
    for i in sets:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), want[i], want[i] == i)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = bayes_minhash.near_duplicates(odd_docs, shingle_words=2).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id in (1, 2, 3, 4, 5)) == [
        (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True)]
    assert bayes_minhash.near_duplicates(no_docs).count() == 0


def test_keep_one_row_of_each_group(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "w"),  # repeated rows
            (None, b, "x"), (None, b, "x"), (None, b + " more", "x"),  # copies without an id
            (2, a, "x"), (2, c, "x"),  # one id, a copy and a text of its own
            (None, None, "x"), (3, "", "x"), (3, "", "x")]
    got = bayes_minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, tag string")).collect()
    texts = sorted(((r.doc_id, r.text) for r in got), key=str)
    assert [r for r in texts if r[1] == a] == [(1, a)] and [r.tag for r in got if r.text == a] == ["w"]
    assert sum((r[1] or "").startswith(b) for r in texts) == 1
    assert (2, c) in texts and len(texts) == 6
    named = spark.createDataFrame([("p", b), ("q", b), ("q", c), ("7", b)], "doc_id string, text string")
    assert sorted(tuple(r) for r in bayes_minhash.keep_one(named).collect()) == [("7", b), ("q", c)]


def test_prune_table_is_safe():
    least = bayes_minhash.prune_table(0.8, 1e-6, 150, 25)
    assert least == sorted(least) and least[-1] < 0.8 * 150


def test_buckets_of_the_same_members_are_compared_once(spark):
    held = {(7, 4): (1, 2), (5, 2): (1, 2), (9, 1): (1, 2, 3), (8, 0): (3, 4)}
    marked = spark.createDataFrame([(b, band, n, 10, 0 if n > 2 else n) for (b, band), ns in held.items() for n in ns],
                                   "bucket long, band int, node long, n_shingles long, label long")
    nodes = spark.createDataFrame([(n, bytes(600)) for n in range(1, 5)], "node long, sig binary")
    met, groups = bayes_minhash._mixed(marked, nodes, "test-once")
    # bucket 7 repeats bucket 5 in a later band, bucket 8 holds one label
    assert sorted((r["bucket"], r["node"]) for r in met.collect()) == [(5, 1), (5, 2), (9, 1), (9, 2), (9, 3)]
    assert groups == 1
