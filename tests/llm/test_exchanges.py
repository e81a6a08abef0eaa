"""What the near-duplicate and language-model operators move, write and hold."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from layercake.llm import bayes_minhash, common, context_mixing, mix_weights, nbsvm

from ..conftest import plan_text, session_conf


def test_sifted_keeps_every_key_and_few_others(spark):
    keys = common.materialize(spark.range(0, 40_000, 7).withColumnRenamed("id", "key"), "test-keys")
    rows = spark.range(40_000).withColumnRenamed("id", "key")
    found = {r["key"] for r in common.sifted(rows, "key", keys).collect()}
    wanted = set(range(0, 40_000, 7))
    assert wanted <= found and len(found) < 1.5 * len(wanted)
    assert common.sifted(rows, "key", keys.limit(0)).count() == 0


def test_remembered_words_are_bounded():
    known = {}
    for k in range(300):
        bayes_minhash.shingle_set(" ".join(f"w{k}x{j}" for j in range(1000)), 2, known)
    assert len(known) < 110_000


def test_signatures_of_many_slices_belong_to_their_rows(spark):
    rows = [(k if k % 5 else None, k, " ".join(f"w{j}" for j in range(k % 9)) if k % 7 else None) for k in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, key long, text string").coalesce(1)
    got = {r["key"]: r for r in bayes_minhash.signatures(docs, 2).collect()}
    assert len(got) == 700
    for doc_id, key, text in rows:
        s = bayes_minhash.shingle_set(text, 2)
        assert (got[key]["doc_id"], got[key]["n_shingles"], got[key]["node"]) == (
            doc_id, len(s), bayes_minhash.node_of(s))
        assert (got[key]["sig"] is None) == (len(s) == 0)


def test_a_pair_has_rows_in_the_first_band_it_shares_only(spark):
    sigs = {1: bytes(600), 2: bytes(600), 3: b"\1" * 20 + bytes(580)}  # 3 shares all bands but the first
    held = {(10, 0): (1, 2), (11, 1): (1, 2, 3), (12, 2): (1, 2, 3)}
    rows = [(b, band, n, n, 1, bytearray(sigs[n])) for (b, band), ns in held.items() for n in ns]
    met = spark.createDataFrame(rows, "bucket long, band int, node long, label long, blocks long, sig binary")
    least = bayes_minhash.prune_table(0.8, 1e-5, 150, 25)
    got = sorted(tuple(r)[:4] for r in bayes_minhash._nearest(met, least, 1).collect())
    assert got == [(10, 1, 1, 2), (10, 2, 1, 2), (11, 1, 1, 3), (11, 2, 2, 3), (11, 3, 1, 3)]


def test_packed_words_give_the_full_set_of_one_row_a_node(spark):
    docs = common.materialize(spark.createDataFrame([(1, "A b  c d"), (1, "A b  c d"), (2, "a b c d"), (3, "x y")],
                                                    "key long, text string"), "test-docs")
    wanted = common.materialize(spark.createDataFrame([(77, 1)], "node long, key long"), "test-wanted")
    (row,) = bayes_minhash.whole_words(docs, wanted, "test-words").collect()
    found = bayes_minhash.Sets(2).of(bytes(row["items"]))
    assert row["node"] == 77 and found.tolist() == bayes_minhash.shingle_set("a b c d", 2).tolist()


def test_counts_are_sent_and_not_written(spark, odd_docs, monkeypatch):
    written = []

    def noted(df, name):
        written.append(name)
        return common.materialize(df, name)

    monkeypatch.setattr(context_mixing, "materialize", noted)
    rows = context_mixing.lm_scores(odd_docs).collect()
    assert len(rows) == odd_docs.count() and len({r["train_tokens"] for r in rows}) == 1
    assert written == ["cm-chunks", "cm-scores"]


def test_a_text_without_words_costs_its_batch_no_link(spark):
    words = [f"w{j}" for j in range(60)]
    rows = [(k, " ".join([*words[:k], f"x{k}", *words[k + 1:]])) for k in (10, 30)] + [(5, None), (6, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in bayes_minhash.near_duplicates(docs, shingle_words=2).collect()}
    assert got == {10: 10, 30: 10, 5: 5, 6: 6}


def test_coded_bits_of_a_chunk_are_held_once(monkeypatch):
    cm = context_mixing
    monkeypatch.setattr(cm, "SCORED", 8 << 10)
    monkeypatch.setattr(cm, "CODED", 16 << 10, raising=False)
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(100)).encode() for _ in range(1000)]
    units = cm.chunk_units(texts, np.ones(len(texts), bool))
    (pairs, counts), _, _ = cm.unit_counts(units)
    code = cm.Code.of(np.bincount(np.frombuffer(b"".join(texts), np.uint8), minlength=256))
    known = cm.Predictions.of(*cm.odds_of(pairs, counts, code))
    tracemalloc.start()
    try:
        size = cm.Coded.of(units, known, code).bits.nbytes
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert size > 12e6 and peak < 2 * size


def test_gathered_stretches_are_those_of_one_gather(monkeypatch):
    monkeypatch.setattr(context_mixing, "GROUP", 64)
    data = np.arange(1000, dtype=np.int16)
    start, size = np.array([900, 0, 5, 5, 300]), np.array([100, 0, 3, 90, 1])
    assert context_mixing.gathered(data, start, size).tolist() == [
        x for a, n in zip(start, size) for x in range(a, a + n)]
    assert not len(context_mixing.gathered(data, start[:0], size[:0]))


def test_rows_of_the_driver_need_no_python_worker(spark, odd_docs):
    docs = common.materialize(odd_docs, "test-docs")
    mix = mix_weights.mix_sources(docs)
    for df in (mix.pieces, mix_weights.taken_per_document(mix), mix_weights.mixed_documents(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "LocalTableScan" in plan or "LocalRelation" in plan or "Scan parquet" in plan
        assert "ExistingRDD" not in plan  # rows that Python workers unpickle
    assert mix.pieces._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    kinds = {"a": pa.int32(), "b": pa.string()}
    assert [tuple(r) for r in common.local_rows(spark, [(1, None), (2, "é")], **kinds).collect()] == [(1, None), (2, "é")]
    assert common.local_rows(spark, [], **kinds).dtypes == [("a", "int"), ("b", "string")]
    assert not common.local_rows(spark, [], **kinds).collect()


def test_slots_of_few_sources_are_not_broadcast(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('word ', 40) AS text", "'a' AS source")
    with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "10m"}):
        plan = plan_text(mix_weights.mix_sources(docs).pieces)
    joins = [line for line in plan.split("\n") if "Join" in line.split("(")[0]]
    assert joins and "SortMergeJoin" in joins[0]


def test_classifier_takes_texts_slice_by_slice(monkeypatch):
    monkeypatch.setattr(nbsvm, "SLICE", 3)
    rows = pa.record_batch({"x": list(range(8))})
    assert [p.num_rows for p in nbsvm.slices([rows, rows.slice(0, 0)])] == [3, 3, 2]
    assert [p.to_pylist() for p in nbsvm.slices([pa.array([1, None, 3, 4])])] == [[1, None, 3], [4]]
