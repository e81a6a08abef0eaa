"""The pipeline's stages against brute force, each on what the stage before kept."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from layercake.llm.common import materialize, table
from layercake.llm.prefix_join import words_of

from .test_documents import components, shingle_set


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns, seen = docs.columns, []
    for name, stage in P.STAGES:
        docs = materialize(stage(spark, docs, sf), "test-stage")
        seen.append(docs)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    ids = [sorted(r.doc_id for r in d.select("doc_id").collect()) for d in seen]
    assert all(set(b) <= set(a) and b for a, b in zip(ids, ids[1:]))
    texts = {r.doc_id: r.text for r in seen[1].collect()}
    roots = components({i: shingle_set(t, 5) for i, t in texts.items()})
    assert ids[2] == sorted(set(roots.values()))
    items = [tuple(r.w) for r in table(spark, sf, "benchmark").select(words_of(F.col("text")).alias("w")).collect()]
    windows = {w[i:i + 10] for w in items for i in range(max(len(w) - 9, 1))}
    clean = [r.doc_id for r in seen[2].select("doc_id", words_of(F.col("text")).alias("w")).collect()
             if not any(tuple(r.w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(r.w)))]
    assert ids[3] == sorted(clean)
    assert ids[4] == ids[3] and all(0 <= r.taken <= 2 * r.size for r in seen[4].collect())
    assert [n for n, _ in P.STAGES] and len(P.STAGES) == 5
