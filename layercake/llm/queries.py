"""The registered queries of the operators, one per operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bayes_minhash, bpe_arrays, context_mixing, link_rank, max_segment, mix_weights, nbsvm, norm_buckets,
               phrase_automata, prefix_join, robust_outliers, turn_repair, warc_revisit)
from .common import table

OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS x FROM
          (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(x) AS n FROM win),
pos AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS x FROM
          (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM pos JOIN win USING (x)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
          (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(t, ',' ORDER BY t)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _plus(path: str, cost: str, letter: str) -> str:
    """SQL: a path (8 digits of cost, then its audit) with one more edit."""
    return (f"lpad(CAST(CAST(left({path}, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0') || substr({path}, 9) || '{letter}'")


def _inserted(paths: list[str]) -> list[str]:
    """SQL: the paths to the four states with insertions where they are cheaper."""
    u = f"least({paths[2]}, {_plus(f'least({paths[0]}, {paths[1]}, {paths[3]})', '3', 'I')})"
    return [paths[0], paths[1], u, f"least({paths[3]}, {_plus(u, '3', 'I')})"]


def _op11_sql() -> str:
    first = _inserted(["'00000000'"] + ["CAST(NULL AS VARCHAR)"] * 3)
    before_u = "least(p.w0, p.w1, p.w3)"

    def stay(role: str, path: str) -> str:
        keep = f"CASE WHEN r.stays AND r.initial = '{role}' THEN {_plus(path, 'r.more', 'K')} END"
        if role == "s":
            return keep
        return f"least({keep}, CASE WHEN r.stays THEN {_plus(path, '3 + r.more', 'R')} END)"

    read = [_plus("p.w0", "4", "D"), f"least({_plus('p.w1', '4', 'D')}, {stay('s', 'p.w0')})",
            f"least({_plus('p.w2', '4', 'D')}, {stay('u', before_u)})",
            f"least({_plus('p.w3', '4', 'D')}, {stay('a', 'p.w2')})"]
    names = ["x0", "x1", "x2", "x3"]
    return rf"""
WITH RECURSIVE tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)),
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
ranked AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n FROM hurt),
seen AS (SELECT *, left(role, 1) AS initial, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS ending,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS nth,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM ranked),
rows_ AS (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
r AS (SELECT *, fault IN ('', 'truncated') AS stays, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more FROM rows_),
path AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS n, {', '.join(f'{x} AS w{i}' for i, x in enumerate(first))}
  FROM (SELECT DISTINCT conv_id FROM r)
  UNION ALL
  SELECT conv_id, n, {', '.join(f'{x} AS w{i}' for i, x in enumerate(_inserted(names)))} FROM (
    SELECT r.conv_id, r.n, {', '.join(f'{x} AS x{i}' for i, x in enumerate(read))}
    FROM path p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1)),
best AS (SELECT conv_id, least(w0, w3) AS w FROM path QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
edits AS (SELECT conv_id, substr(w, 9) AS audit, unnest(range(1, length(w) - 7)) AS i FROM best),
letters AS (SELECT conv_id, i, substr(audit, i, 1) AS e, count(*) FILTER (WHERE substr(audit, i, 1) <> 'I')
    OVER (PARTITION BY conv_id ORDER BY i) AS n FROM edits),
made AS (SELECT l.conv_id, l.i, e, r.role, CASE WHEN e = 'I' THEN '' ELSE r.text END AS text,
    count(*) OVER (PARTITION BY l.conv_id ORDER BY l.i) - max(CASE WHEN e = 'K' AND r.initial = 's' THEN 1 ELSE 0 END)
      OVER (PARTITION BY l.conv_id) AS place
  FROM letters l LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.n = l.n WHERE e <> 'D'),
sums AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY i)) AS repaired_sha256 FROM made GROUP BY conv_id),
counts AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(left(w, 8) AS BIGINT), 0) AS cost, coalesce(substr(w, 9), '') AS audit,
  coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
"""


OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 19) AS x FROM
          (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
first AS (SELECT x, min({'d': doc_id, 'i': i}) AS f FROM win GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM win JOIN first USING (x)
          WHERE {'d': doc_id, 'i': i} > f),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
cut AS (SELECT d.doc_id, w, [w[p] for p in range(1, len(w) + 1) if ps IS NULL OR NOT list_contains(ps, p)] AS kept
          FROM d LEFT JOIN lists USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM cut
"""

OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
a AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM d)
       WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t, len(w)),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, a),
part AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // total)))) AS s
         FROM tf JOIN weight USING (t), a),
score AS (SELECT item_id, doc_id, CAST(sum(s) AS BIGINT) AS score FROM q JOIN part USING (t) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_weights.taken_per_document(mix_weights.mix_sources(table(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_outliers.judge(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op3_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisit.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.lm_scores(table(spark, sf_dir, "documents"))


def op6_bpe_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe_arrays.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_max_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_segment.main_text(table(spark, sf_dir, "pages"))


def op8_link_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_rank.judge(table(spark, sf_dir, "pages"))


def op9_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2).select(
        "doc_id", "n_shingles", "component_id", "kept")



def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_report(table(spark, sf_dir, "conversations"), damage=True)


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.strip_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"], digest=True).select(
        "row.doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_robust_outliers, op3_nbsvm, op4_warc_revisit,
                                    op5_context_mixing, op6_bpe_arrays,
                                    op7_max_segment, op8_link_rank, op9_prefix_join,
                                    op10_bayes_minhash, op11_turn_repair, op12_phrase_automata, op13_norm_buckets)}
ORACLES: dict[str, str] = {"op9_prefix_join": OP9_SQL, "op11_turn_repair": _op11_sql(),
                           "op12_phrase_automata": OP12_SQL, "op13_norm_buckets": OP13_SQL}
