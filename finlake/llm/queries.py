"""The operators' queries over the shared tables, and SQL for those it can express."""

from __future__ import annotations

from finlake.llm import (
    decontaminate,
    language,
    multiset,
    packing,
    quality,
    repair,
    secrets,
    simhash,
    spelling,
    topk,
    toxicity,
    urls,
    whitening,
)

QUERIES = {
    "op1_repair": repair.op1_repair,
    "op2_simhash": simhash.op2_simhash,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_urls": urls.op4_urls,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_topk": topk.op6_topk,
    "op7_secrets": secrets.op7_secrets,
    "op8_language": language.op8_language,
    "op9_packing": packing.op9_packing,
    "op10_quality": quality.op10_quality,
    "op11_whitening": whitening.op11_whitening,
    "op12_multiset": multiset.op12_multiset,
    "op13_spelling": spelling.op13_spelling,
}

TOPK_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), d AS (SELECT DISTINCT vec_id, v FROM e),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM d q JOIN d c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

SQL = {"op6_topk": TOPK_SQL}
