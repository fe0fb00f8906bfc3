"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from tidemark.llm import (ctw, jaccard, language, licences, mincut, mixing, multi_index, outliers, packing, pii, ranked,
                          resharding, whitening)

QUERIES = {
    "op1_ctw": ctw.op1_ctw,
    "op2_golden_schedule": mixing.op2_golden_schedule,
    "op3_linear_grouping": packing.op3_linear_grouping,
    "op4_jaccard_join": jaccard.op4_jaccard_join,
    "op5_flow_reshard": resharding.op5_flow_reshard,
    "op6_boosted_pii": pii.op6_boosted_pii,
    "op7_mcd_outliers": outliers.op7_mcd_outliers,
    "op8_mincut_text": mincut.op8_mincut_text,
    "op9_multi_index": multi_index.op9_multi_index,
    "op10_centroids": language.op10_centroids,
    "op11_length_strata": ranked.op11_length_strata,
    "op12_licence_expressions": licences.op12_licence_expressions,
    "op13_spectrum_slices": whitening.op13_spectrum_slices,
}

# all pairs that share a shingle, counted; then the smallest id reachable
_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 5 THEN [list_aggregate(ws, 'string_agg', ' ')]
                      ELSE list_distinct([concat_ws(' ', ws[i], ws[i+1], ws[i+2], ws[i+3], ws[i+4])
                                          for i in range(1, len(ws) - 3)]) END AS sh
  FROM w
), x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(doc_id, to_id) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON reach.to_id = pairs.a
)
SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, r.component_id
FROM s JOIN (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""

# every document that shares a term with an item is scored; then the best 20
_RANKED = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL
), s AS (SELECT count(*) AS docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0
), tf AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, s GROUP BY term, docs
), q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // total))))) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term), s GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20
"""

ORACLE_SQL = {"op4_jaccard_join": _JACCARD, "op11_length_strata": _RANKED}
