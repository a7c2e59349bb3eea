"""The operators' queries over their whole tables, and SQL where it can say the same."""

from __future__ import annotations

from roadlake.llm import decontaminate, extract, jaccard_join, negatives, neardup, periodic, pii, quality_rules, ranking, repeats, sentencepiece_codec, shards, toxicity


def queries() -> dict:
    return {
        "op1_minhash_neardup": neardup.query,
        "op2_sentencepiece": sentencepiece_codec.query,
        "op3_html_text": extract.query,
        "op4_quality_rules": quality_rules.query,
        "op5_decontamination": decontaminate.query,
        "op6_sharding": shards.query,
        "op7_repeats": repeats.query,
        "op8_ranking": ranking.query,
        "op9_toxicity": toxicity.query,
        "op10_pii": pii.query,
        "op11_ngram_join": jaccard_join.query,
        "op12_hard_negatives": negatives.query,
        "op13_periodic_runs": periodic.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash_neardup": NEARDUP_SQL, "op6_sharding": shards.oracle(),
            "op7_repeats": repeats.SQL, "op11_ngram_join": jaccard_join.SQL, "op12_hard_negatives": negatives.SQL,
            "op13_periodic_runs": periodic.oracle()}


#: Exact: intersections from a join on shingles, components by repeated minima.
NEARDUP_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), reach AS (
  SELECT a AS doc_id, a AS r FROM both_ways
  UNION
  SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a
), c AS (
  SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.r, w.doc_id) AS component_id,
       coalesce(c.r, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
