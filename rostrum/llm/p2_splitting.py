"""p2: segments of more than 260 words into pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostrum.llm.splitting import ABBREVIATIONS, LIMIT, OVERLAP, WORDLIKE, oversized, split_texts
from rostrum.session import sql_list, spread, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = oversized(spread(table(spark, sf_dir, "segments", "id", "text")), "id", "text")
    return found.select("id", "cut_kind").withColumnRenamed("id", "segment_id")


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "segments", "id", "text", "t_start", "t_end"))
    return split_texts(rows, "id", "text", "t_start", "t_end").withColumnRenamed("id", "segment_id")


QUERIES = {"p2_found": p2_found, "p2_pieces": p2_pieces}
ORACLE = {
    "p2_found": rf"""
WITH s AS (SELECT DISTINCT id, text FROM segments WHERE length(text) > 520 AND len(regexp_extract_all(text, '\S+')) > 260),
lists AS (SELECT id, regexp_extract_all(text, '\n|\S+') AS toks FROM s),
tok AS (SELECT id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS ord FROM lists),
core AS (SELECT *, rtrim(tok, '"'')]}}*_') AS c, lead(tok) OVER (PARTITION BY id ORDER BY ord) AS nxt FROM tok),
word AS (SELECT *, lower(ltrim(c[:-2], '"''([{{*_->')) AS w FROM core),
flag AS (SELECT id, ord, tok = E'\n' AS line,
  tok = E'\n' OR CASE WHEN c[-1] IN ('?', '!') THEN true
    WHEN c[-1] <> '.' OR c[-2:] = '..' THEN false
    WHEN regexp_full_match(w, '\pL(\.\pL)*') THEN false
    WHEN w IN ({sql_list(sorted(WORDLIKE))}) THEN NOT regexp_matches(coalesce(nxt, ''), '^[\d\p{{Ll}}]')
    ELSE w NOT IN ({sql_list(sorted(set(ABBREVIATIONS)))}) END AS ends FROM word),
run AS (SELECT id, line, coalesce(sum(ends::INT) OVER (PARTITION BY id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stretch FROM flag),
sized AS (SELECT id, stretch, count(*) FILTER (NOT line) AS n FROM run GROUP BY ALL)
SELECT id AS segment_id, CASE WHEN max(n) <= 260 THEN 'natural' ELSE 'forced' END AS cut_kind FROM sized GROUP BY id""",
    "p2_pieces": rf"""
WITH RECURSIVE s AS (SELECT id, text, t_start, t_end, regexp_extract_all(text, '\s+|\S+') AS toks FROM segments WHERE id IS NOT NULL AND length(text) > {2 * LIMIT}
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY text, t_start NULLS FIRST, t_end NULLS FIRST) = 1),
tok AS (SELECT id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM s),
gaps AS (SELECT *, coalesce(lead(tok) OVER (PARTITION BY id ORDER BY i), '') AS gap FROM tok),
words AS (SELECT id, tok, gap, i, row_number() OVER (PARTITION BY id ORDER BY i) AS k, lead(tok) OVER (PARTITION BY id ORDER BY i) AS nxt FROM gaps WHERE regexp_matches(tok, '^\S')),
core AS (SELECT *, rtrim(tok, '"'')]}}*_') AS c FROM words),
word AS (SELECT *, lower(ltrim(c[:-2], '"''([{{*_->')) AS w FROM core),
flag AS (SELECT id, k, i, nxt IS NULL OR contains(gap, chr(10)) OR contains(gap, chr(13)) OR CASE WHEN c[-1] IN ('?', '!') THEN true
    WHEN c[-1] <> '.' OR c[-2:] = '..' THEN false
    WHEN regexp_full_match(w, '\pL(\.\pL)*') THEN false
    WHEN w IN ({sql_list(sorted(WORDLIKE))}) THEN NOT regexp_matches(coalesce(nxt, ''), '^[\d\p{{Ll}}]')
    ELSE w NOT IN ({sql_list(sorted(set(ABBREVIATIONS)))}) END AS ends FROM word),
long AS (SELECT id, CAST(max(k) AS BIGINT) AS n, min(i) - 1 AS lead, list_sort(list(k) FILTER (ends)) AS cuts FROM flag GROUP BY id HAVING max(k) > {LIMIT}),
kind AS (SELECT *, CASE WHEN list_max(list_transform(cuts, lambda x, j: x - coalesce(cuts[j - 1], 0))) <= {LIMIT} THEN 'natural' ELSE 'forced' END AS text_kind FROM long),
walk AS (SELECT id, 0 AS piece, 0::BIGINT AS cut_from, 0::BIGINT AS cut_at, '' AS cut_kind FROM kind
  UNION ALL SELECT id, piece + 1, cut_at, coalesce(fit, reach), CASE WHEN fit IS NULL THEN 'forced' ELSE 'natural' END
  FROM (SELECT w.id, w.piece, w.cut_at, least(n, greatest(w.cut_at - {OVERLAP}, 0) + {LIMIT}) AS reach,
      list_max(list_filter(cuts, lambda x: x > greatest(w.cut_at, {OVERLAP}) AND x <= least(n, greatest(w.cut_at - {OVERLAP}, 0) + {LIMIT}))) AS fit FROM walk w JOIN kind k ON k.id = w.id WHERE w.cut_at < n)),
piece AS (SELECT id, piece, greatest(cut_from - {OVERLAP}, 0) AS first_word, cut_at, cut_kind, CAST(max(piece) OVER (PARTITION BY id) AS INT) AS pieces FROM walk)
SELECT p.id AS segment_id, p.piece, p.pieces, p.first_word, CAST(p.cut_at - p.first_word AS INT) AS words, k.n AS all_words,
  CASE WHEN s.t_end >= s.t_start THEN s.t_start + (s.t_end - s.t_start) * p.first_word / k.n END AS start_s,
  CASE WHEN s.t_end >= s.t_start THEN s.t_start + (s.t_end - s.t_start) * p.cut_at / k.n END AS end_s,
  p.cut_kind, k.text_kind, array_to_string(list_slice(s.toks, k.lead + 2 * p.first_word + 1, k.lead + 2 * p.cut_at - 1), '') AS text
FROM piece p JOIN kind k ON k.id = p.id JOIN s ON s.id = p.id WHERE p.piece > 0""",
}
