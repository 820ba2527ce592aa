"""p9: documents that are keyword strings, link lists or product tags and not prose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostrum.llm.listiness import OTHER_WORDS, SENTENCE_WORDS
from rostrum.llm.stuffing import (
    KEYWORD_FUNCTION, KEYWORD_SHARE, LEAST_FUNCTION, LEAST_HOSTS, LEAST_LIST_WORDS, LEAST_NEAR_WORDS, LEAST_SENTENCE, LIST_SHARE, NEAR_SHARE, STITCHED_SHARE,
    page_evidence, stuffed_pages,
)
from rostrum.session import sql_list, spread, table


def p9_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_evidence(spread(table(spark, sf_dir, "documents", "doc_id", "text", "source")), "doc_id", "text", "source")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed_pages(p9_evidence(spark, sf_dir)).select("doc_id")


QUERIES = {"p9_found": p9_found, "p9_evidence": p9_evidence}
_WORD = r"a-z0-9\x{80}-\x{10FFFF}"
_EVIDENCE = rf"""
d AS (SELECT doc_id, source, regexp_extract_all(lower(coalesce(text, '')), '[{_WORD}]+|[^{_WORD}]+') AS t FROM documents WHERE doc_id IS NOT NULL),
u AS (SELECT doc_id, source, unnest(t) AS tok, generate_subscripts(t, 1) AS i FROM d),
g AS (SELECT *, coalesce(lead(tok) OVER (PARTITION BY doc_id ORDER BY i), '') AS gap FROM u),
w AS (SELECT doc_id, source, tok, gap, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k, count(*) OVER (PARTITION BY doc_id) AS total, count(*) OVER (PARTITION BY doc_id, tok) AS n,
  tok IN ({sql_list(sorted(set(SENTENCE_WORDS + OTHER_WORDS)))}) AS fn, tok IN ({sql_list(sorted(set(SENTENCE_WORDS)))}) AS sw FROM g WHERE regexp_matches(tok, '^[{_WORD}]')),
c AS (SELECT *, contains(gap, chr(10)) OR contains(gap, chr(13)) OR (gap[1] IN ('.', '?', '!') AND gap[2] IN (' ', chr(9), chr(10), chr(13), '.', '?', '!', chr(34), chr(39)) AND tok NOT IN ('mr', 'mrs', 'ms', 'dr', 'prof', 'st', 'vs')) AS cut,
  gap[1:3] = '://' AS link, NOT fn AND n >= greatest(3, 0.03 * total) AS keyword FROM w),
s AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unit FROM c),
units AS (SELECT doc_id, count(*) AS n, count(*) FILTER (fn) AS f, count(*) FILTER (sw) AS st, count(*) FILTER (keyword) AS kw, count(*) FILTER (link) AS links FROM s GROUP BY doc_id, unit),
lists AS (SELECT doc_id, sum(n) AS words, sum(CASE WHEN f >= {LEAST_FUNCTION} * n AND st >= {LEAST_SENTENCE} * n AND links = 0 AND NOT (n > f AND kw >= {KEYWORD_SHARE} * (n - f) AND f < {KEYWORD_FUNCTION} * n) THEN 0 ELSE n END) AS list_words FROM units GROUP BY doc_id),
ph AS (SELECT DISTINCT doc_id, source, p FROM (SELECT doc_id, source, tok || ' ' || lead(tok, 1) OVER x || ' ' || lead(tok, 2) OVER x || ' ' || lead(tok, 3) OVER x || ' ' || lead(tok, 4) OVER x AS p FROM w WINDOW x AS (PARTITION BY doc_id ORDER BY k)) WHERE p IS NOT NULL),
many AS (SELECT p FROM ph GROUP BY p HAVING count(DISTINCT coalesce(source, chr(1))) >= {LEAST_HOSTS}),
st AS (SELECT doc_id, count(*) AS phrases, count(many.p) AS replicated FROM ph LEFT JOIN many USING (p) GROUP BY doc_id),
evidence AS (SELECT doc_id, CAST(coalesce(words, 0) AS BIGINT) AS words, CAST(coalesce(list_words, 0) AS BIGINT) AS list_words, coalesce(phrases, 0) AS phrases, coalesce(replicated, 0) AS replicated,
  coalesce(list_words / nullif(words, 0), 0)::DOUBLE AS list_share, coalesce(replicated / nullif(phrases, 0), 0)::DOUBLE AS stitched_share FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN st USING (doc_id))
"""

ORACLE = {
    "p9_evidence": f"WITH {_EVIDENCE} SELECT * FROM evidence",
    "p9_found": f"""WITH {_EVIDENCE} SELECT doc_id FROM evidence WHERE (list_share > {LIST_SHARE} AND (list_words >= {LEAST_LIST_WORDS} OR list_words = words))
      OR (list_share > {NEAR_SHARE} AND list_words >= {LEAST_NEAR_WORDS} AND stitched_share > {STITCHED_SHARE})""",
}
