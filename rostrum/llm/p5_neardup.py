"""p5: segments that repeat each other's text with small edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.neardup import Similar, similar_groups, similar_pairs, similar_sets
from rostrum.session import spread, table

#: The problem's own terms: three words, half of all shingles, texts of 40 words or more.
WORDS, SIMILARITY, LEAST_WORDS = 3, 0.5, 40


def _similar(spark: SparkSession, sf_dir: str) -> Similar:
    return similar_sets(spread(table(spark, sf_dir, "segments", "id", "text")), "id", "text", SIMILARITY, WORDS, LEAST_WORDS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = similar_pairs(_similar(spark, sf_dir))
    return pairs.select(F.col("id_a").alias("segment_a"), F.col("id_b").alias("segment_b"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per segment that takes part: its class of equal sets, its group, its number of links."""
    return similar_groups(_similar(spark, sf_dir)).withColumnRenamed("id", "segment_id")


QUERIES = {"p5_found": p5_found, "p5_groups": p5_groups}
_GRAMS = f"""
s AS (SELECT DISTINCT id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM segments WHERE text IS NOT NULL),
f AS (SELECT id, w, unnest(range(1, len(w) - {WORDS - 2})) AS i FROM s WHERE len(w) >= {LEAST_WORDS}),
g AS (SELECT DISTINCT id, array_to_string(w[i:i + {WORDS - 1}], ' ') AS gram FROM f)"""
ORACLE = {
    "p5_found": f"""
WITH {_GRAMS},
n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
p AS (SELECT a.id AS segment_a, b.id AS segment_b, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.id < b.id GROUP BY ALL)
SELECT segment_a, segment_b FROM p JOIN n x ON x.id = segment_a JOIN n y ON y.id = segment_b WHERE shared >= {SIMILARITY} * (x.n + y.n - shared)""",
    "p5_groups": f"""
WITH RECURSIVE {_GRAMS},
sets AS (SELECT id, md5(string_agg(gram, '|' ORDER BY gram)) AS key FROM g GROUP BY id),
member AS (SELECT id, min(id) OVER (PARTITION BY key) AS class_id, count(*) OVER (PARTITION BY key) AS copies FROM sets),
h AS (SELECT g.* FROM g JOIN member m ON m.id = g.id WHERE m.id = m.class_id),
n AS (SELECT id, count(*) AS n FROM h GROUP BY id),
p AS (SELECT a.id AS x, b.id AS y, count(*) AS shared FROM h a JOIN h b ON a.gram = b.gram AND a.id < b.id GROUP BY ALL),
link AS (SELECT p.x, p.y FROM p JOIN n a ON a.id = p.x JOIN n b ON b.id = p.y WHERE shared >= {SIMILARITY} * (a.n + b.n - shared)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT DISTINCT x AS node, x AS root FROM both_ways UNION SELECT b.y, r.root FROM reach r JOIN both_ways b ON b.x = r.node WHERE r.root < b.y),
part AS (SELECT node, min(root) AS group_id FROM reach GROUP BY node),
degree AS (SELECT x, count(*) AS links FROM both_ways GROUP BY x)
SELECT m.id AS segment_id, m.class_id, coalesce(part.group_id, m.class_id) AS group_id, coalesce(d.links, 0) AS links, m.copies
FROM member m LEFT JOIN part ON part.node = m.class_id LEFT JOIN degree d ON d.x = m.class_id""",
}
