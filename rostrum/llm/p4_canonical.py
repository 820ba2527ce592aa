"""p4: hand-typed place names to the entries of `places`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.canonical import NONE, SHORT, canonical_codes
from rostrum.session import table


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_codes(table(spark, sf_dir, "items", "id", "place_name", "place_code", "updated_at"), table(spark, sf_dir, "places"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(spark, sf_dir).select("item_id", "place_code")


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that stand for no entry, with the number of items that have them."""
    return _codes(spark, sf_dir).filter(F.col("place_code") == NONE).groupBy("place_name").agg(F.count("*").alias("items"))


QUERIES = {"p4_found": p4_found, "p4_unmatched": p4_unmatched}
def _fold(x: str) -> str:
    return rf"regexp_replace(translate(lower(strip_accents({x})), 'ø01æ', 'oolZ'), '[^\pL]', '', 'g')"


_SHORT = " UNION ALL ".join(
    f"SELECT code, region, '{short} ' || substr(name, {len(word) + 2}) FROM names WHERE lower(name) LIKE '{word} %'" for word, shorts in SHORT.items() for short in shorts
)
_CODES = rf"""
it AS (SELECT id, place_name, place_code FROM items QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, place_name DESC, place_code DESC) = 1),
wanted AS (SELECT * FROM it WHERE regexp_matches(place_name, '\pL') AND place_name NOT IN (SELECT place_name FROM places)),
names AS (SELECT place_code AS code, region_name AS region, unnest(list_prepend(place_name, string_split(coalesce(other_names, ''), ';'))) AS name FROM places),
spelt AS (SELECT code, {_fold("name")} AS form FROM (SELECT code, region, name FROM names UNION ALL {_SHORT})),
forms AS (SELECT DISTINCT code, form FROM (SELECT code, form FROM spelt UNION ALL SELECT code, replace(form, 'Z', 'ae') FROM spelt) WHERE form <> ''),
regions AS (SELECT DISTINCT {_fold("region_name")} AS r FROM places),
vals AS (SELECT DISTINCT place_name AS v FROM wanted),
part AS (SELECT v, regexp_replace(trim(p), '^((near|nr|at|in|outside|off|by)\.?(\s+|$))+', '', 'i') AS p FROM (SELECT v, unnest(regexp_split_to_array(v, '[,/;()\[\]?|]|\s[-–—]+\s')) AS p FROM vals)),
clean AS (SELECT v, {_fold("p")} AS w, count(*) OVER (PARTITION BY v) AS n FROM part WHERE p <> ''),
named AS (SELECT v, w FROM clean WHERE w NOT IN (SELECT r FROM regions) OR v NOT IN (SELECT v FROM clean WHERE w NOT IN (SELECT r FROM regions)) UNION SELECT v, {_fold("v")} FROM clean WHERE n = 1),
hits AS (SELECT v, code, min(damerau_levenshtein(w, form)) AS d FROM named, forms WHERE w <> '' AND abs(length(w) - length(form)) <= 2
  AND damerau_levenshtein(w, form) <= CASE WHEN length(form) < 5 THEN 0 WHEN length(form) < 9 THEN 1 ELSE 2 END GROUP BY v, code),
best AS (SELECT v, code FROM hits QUALIFY d = min(d) OVER (PARTITION BY v)),
bycode AS (SELECT upper(trim(place_code)) AS bare, min(trim(place_code)) AS as_code FROM places GROUP BY 1),
told AS (SELECT w.id, w.place_name, b.code, upper(trim(w.place_code)) = upper(b.code) AS own,
  lower(trim(regexp_replace(regexp_extract(w.place_name, '[,/(]\s*([^,/()]+?)\s*\)?\s*$', 1), '[^\pL]+$', ''))) = lower(p.region_name) AS there
  FROM wanted w LEFT JOIN best b ON b.v = w.place_name LEFT JOIN places p ON p.place_code = b.code),
found AS (SELECT w.id AS item_id, any_value(w.place_name) AS place_name, coalesce(any_value(c.as_code), arg_min(t.code, (NOT coalesce(t.there, false), NOT coalesce(t.own, false), t.code)), '{NONE}') AS place_code
  FROM wanted w LEFT JOIN told t ON t.id = w.id LEFT JOIN bycode c ON c.bare = upper(regexp_replace(w.place_name, '^[^\pL\pN]+|[^\pL\pN]+$', '', 'g')) GROUP BY w.id)
"""

ORACLE = {
    "p4_found": f"WITH {_CODES} SELECT item_id, place_code FROM found",
    "p4_unmatched": f"WITH {_CODES} SELECT place_name, count(*) AS items FROM found WHERE place_code = '{NONE}' GROUP BY place_name",
}
