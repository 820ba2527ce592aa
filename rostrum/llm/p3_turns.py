"""p3: segments of a transcript into clean speaker turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.turns import ORDINALS, TITLES, speaker_turns
from rostrum.session import sql_list, spread, table

COLUMNS = ["id", "transcript_id", "seq", "raw_label", "speaker_code", "attribution", "text"]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = speaker_turns(spread(table(spark, sf_dir, "segments", *COLUMNS)), table(spark, sf_dir, "speakers"), with_text=False)
    return turns.select("transcript_id", F.col("first_seq").cast("bigint"), F.col("last_seq").cast("bigint"), "speaker_code")


def p3_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns with the text that was said."""
    return speaker_turns(spread(table(spark, sf_dir, "segments", *COLUMNS)), table(spark, sf_dir, "speakers"))


QUERIES = {"p3_found": p3_found, "p3_turns": p3_turns}
_TOKEN = r"(?:\b\pL\.|(?i:mrs?|ms|dr|prof)\.|[\pL\pN][\pL\pN''’-]*)"
_ASIDE = r"(?:\s*\((?i:cont''?d\.?|continued|from [^()]{1,24})\))*"
_NAME = rf"{_TOKEN}(?:\s*{_TOKEN}){{0,4}}?{_ASIDE}"
_NOISE = "|".join(
    [r"\(\([^()]*\)\)", r"<[^<>]*>", r"\{[^{}]*\}", r"\*[^*]{1,60}\*", r"--\s*[^-]{1,60}--", r"[\[(][^\[\]()]*\d:\d\d[^\[\]()]*[\])]", r"\b\d{1,2}:\d\d(?::\d\d)?(?:[.,]\d+)?\b"]
)
_HESITATION = r"(?i)\b(?:u+h+m*|u+m+|e+r+m*|m{2,}|h+m+|a+h+|e+h+)\b(?:\.{2,}|…)?,?"
_LABEL = rf"(^\s*|[.?!…)\]][\x27\x22”’]*\s+)(?:>>\s*|-\s+)?(?:({_NAME})\s*:|([\[(]\s*{_NAME}\s*[\])]):?)"
_TITLES = sql_list(TITLES)


def _plain(x: str) -> str:
    """A label in the spelling of the forms."""
    x = rf"regexp_replace(regexp_replace(regexp_replace({x}, '^[\s>\[(-]+', ''), '\([^()]*\)', ' ', 'g'), '[\s:;\])]+$', '')"
    x = rf"regexp_replace(trim(regexp_replace(lower({x}), '[.\s]+', ' ', 'g')), '^({'|'.join(ORDINALS)}) +(.)', '\2')"
    return rf"trim(regexp_replace({x}, '(\pL) *\d+$', '\1'))"


_TURNS = rf"""
WITH seg AS (SELECT * EXCLUDE (loaded_at) FROM segments WHERE transcript_id IS NOT NULL AND seq IS NOT NULL AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1),
who AS (SELECT speaker_code AS code, unnest(list_prepend(display_name, string_split(coalesce(other_names, ''), ';'))) AS full_name FROM speakers WHERE speaker_code <> 'UNK'),
ws AS (SELECT code, list_filter(string_split(trim(full_name), ' '), lambda w: w <> '') AS w FROM who),
bare AS (SELECT code, w, list_filter(w, lambda x: NOT regexp_full_match(x, '\w\.?')) AS b FROM ws WHERE len(w) > 0),
raw_forms AS (
  SELECT speaker_code AS code, speaker_code AS f FROM speakers WHERE speaker_code <> 'UNK'
  UNION ALL SELECT speaker_code, array_to_string(string_split(speaker_code, ''), ' ') FROM speakers WHERE speaker_code <> 'UNK'
  UNION ALL SELECT code, array_to_string(w, ' ') FROM bare UNION ALL SELECT code, array_to_string(b, ' ') FROM bare WHERE len(w) > 1
  UNION ALL SELECT code, b[-1] FROM bare WHERE len(w) > 1 UNION ALL SELECT code, t || ' ' || b[-1] FROM bare, (SELECT unnest([{_TITLES}]) AS t) WHERE len(w) > 1
  UNION ALL SELECT code, array_to_string(list_transform(w, lambda x: x[1]), ' ') FROM bare WHERE len(w) > 1
  UNION ALL SELECT code, g || ' ' || b[-1] FROM (SELECT code, b, w, unnest(b[:-2]) AS g FROM bare) WHERE len(w) > 1
  UNION ALL SELECT code, g[1] || ' ' || b[-1] FROM (SELECT code, b, w, unnest(list_filter(b[:-2], lambda x: lower(x) NOT IN ({_TITLES}))) AS g FROM bare) WHERE len(w) > 1),
forms AS (SELECT form, min(code) AS code FROM (SELECT trim(regexp_replace(lower(replace(f, '.', ' ')), '\s+', ' ', 'g')) AS form, code FROM raw_forms) WHERE form <> '' GROUP BY form HAVING count(DISTINCT code) = 1),
clean AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(text, '{_NOISE}', ' ', 'g'), '{_HESITATION}', ' ', 'g'), '(?i)\b(?:you know|sort of|kind of|i mean),', ' ', 'g')) AS c FROM seg),
marked AS (SELECT *, string_split(regexp_replace(c, '{_LABEL}', '\1' || chr(1) || '\2' || chr(2) || '\3' || chr(3), 'g'), chr(1)) AS parts FROM clean),
piece AS (SELECT id, transcript_id, seq, speaker_code, attribution, raw_label, unnest(parts) AS part, generate_subscripts(parts, 1) AS n FROM marked),
cut AS (SELECT *, contains(part, chr(2)) AS labelled, split_part(part, chr(2), 1) AS plain, split_part(split_part(part, chr(3), 1), chr(2), 2) AS bracket, split_part(part, chr(3), 2) AS rest FROM piece),
norm AS (SELECT *, CASE WHEN labelled THEN {_plain("CASE WHEN plain <> '' THEN plain ELSE bracket END")} END AS w, CASE WHEN n = 1 THEN {_plain("raw_label")} END AS r FROM cut),
labels AS (SELECT DISTINCT w AS l FROM norm WHERE w <> '' UNION SELECT DISTINCT r FROM norm WHERE r <> ''),
said AS (SELECT l, arg_min(code, (d, code)) AS code FROM (SELECT l, code, CASE WHEN l = form THEN 0 ELSE damerau_levenshtein(l, form) END AS d, form FROM labels, forms WHERE l = form OR (length(form) >= 5 AND length(l) >= 4 AND abs(length(l) - length(form)) <= 1)) WHERE d <= 1 GROUP BY l),
named AS (SELECT x.*, a.code AS written, b.code AS raw FROM norm x LEFT JOIN said a ON a.l = x.w LEFT JOIN said b ON b.l = x.r),
speech AS (SELECT *, last_value(CASE WHEN n = 1 THEN coalesce(written, raw) ELSE written END IGNORE NULLS) OVER (PARTITION BY id ORDER BY n ROWS UNBOUNDED PRECEDING) AS label,
  regexp_replace(CASE WHEN NOT labelled THEN part WHEN written IS NULL AND plain <> '' THEN plain || ':' || rest ELSE rest END, '\[[^\[\]]*\]|\([^()]*\)', ' ', 'g') AS said, regexp_matches(said, '[\pL\pN]') AS spoken FROM named),
coded AS (SELECT *, CASE WHEN upper(trim(speaker_code)) IN (SELECT code FROM forms) THEN upper(trim(speaker_code)) END AS code FROM speech WHERE spoken),
own AS (SELECT *, CASE WHEN label IS NOT NULL THEN label WHEN attribution IS NOT NULL AND lower(trim(attribution)) <> 'inherit' THEN code END AS me FROM coded),
filled AS (SELECT *, coalesce(last_value(me IGNORE NULLS) OVER u, first_value(code) OVER u, 'UNK') AS speaker FROM own WINDOW u AS (PARTITION BY transcript_id ORDER BY seq, id, n ROWS UNBOUNDED PRECEDING)),
runs AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER (PARTITION BY transcript_id ORDER BY seq, id, n) THEN 0 ELSE 1 END AS opens FROM filled),
turns AS (SELECT *, sum(opens) OVER (PARTITION BY transcript_id ORDER BY seq, id, n ROWS UNBOUNDED PRECEDING) AS turn FROM runs)"""
_TURN = "transcript_id, CAST(min(seq) AS {0}) AS first_seq, CAST(max(seq) AS {0}) AS last_seq, any_value(speaker) AS speaker_code"
ORACLE = {
    "p3_found": f"{_TURNS} SELECT {_TURN.format('BIGINT')} FROM turns GROUP BY transcript_id, turn",
    "p3_turns": rf"{_TURNS} SELECT {_TURN.format('INT')}, string_agg(trim(regexp_replace(said, '\s+', ' ', 'g')), ' ' ORDER BY seq, id, n) AS text FROM turns GROUP BY transcript_id, turn",
}
