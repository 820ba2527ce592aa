"""Queries over transcripts and segments: shares, turns, questions, quality, citations, anchors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.functions.text import corpus_tier, percent, timecode, word_count
from rostrum.operators.attribution import ABBREVIATIONS, LEAST_TAIL, MARKS, MOST_WORDS, TARGET_WORDS, admitted_labels, ends_sentence, inherited_turns, passage_bounds, quality_rules, split_at_labels
from rostrum.operators.joins import band_join, close_calls, misattributed, nearest, reanchor
from rostrum.operators.quality import citation_states
from rostrum.session import r6, sql_list, table

SPEAKERS = ["K", "Q", "ANN", "UNK"]
#: Labels that name a speaker wherever they stand.
SEEDS = {"k": "K", "ostry": "K", "mr ostry": "K", "q": "Q", "question": "Q", "questioner": "Q", "audience": "Q"}


def segments(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Segments without repeated rows, which differ in loaded_at only. What is wanted of a text is worked out first, so that texts aren't shuffled."""
    return table(spark, sf_dir, "segments").select("id", *columns).dropDuplicates(["id"])


def _words() -> Column:
    return word_count("text").alias("words")


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "transcripts").dropDuplicates(["id"])


def speaker_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and speaking time of the main codes per transcript; percentages are of all words."""
    rows = segments(spark, sf_dir, "transcript_id", "speaker_code", _words(), "t_start", "t_end")
    span = F.coalesce(F.greatest(F.col("t_end") - F.col("t_start"), F.lit(0.0)), F.lit(0.0))
    of = lambda s, x: F.coalesce(F.sum(F.when(F.col("speaker_code") == s, x)), F.lit(0))
    sums = rows.groupBy("transcript_id").agg(F.sum("words").alias("words"), F.sum(F.round(span * 1000).cast("bigint")).alias("ms"), *(of(s, F.col("words")).alias(f"words_{s.lower()}") for s in SPEAKERS))
    return sums.select("transcript_id", "words", "ms", *(f"words_{s.lower()}" for s in SPEAKERS), *(r6(percent(F.col(f"words_{s.lower()}"), F.col("words"))).alias(f"pct_{s.lower()}") for s in SPEAKERS))


def tier_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts, distinct items and words by tier and event type, by tier, and in all."""
    rows = transcripts(spark, sf_dir).withColumn("tier", corpus_tier("event_type")).withColumn("code", F.upper(F.trim("item_code")))
    return rows.groupingSets([["tier", "event_type"], ["tier"], []], "tier", "event_type").agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("transcripts"), F.countDistinct("code").alias("items"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"),
    )


def turns_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of one speaker_code by seq; the first segment's attribution stands for the run."""
    rows = segments(spark, sf_dir, "transcript_id", "seq", "speaker_code", "attribution")
    order = Window.partitionBy("transcript_id").orderBy("seq", "id")
    code = F.coalesce("speaker_code", F.lit(""))
    change = F.coalesce((code != F.lag(code).over(order)).cast("int"), F.lit(1))
    rows = rows.withColumn("code", code).withColumn("change", change)
    rows = rows.withColumn("turn", F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("transcript_id", "turn").agg(
        F.first("code").alias("speaker"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), F.count("*").alias("segments"),
        F.min_by(F.coalesce("attribution", F.lit("")), F.struct("seq", "id")).alias("attribution"),
    )


def answers_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K turns with the first seq of the question turn right before them."""
    turns = turns_merged(spark, sf_dir)
    order = Window.partitionBy("transcript_id").orderBy("turn")
    rows = turns.withColumn("asked_seq", F.when(F.lag("speaker").over(order) == "Q", F.lag("first_seq").over(order)))
    return rows.filter("speaker = 'K' and asked_seq is not null").select("transcript_id", "first_seq", "asked_seq")


def carried_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segment's label, carried forward within its transcript; ANN before the first."""
    order = Window.partitionBy("transcript_id").orderBy("seq", "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = segments(spark, sf_dir, "transcript_id", "seq", "raw_label")
    return rows.select("id", "transcript_id", "seq", F.coalesce(F.last("raw_label", ignorenulls=True).over(order), F.lit("ANN")).alias("label"))


def question_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each labelled question the last segment within twelve, 180 words and before the next label that has a question mark, else its own."""
    order = Window.partitionBy("transcript_id").orderBy("seq", "id")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    asks = F.coalesce(F.col("text").contains("?"), F.lit(False)).alias("asks")
    rows = segments(spark, sf_dir, "transcript_id", "seq", "speaker_code", "raw_label", _words(), asks)
    rows = rows.select("id", "transcript_id", "speaker_code", "raw_label", F.row_number().over(order).alias("n"), F.sum("words").over(upto).alias("total"), "words", F.count("raw_label").over(upto).alias("labels"), "asks")
    # the next twelve rows of the same sort order, without a join
    near = F.collect_list(F.struct("total", "labels", "asks")).over(Window.partitionBy("transcript_id").orderBy("n").rowsBetween(0, 11))
    rows = rows.withColumn("near", near).filter("speaker_code = 'Q' and raw_label is not null")
    fits = F.transform("near", lambda x, i: F.when((x["total"] - F.col("total") + F.col("words") <= 180) & (x["labels"] == F.col("labels")) & x["asks"], i))
    return rows.select("id", "transcript_id", (F.coalesce(F.array_max(fits), F.lit(0)) + 1).cast("bigint").alias("question_segments"))


def transcript_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule, failures, signals and status of each transcript by its segments."""
    sums = segments(spark, sf_dir, "transcript_id", "speaker_code", _words()).groupBy("transcript_id").agg(
        F.count_distinct(F.when(~F.col("speaker_code").isin("ANN", "UNK"), F.col("speaker_code"))).alias("speakers"),
        F.coalesce(F.sum(F.when(F.col("speaker_code") == "K", F.col("words"))), F.lit(0)).alias("k_words"), F.count_if(F.col("speaker_code") == "K").alias("k_passages"),
    )
    events = transcripts(spark, sf_dir).select(F.col("id").alias("transcript_id"), "event_type")
    return quality_rules(events.join(sums, "transcript_id", "left").fillna(0, ["speakers", "k_words", "k_passages"]), "transcript_id")


def overlapping_speech(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of segments of a transcript by different speakers that start within two seconds."""
    rows = segments(spark, sf_dir, "transcript_id", "speaker_code", "t_start").filter("speaker_code is not null")
    one = rows.select(F.col("id").alias("segment_a"), "transcript_id", F.col("speaker_code").alias("code_a"), F.col("t_start").alias("at_a"))
    two = rows.select(F.col("id").alias("segment_b"), "transcript_id", F.col("speaker_code").alias("code_b"), F.col("t_start").alias("at_b"))
    pairs = band_join(one, two, ["transcript_id"], "at_a", "at_b", 2.0).filter("segment_a < segment_b and code_a <> code_b")
    return pairs.select("segment_a", "segment_b", r6(F.abs(F.col("at_a") - F.col("at_b"))).alias("distance"))


def nearest_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each question segment the K segment of its transcript that starts nearest."""
    rows = segments(spark, sf_dir, "transcript_id", "speaker_code", "t_start")
    left = rows.filter("speaker_code = 'Q'").withColumnRenamed("id", "segment_id")
    found = nearest(left, rows.filter("speaker_code = 'K'"), ["transcript_id"], "segment_id", "t_start", "t_start", "id")
    return found.select("segment_id", "nearest_id", r6("distance").alias("distance"))


def _codes(df: DataFrame, column: str = "item_code") -> DataFrame:
    return df.withColumn("item_code", F.upper(F.trim(column)))


def citation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One citation per transcript, a second after its middle segment, resolved against the segments of its item."""
    rows = _codes(segments(spark, sf_dir, "transcript_id", "item_code", "seq", "speaker_code", "timestamps_synthetic", "t_start")).withColumnRenamed("id", "segment_id")
    mid = rows.groupBy("transcript_id").agg(F.floor((F.min("seq") + F.max("seq")) / 2).alias("mid"))
    cites = rows.join(mid, "transcript_id").filter("seq <= mid").groupBy("transcript_id").agg(F.max_by(F.struct("item_code", "t_start"), F.struct("seq", "segment_id")).alias("x"))
    cites = cites.select(F.col("transcript_id").alias("cite_id"), F.col("x.item_code").alias("item_code"), (F.col("x.t_start") + 1.0).alias("t_start"))
    links = table(spark, sf_dir, "item_media", "item_id", "media", "status").filter("media = 'video' and status = 'downloaded'")
    items = table(spark, sf_dir, "items", "id", "code").distinct()
    linked = links.join(items, links.item_id == items.id).select(F.upper(F.trim("code")).alias("item_code"))
    return citation_states(cites, rows, linked)


def reanchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of all segments after a re-ingest that moved every second transcript by one seq and lost the segments that end before they start."""
    rows = segments(spark, sf_dir, "transcript_id", "seq", F.sha2("text", 256).alias("sha"), "t_start", "t_end").filter("sha is not null")
    base = rows.select(F.col("id").alias("anchor_id"), F.col("transcript_id").cast("string").alias("item_code"), F.lit("manual").alias("kind"), F.lit("en").alias("language"), F.col("seq").cast("bigint").alias("seq"), "sha", "transcript_id", (F.col("t_end") < F.col("t_start")).alias("lost"))
    now = base.filter("not coalesce(lost, false)").withColumn("seq", F.col("seq") + F.col("transcript_id") % 2)
    return reanchor(base, now)


def _source_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "items", "id", "code", "duration_minutes", "updated_at").groupBy("id").agg(F.max_by(F.struct("code", "duration_minutes"), "updated_at").alias("x")).select(F.upper(F.trim("x.code")).alias("item_code"), "x.duration_minutes")
    rows = _codes(transcripts(spark, sf_dir).select("id", "item_code", "source_path", "duration_secs")).filter("source_path is not null").join(items, "item_code", "left")
    return rows.select(F.col("id").alias("code"), F.col("source_path").alias("path"), F.col("duration_secs").alias("actual_secs"), F.col("duration_minutes").alias("expected_minutes"))


def misattributed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts that share a source file and are not the one whose duration fits best; all of them, without a keeper, if none fits."""
    found = misattributed(_source_claims(spark, sf_dir))
    return found.select(F.col("code").alias("transcript_id"), F.col("path").alias("source_path"), F.col("keeper").alias("keeper_id"))


def misattributed_close_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared source files that more than one transcript fits by the minutes that its own segments last, with the one kept and the runners-up."""
    ends = segments(spark, sf_dir, "transcript_id", "t_end").groupBy("transcript_id").agg(F.ceil(F.max("t_end") / 60).cast("int").alias("expected_minutes"))
    claims = _source_claims(spark, sf_dir).drop("expected_minutes").join(ends.withColumnRenamed("transcript_id", "code"), "code", "left")
    found = close_calls(claims)
    return found.select(F.col("path").alias("source_path"), F.col("keeper").alias("keeper_id"), F.array_join(F.transform("runners_up", lambda x: x.cast("string")), ",").alias("runners_up"))


def stale_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts beside their items, with the segments and words they say they have and those they have."""
    found = segments(spark, sf_dir, "transcript_id", _words()).groupBy("transcript_id").agg(F.count("*").alias("n"), F.sum("words").alias("w"))
    titles = table(spark, sf_dir, "items", "id", "code", "title", "updated_at").groupBy("id").agg(F.max_by(F.struct("code", "title"), "updated_at").alias("x")).select(F.upper(F.trim("x.code")).alias("item_code"), "x.title")
    rows = _codes(transcripts(spark, sf_dir).select("id", "item_code", "segment_count", "word_count"))
    rows = rows.join(titles, "item_code", "left").join(found, rows.id == found.transcript_id, "left")
    return rows.select("id", "title", "segment_count", F.coalesce("n", F.lit(0)).alias("segments_found"), "word_count", F.coalesce("w", F.lit(0)).alias("words_found"), F.coalesce(F.col("segment_count") != F.coalesce("n", F.lit(0)), F.lit(True)).alias("stale"))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of about 150 words of every K segment, cut at sentence ends."""
    @F.pandas_udf("array<struct<first: int, words: int, text: string>>")
    def cut(texts: pd.Series) -> pd.Series:
        def one(text: str) -> list[dict]:
            words = text.split()
            return [{"first": a, "words": b - a, "text": " ".join(words[a:b])} for a, b in passage_bounds([ends_sentence(w) for w in words])] if words else []

        return texts.map(one)

    rows = table(spark, sf_dir, "segments", "id", "transcript_id", "seq", "speaker_code", "text").filter("speaker_code = 'K' and text is not null").dropDuplicates(["id"])
    return rows.select("id", "transcript_id", "seq", F.posexplode(cut("text")).alias("passage", "p")).select("id", "transcript_id", "seq", "passage", "p.first", "p.words", "p.text")


def label_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that each transcript admits, with the speaker they stand for and how often they occur at the head of a segment or within."""
    cues = segments(spark, sf_dir, "transcript_id", F.regexp_replace("raw_label", r"[.:]+$", "").alias("label"), "text")
    return admitted_labels(cues, "transcript_id", SEEDS)


def labelled_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by the labels that each transcript admits, wherever they stand; what has no label goes on with the speaker before."""
    cues = segments(spark, sf_dir, "transcript_id", "seq", F.regexp_replace("raw_label", r"[.:]+$", "").alias("label"), "text", "t_start", "t_end")
    turns = inherited_turns(split_at_labels(cues, label_registry(spark, sf_dir), "transcript_id"), "transcript_id")
    return turns.withColumns({"t_start": r6("t_start"), "t_end": r6("t_end")})


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the announcer says, and whether it is an introduction: before the main speaker has said anything."""
    rows = segments(spark, sf_dir, "transcript_id", "seq", "speaker_code")
    before = Window.partitionBy("transcript_id").orderBy("seq", "id").rowsBetween(Window.unboundedPreceding, -1)
    spoke = F.coalesce(F.max((F.col("speaker_code") == "K").cast("int")).over(before), F.lit(0))
    return rows.withColumn("intro", spoke == 0).filter("speaker_code = 'ANN'").select("id", "transcript_id", "intro")


def passage_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per segment after cutting into passages: none is lost."""
    return passages(spark, sf_dir).groupBy("id").agg(F.sum("words").cast("bigint").alias("words"))


def speech_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timecodes and whole seconds of segment starts."""
    rows = segments(spark, sf_dir, "t_start").filter("t_start >= 0")
    return rows.select("id", timecode("t_start").alias("timecode"), F.floor("t_start").cast("bigint").alias("whole_second"))


QUERIES = {
    "speaker_share": speaker_share, "tier_rollup": tier_rollup, "turns_merged": turns_merged, "answers_link": answers_link, "carried_labels": carried_labels,
    "question_ends": question_ends, "transcript_quality": transcript_quality, "overlapping_speech": overlapping_speech, "nearest_answer": nearest_answer,
    "citation_check": citation_check, "reanchored": reanchored, "misattributed_sources": misattributed_sources, "misattributed_close_calls": misattributed_close_calls, "stale_counts": stale_counts,
    "passages": passages, "passage_words": passage_words, "label_registry": label_registry, "labelled_turns": labelled_turns, "announcements": announcements, "speech_times": speech_times,
}

_SEG = "seg AS (SELECT * EXCLUDE (loaded_at) FROM segments QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1)"
_TR = "tr AS (SELECT * FROM transcripts QUALIFY row_number() OVER (PARTITION BY id ORDER BY parsed_at) = 1)"
_IT = "it AS (SELECT *, upper(trim(code)) AS k FROM items QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)"
_W = r"len(regexp_extract_all(coalesce(text, ''), '\S+'))"
_TIER = """CASE WHEN upper(trim(event_type)) = 'EBM' THEN 'X' WHEN upper(trim(event_type)) IN ('T','TS','TSS','TYP','TR','Q','S','SBR','D','DT','DS','DSS') THEN 'A'
  WHEN upper(trim(event_type)) LIKE 'F%' THEN 'C' ELSE 'B' END"""
_TURNS = f"""{_SEG},
c AS (SELECT *, coalesce(speaker_code, '') AS code FROM seg),
ch AS (SELECT *, CASE WHEN code = lag(code) OVER (PARTITION BY transcript_id ORDER BY seq, id) THEN 0 ELSE 1 END AS change FROM c),
tn AS (SELECT *, sum(change) OVER (PARTITION BY transcript_id ORDER BY seq, id ROWS UNBOUNDED PRECEDING) AS turn FROM ch),
turns AS (SELECT transcript_id, CAST(turn AS BIGINT) AS turn, any_value(code) AS speaker, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS segments, arg_min(coalesce(attribution, ''), (seq, id)) AS attribution FROM tn GROUP BY transcript_id, turn)"""

_MARKS = MARKS.replace("'", "''")
#: Passages: the words, where sentences end, and a walk from cut to cut; a short tail joins the passage before.
_PASSAGES = rf"""s AS (SELECT DISTINCT id, transcript_id, seq, text FROM segments WHERE speaker_code = 'K' AND text IS NOT NULL),
w AS (SELECT *, regexp_extract_all(text, '\S+') AS ws FROM s), c AS (SELECT *, list_transform(ws, lambda x: trim(x, '{_MARKS}')) AS cores FROM w WHERE len(ws) > 0),
b AS (SELECT *, len(ws) AS n, list_filter(range(1, len(ws) + 1), lambda i: regexp_full_match(cores[i], '(?s).*[^.?!…][.?!]+') AND NOT ends_with(cores[i], '..')
  AND NOT (ends_with(cores[i], '.') AND regexp_full_match(cores[i], '\p{{Lu}}{{1,2}}[.?!]+')) AND lower(rtrim(cores[i], '.?!')) NOT IN ({sql_list(sorted(ABBREVIATIONS))})) AS ends FROM c),
walk AS (SELECT id, 0 AS k, 0::BIGINT AS start, 0::BIGINT AS cut FROM b
  UNION ALL SELECT b.id, k + 1, cut, least(n, cut + {MOST_WORDS}, coalesce(list_min(list_filter(ends, lambda e: e >= cut + {TARGET_WORDS})), n)) FROM walk JOIN b ON b.id = walk.id WHERE cut < n),
cuts AS (SELECT *, max(k) OVER (PARTITION BY id) AS last FROM walk WHERE k > 0),
tails AS (SELECT id FROM cuts WHERE k = last AND last > 1 AND cut - start < {LEAST_TAIL}),
pieces AS (SELECT c.id, k, start, CASE WHEN t.id IS NOT NULL AND k = last - 1 THEN NULL ELSE cut END AS cut FROM cuts c LEFT JOIN tails t ON t.id = c.id WHERE t.id IS NULL OR k < last)"""

ORACLE = {
    "passages": f"""WITH RECURSIVE {_PASSAGES} SELECT p.id, b.transcript_id, b.seq, CAST(k - 1 AS INT) AS passage, CAST(start AS INT) AS first, CAST(coalesce(cut, n) - start AS INT) AS words, array_to_string(ws[start + 1:coalesce(cut, n)], ' ') AS text FROM pieces p JOIN b ON b.id = p.id""",
    "label_registry": rf"""WITH {_SEG}, x AS (SELECT transcript_id, regexp_replace(raw_label, '[.:]+$', '') AS l FROM seg WHERE raw_label IS NOT NULL
        UNION ALL SELECT transcript_id, unnest(regexp_extract_all(text, '(?i)[^A-Za-z0-9
]({"|".join(sorted(SEEDS, key=lambda s: (-len(s), s)))}):', 1)) FROM seg),
      m(name, code) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in SEEDS.items())}), n AS (SELECT transcript_id, l AS raw_label, count(*) AS hits FROM x GROUP BY ALL)
      SELECT transcript_id, raw_label, coalesce(m.code, upper(raw_label)) AS speaker_code, hits FROM n LEFT JOIN m ON m.name = lower(trim(raw_label)) WHERE m.code IS NOT NULL OR (hits >= 2 AND regexp_full_match(raw_label, '[A-Z][A-Z0-9]{{0,3}}'))""",
    "labelled_turns": rf"""WITH reg AS ({{_REGISTRY}}), {_SEG}, nm AS (SELECT transcript_id, lower(trim(raw_label)) AS name, min(speaker_code) AS code FROM reg GROUP BY ALL),
      pt AS (SELECT transcript_id, string_agg(name, '|' ORDER BY -length(name), name) AS names FROM nm GROUP BY transcript_id),
      mk AS (SELECT seg.id, seg.transcript_id, seq, t_start, t_end, regexp_replace(raw_label, '[.:]+$', '') AS label,
        list_filter(string_split(CASE WHEN names IS NULL OR NOT contains(text, ':') THEN text ELSE regexp_replace(text, '(?i)(^|[\s.!?])(' || names || '):', '\1' || chr(1) || '\2' || chr(2), 'g') END, chr(1)), lambda x: trim(x, ' ') <> '') AS parts
        FROM seg LEFT JOIN pt ON pt.transcript_id = seg.transcript_id WHERE text IS NOT NULL),
      pc AS (SELECT id, transcript_id, seq, t_start, t_end, label, len(parts) > 1 AS synthetic, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS piece FROM mk),
      sd AS (SELECT *, len(regexp_extract_all(CASE WHEN contains(part, chr(2)) THEN split_part(part, chr(2), 2) ELSE part END, '\S+')) AS words, lower(trim(CASE WHEN contains(part, chr(2)) THEN split_part(part, chr(2), 1) WHEN piece = 0 THEN label END)) AS name FROM pc),
      tm AS (SELECT *, greatest(sum(words) OVER (PARTITION BY id), 1) AS total, sum(words) OVER (PARTITION BY id ORDER BY piece) AS upto FROM sd),
      nd AS (SELECT tm.*, nm.code AS named, t_start + (t_end - t_start) * (upto - words) / total AS s, t_start + (t_end - t_start) * upto / total AS e FROM tm LEFT JOIN nm ON nm.transcript_id = tm.transcript_id AND nm.name = tm.name),
      sp AS (SELECT *, coalesce(last_value(named IGNORE NULLS) OVER w, 'ANN') AS speaker FROM nd WINDOW w AS (PARTITION BY transcript_id ORDER BY seq, id, piece ROWS UNBOUNDED PRECEDING)),
      ch AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER w THEN 0 ELSE 1 END AS opens FROM sp WINDOW w AS (PARTITION BY transcript_id ORDER BY seq, id, piece)),
      tn AS (SELECT *, sum(opens) OVER (PARTITION BY transcript_id ORDER BY seq, id, piece ROWS UNBOUNDED PRECEDING) AS turn FROM ch)
      SELECT transcript_id, CAST(turn AS BIGINT) AS turn, any_value(speaker) AS speaker_code, arg_min(CASE WHEN named IS NULL THEN 'inherit' ELSE 'label' END, (seq, id, piece)) AS attribution, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS pieces,
        CAST(sum(words) AS BIGINT) AS words, round(arg_min({{{{'t': s}}}}, (seq, id, piece)).t, 6) AS t_start, round(arg_max({{{{'t': e}}}}, (seq, id, piece)).t, 6) AS t_end, bool_or(synthetic) AS synthetic FROM tn GROUP BY transcript_id, turn""",
    "announcements": f"WITH {_SEG}, x AS (SELECT id, transcript_id, speaker_code, coalesce(max((speaker_code = 'K')::INT) OVER (PARTITION BY transcript_id ORDER BY seq, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS intro FROM seg) SELECT id, transcript_id, intro FROM x WHERE speaker_code = 'ANN'",
    "speaker_share": f"""WITH {_SEG}, w AS (SELECT *, {_W} AS n, coalesce(greatest(t_end - t_start, 0), 0) AS span FROM seg),
      s AS (SELECT transcript_id, CAST(sum(n) AS BIGINT) AS words, CAST(sum(round(span * 1000)) AS BIGINT) AS ms, {", ".join(f"CAST(coalesce(sum(n) FILTER (speaker_code = '{s}'), 0) AS BIGINT) AS words_{s.lower()}" for s in SPEAKERS)} FROM w GROUP BY transcript_id)
      SELECT *, {", ".join(f"round(CASE WHEN words = 0 THEN 0 ELSE 100.0::DOUBLE * words_{s.lower()} / words END, 6) AS pct_{s.lower()}" for s in SPEAKERS)} FROM s""",
    "tier_rollup": f"""WITH {_TR}, x AS (SELECT *, {_TIER} AS tier, upper(trim(item_code)) AS c FROM tr)
      SELECT tier, event_type, CAST(grouping(tier, event_type) AS INT) AS level, count(*) AS transcripts, count(DISTINCT c) AS items, CAST(coalesce(sum(word_count), 0) AS BIGINT) AS words
      FROM x GROUP BY GROUPING SETS ((tier, event_type), (tier), ())""",
    "turns_merged": f"WITH {_TURNS} SELECT * FROM turns",
    "answers_link": f"""WITH {_TURNS}, l AS (SELECT *, lag(speaker) OVER w AS before, lag(first_seq) OVER w AS asked FROM turns WINDOW w AS (PARTITION BY transcript_id ORDER BY turn))
      SELECT transcript_id, first_seq, asked AS asked_seq FROM l WHERE speaker = 'K' AND before = 'Q'""",
    "carried_labels": f"WITH {_SEG} SELECT id, transcript_id, seq, coalesce(last_value(raw_label IGNORE NULLS) OVER (PARTITION BY transcript_id ORDER BY seq, id ROWS UNBOUNDED PRECEDING), 'ANN') AS label FROM seg",
    "question_ends": f"""WITH {_SEG}, r AS (SELECT id, transcript_id, speaker_code, raw_label, row_number() OVER w AS n, sum({_W}) OVER u AS total, {_W} AS words, count(raw_label) OVER u AS labels, coalesce(contains(text, '?'), false) AS asks
        FROM seg WINDOW w AS (PARTITION BY transcript_id ORDER BY seq, id), u AS (PARTITION BY transcript_id ORDER BY seq, id ROWS UNBOUNDED PRECEDING))
      SELECT a.id, a.transcript_id, CAST(coalesce(max(b.n - a.n) FILTER (b.asks AND b.labels = a.labels AND b.total - a.total + a.words <= 180), 0) + 1 AS BIGINT) AS question_segments
      FROM r a JOIN r b ON a.transcript_id = b.transcript_id AND b.n BETWEEN a.n AND a.n + 11 WHERE a.speaker_code = 'Q' AND a.raw_label IS NOT NULL GROUP BY a.id, a.transcript_id""",
    "transcript_quality": f"""WITH {_SEG}, {_TR}, s AS (SELECT transcript_id, count(DISTINCT speaker_code) FILTER (speaker_code NOT IN ('ANN', 'UNK')) AS speakers, coalesce(sum({_W}) FILTER (speaker_code = 'K'), 0) AS k_words, count(*) FILTER (speaker_code = 'K') AS k_passages FROM seg GROUP BY transcript_id),
      x AS (SELECT tr.id AS transcript_id, upper(coalesce(event_type, '')) AS e, coalesce(speakers, 0) AS speakers, CAST(coalesce(k_words, 0) AS BIGINT) AS k_words, coalesce(k_passages, 0) AS k_passages FROM tr LEFT JOIN s ON s.transcript_id = tr.id),
      y AS (SELECT *, (e = 'Q' OR e[1] IN ('D', 'C', 'I')) AS dialogue FROM x),
      z AS (SELECT transcript_id, CASE WHEN dialogue THEN 'dialogue' WHEN e = 'T' THEN 'public_talk' WHEN k_passages = 0 THEN 'k_presence' ELSE 'none' END AS rule,
        concat_ws(',', CASE WHEN dialogue AND k_words > 0 AND k_words < 20 THEN 'trivial_k_speech' END, CASE WHEN k_passages = 0 THEN 'zero_k_passages' END) AS failure_codes,
        CASE WHEN dialogue AND speakers < 2 THEN 'single_speaker_source' END AS signals, speakers, k_words FROM y)
      SELECT *, CASE WHEN failure_codes <> '' THEN 'warn' ELSE 'pass' END AS status FROM z""",
    "overlapping_speech": f"""WITH {_SEG} SELECT a.id AS segment_a, b.id AS segment_b, round(abs(a.t_start - b.t_start), 6) AS distance FROM seg a JOIN seg b ON a.transcript_id = b.transcript_id AND a.id < b.id AND a.speaker_code <> b.speaker_code AND abs(a.t_start - b.t_start) <= 2.0""",
    "nearest_answer": f"""WITH {_SEG} SELECT q.id AS segment_id, arg_min(k.id, (abs(k.t_start - q.t_start), k.id)) AS nearest_id, round(min(abs(k.t_start - q.t_start)), 6) AS distance
      FROM seg q JOIN seg k ON q.transcript_id = k.transcript_id AND k.speaker_code = 'K' AND k.t_start IS NOT NULL WHERE q.speaker_code = 'Q' AND q.t_start IS NOT NULL GROUP BY q.id""",
    "citation_check": f"""WITH {_SEG}, s AS (SELECT id, transcript_id, upper(trim(item_code)) AS item, seq, speaker_code, timestamps_synthetic AS syn, t_start FROM seg),
      m AS (SELECT transcript_id, floor((min(seq) + max(seq)) / 2) AS mid FROM s GROUP BY transcript_id),
      c AS (SELECT s.transcript_id AS cite_id, arg_max({{'item': s.item, 't': s.t_start}}, (s.seq, s.id)) AS x FROM s JOIN m USING (transcript_id) WHERE s.seq <= m.mid GROUP BY 1),
      b AS (SELECT c.cite_id, arg_min({{'id': s.id, 'speaker': s.speaker_code, 'syn': s.syn}}, (CASE WHEN s.speaker_code = 'K' THEN 0 ELSE 1 END, abs(s.t_start - (c.x.t + 1.0)), s.id)) AS y FROM c JOIN s ON s.item = c.x.item AND abs(s.t_start - (c.x.t + 1.0)) <= 2.0 GROUP BY c.cite_id),
      l AS (SELECT DISTINCT upper(trim(i.code)) AS item FROM item_media m JOIN items i ON i.id = m.item_id WHERE m.media = 'video' AND m.status = 'downloaded'),
      h AS (SELECT DISTINCT item FROM s)
      SELECT c.cite_id, CASE WHEN h.item IS NULL THEN 'no_segments' WHEN b.y IS NULL THEN 'drifted' WHEN b.y.speaker IS DISTINCT FROM 'K' THEN 'not_speaker' WHEN b.y.syn = 1 THEN 'synthetic' WHEN l.item IS NULL THEN 'no_link' ELSE 'resolved' END AS state, b.y.id AS segment_id
      FROM c LEFT JOIN b USING (cite_id) LEFT JOIN l ON l.item = c.x.item LEFT JOIN h ON h.item = c.x.item""",
    "reanchored": f"""WITH {_SEG}, a AS (SELECT id AS anchor_id, transcript_id, CAST(seq AS BIGINT) AS seq, sha256(text) AS sha, coalesce(t_end < t_start, false) AS lost FROM seg WHERE text IS NOT NULL),
      n AS (SELECT transcript_id, sha, seq + transcript_id % 2 AS seq FROM a WHERE NOT lost),
      o AS (SELECT transcript_id, sha, count(*) AS places, min(seq) AS only_seq FROM n GROUP BY ALL), e AS (SELECT DISTINCT transcript_id, sha, seq, true AS same FROM n),
      f AS (SELECT a.anchor_id, CASE WHEN e.same THEN a.seq WHEN o.places = 1 THEN o.only_seq END AS live_seq FROM a LEFT JOIN e USING (transcript_id, sha, seq) LEFT JOIN o USING (transcript_id, sha))
      SELECT anchor_id, CASE WHEN live_seq IS NULL THEN 'stale' ELSE 'live' END AS status, live_seq FROM f""",
    "misattributed_sources": f"""WITH {_TR}, {_IT}, c AS (SELECT tr.id, tr.source_path, abs(tr.duration_secs - it.duration_minutes * 60.0) AS drift, it.duration_minutes * 60.0 AS expected FROM tr LEFT JOIN it ON it.k = upper(trim(tr.item_code)) WHERE source_path IS NOT NULL),
      f AS (SELECT source_path, arg_min(id, (drift, id)) AS keeper_id FROM c WHERE expected <> 0 AND drift <= greatest(180.0, 0.08 * expected) GROUP BY source_path)
      SELECT c.id AS transcript_id, c.source_path, f.keeper_id FROM c LEFT JOIN f USING (source_path) WHERE c.id IS DISTINCT FROM f.keeper_id AND c.source_path IN (SELECT source_path FROM c GROUP BY source_path HAVING count(*) > 1)""",
    "misattributed_close_calls": f"""WITH {_TR}, {_SEG}, m AS (SELECT transcript_id, CAST(ceil(max(t_end) / 60) AS INT) * 60.0 AS expected FROM seg GROUP BY transcript_id),
      r AS (SELECT tr.id, tr.source_path, abs(tr.duration_secs - m.expected) AS drift, m.expected FROM tr JOIN m ON m.transcript_id = tr.id WHERE source_path IS NOT NULL),
      f AS (SELECT source_path, list(id ORDER BY drift, id) AS ids FROM r WHERE expected <> 0 AND drift <= greatest(180.0, 0.08 * expected) GROUP BY source_path HAVING count(*) > 1)
      SELECT source_path, ids[1] AS keeper_id, array_to_string(ids[2:], ',') AS runners_up FROM f""",
    "stale_counts": f"""WITH {_SEG}, {_TR}, {_IT}, f AS (SELECT transcript_id, count(*) AS n, sum({_W}) AS w FROM seg GROUP BY transcript_id)
      SELECT tr.id, it.title, tr.segment_count, coalesce(f.n, 0) AS segments_found, tr.word_count, CAST(coalesce(f.w, 0) AS BIGINT) AS words_found, coalesce(tr.segment_count <> coalesce(f.n, 0), true) AS stale
      FROM tr LEFT JOIN it ON it.k = upper(trim(tr.item_code)) LEFT JOIN f ON f.transcript_id = tr.id""",
    "passage_words": f"WITH {_SEG} SELECT id, {_W} AS words FROM seg WHERE speaker_code = 'K' AND {_W} > 0",
    "speech_times": f"WITH {_SEG} SELECT id, printf('%d:%02d:%02d', CAST(trunc(t_start) AS BIGINT) // 3600, CAST(trunc(t_start) AS BIGINT) % 3600 // 60, CAST(trunc(t_start) AS BIGINT) % 60) AS timecode, CAST(floor(t_start) AS BIGINT) AS whole_second FROM seg WHERE t_start >= 0",
}
ORACLE["labelled_turns"] = ORACLE["labelled_turns"].format(_REGISTRY=ORACLE["label_registry"])
