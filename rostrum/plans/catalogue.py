"""Queries over items, their subtitles and media: derived columns, rollups, work lists, change sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.functions.text import code_parts, corpus_tier, decade, event_label, first_sentence, media_kind, media_path, normal_title, series_folder, slug, tier_is_mapped, title_tail, word_count, year_of_date
from rostrum.operators.joins import best_per_key
from rostrum.operators.sync import change_set, insert_new, keep_best, next_versions, upsert
from rostrum.session import table

PRIORITY = ["en", "en-GB", "en-US"]


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in the version that holds: of each id the row with the latest updated_at."""
    rows = table(spark, sf_dir, "items")
    rest = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(F.max_by(F.struct(*rest), "updated_at").alias("x")).select("id", "x.*")


def item_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an item's code and event type say."""
    rows = items(spark, sf_dir).select("id", "code", "year", "event_date", "event_type", code_parts("code").alias("p"))
    return rows.select(
        "id", F.col("p.place").alias("code_place"), F.col("p.year").alias("code_year"), F.col("p.event_type").alias("code_type"), F.col("p.event_number").alias("code_number"), F.col("p.suffix").alias("code_suffix"),
        year_of_date("event_date").alias("date_year"), decade("year", "code").alias("decade"), event_label("event_type").alias("label"), media_kind("event_type", "code").alias("kind"),
        corpus_tier("event_type").alias("tier"), tier_is_mapped("event_type").alias("mapped"), (corpus_tier("event_type") != "X").alias("included"),
    )


def item_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs, first sentences, normal titles and paths."""
    rows = items(spark, sf_dir)
    return rows.select(
        "id", slug("title").alias("slug"), first_sentence("summary").alias("lead"), normal_title("title").alias("normal_title"), title_tail("title").alias("tail"), word_count("summary").alias("summary_words"),
        series_folder("series_code", "series_order").alias("folder"), media_path("future_path", "mp4").alias("video_path"), F.coalesce(F.length("summary") > 0, F.lit(False)).alias("has_summary"),
    )


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by label of their event type."""
    return items(spark, sf_dir).groupBy(F.coalesce(event_label("event_type"), F.lit("")).alias("label")).agg(F.count("*").alias("items"), F.coalesce(F.sum("duration_minutes"), F.lit(0)).alias("minutes"))


def top_types_with_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve most frequent event types, and the rest in one row."""
    counts = items(spark, sf_dir).groupBy(F.coalesce("event_type", F.lit("")).alias("event_type")).agg(F.count("*").alias("items"))
    ranked = counts.withColumn("place", F.row_number().over(Window.orderBy(F.col("items").desc(), "event_type")))  # a row per type
    kind = F.when(F.col("place") <= 12, F.col("event_type")).otherwise("(other)")
    return ranked.groupBy(kind.alias("event_type")).agg(F.sum("items").alias("items"), F.count("*").alias("types"))


def series_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series with their episodes: place only where all share one, media types in order."""
    rows = items(spark, sf_dir).filter("series_code is not null and trim(series_code) <> ''")
    return rows.groupBy("series_code", "mega_group").agg(
        F.max("series_title").alias("series_title"), F.min("pdf_order").alias("pdf_order"), F.count("*").alias("episodes"), F.coalesce(F.sum("duration_minutes"), F.lit(0)).alias("minutes"),
        F.when(F.count_distinct("place_name") == 1, F.max("place_name")).alias("place_name"), F.array_join(F.array_sort(F.collect_set("media_type")), ",").alias("media_types"),
        F.min("year").alias("year_from"), F.max("year").alias("year_to"),
    )


def series_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years of a series as a label."""
    rows = series_rollup(spark, sf_dir)
    label = F.when(F.col("year_from").isNull(), "").when(F.col("year_from") == F.col("year_to"), F.col("year_from").cast("string")).otherwise(F.concat_ws("–", F.col("year_from").cast("string"), F.col("year_to").cast("string")))
    return rows.select("series_code", "mega_group", "episodes", label.alias("years"))


def first_appearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each series item with its series' first place in the catalogue, and its own place within the series."""
    rows = items(spark, sf_dir).filter("series_code is not null and trim(series_code) <> ''")
    series = Window.partitionBy("series_code")
    return rows.select("id", F.min("pdf_order").over(series).alias("series_first"), F.row_number().over(series.orderBy(F.col("pdf_order").asc_nulls_last(), "id")).cast("bigint").alias("episode"))


def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items, series and places per section and group, named by section."""
    sections = table(spark, sf_dir, "sections").select(F.col("id").alias("section_id"), F.col("title").alias("section"), "slug")
    rows = items(spark, sf_dir).join(sections, "section_id", "left")
    return rows.groupBy("section", "mega_group").agg(F.count("*").alias("items"), F.count_distinct("series_code").alias("series"), F.count_distinct("place_name").alias("places"))


def subtitles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "item_subtitles").distinct()


def best_subtitle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The downloaded subtitle of each item by language: the preferred ones in order, then other English, then by name; of ties the first id."""
    rows = subtitles(spark, sf_dir).filter("status = 'downloaded' and item_id is not null")
    place = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(x) for x in PRIORITY)), F.col("language")), F.lit(0)), F.when(F.col("language").startswith("en"), 10).otherwise(20))
    rows = rows.withColumn("subtitle_id", F.col("id"))
    return best_per_key(rows, "item_id", "subtitle_id", [place, F.coalesce("language", F.lit("~")), F.col("id")])


def ingest_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in the corpus with a downloaded manual English subtitle, by its condition in the join."""
    rows = items(spark, sf_dir).filter("corpus_include = 1").select("id", "code", "event_type", "duration_minutes")
    subs = subtitles(spark, sf_dir).filter("kind = 'manual' and status = 'downloaded' and language in ('en', 'en-GB')").select("item_id", F.col("id").alias("subtitle_id"), "language")
    return rows.join(subs, rows.id == subs.item_id).select("id", "code", "event_type", "duration_minutes", "subtitle_id", "language")


def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without any subtitle in the order of work: talks first, then by catalogue order, unknown orders last."""
    have = subtitles(spark, sf_dir).filter("item_id is not null").select(F.col("item_id").alias("id"))
    rows = items(spark, sf_dir).filter("deleted_at is null").join(have, "id", "left_anti")
    talks = F.coalesce(F.col("event_type").isin("T", "TS", "TYP"), F.lit(False))
    return rows.select("id", "code", talks.alias("talk"), F.coalesce("pdf_order", F.lit(2147483647)).alias("sort_order"), F.dense_rank().over(Window.partitionBy(talks).orderBy(F.col("pdf_order").asc_nulls_last(), "id")).cast("bigint").alias("place"))


def missing_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose video is not there, with its state ('pending' where there is none)."""
    media = table(spark, sf_dir, "item_media").distinct().filter("media = 'video'").groupBy("item_id").agg(F.max("status").alias("status"))
    rows = items(spark, sf_dir).select("id", "code")
    rows = rows.join(media, rows.id == media.item_id, "left").select("id", "code", F.coalesce("status", F.lit("pending")).alias("status"))
    return rows.filter("status <> 'downloaded'")


def low_bitrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media whose size says less than 64 kilobits a second."""
    media = table(spark, sf_dir, "item_media").distinct().filter("file_size is not null")
    rows = media.join(items(spark, sf_dir).select(F.col("id").alias("item_id"), "duration_minutes"), "item_id").filter("duration_minutes > 0")
    rate = F.col("file_size") * 8.0 / 1000.0 / (F.col("duration_minutes") * 60.0)
    return rows.withColumn("kbps", F.round(rate, 3)).filter("kbps < 64").select("id", "item_id", "media", "kbps")


def newest_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two newest media rows of each item."""
    order = Window.partitionBy("item_id").orderBy(F.col("downloaded_at").desc_nulls_last(), "id")
    rows = table(spark, sf_dir, "item_media").distinct().filter("item_id is not null").withColumn("place", F.row_number().over(order).cast("bigint"))
    return rows.filter("place <= 2").select("id", "item_id", "media", "place")


def missing_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the corpus that have no transcript."""
    have = table(spark, sf_dir, "transcripts", "item_code").select(F.upper(F.trim("item_code")).alias("k")).distinct()
    rows = items(spark, sf_dir).filter("corpus_include = 1").withColumn("k", F.upper(F.trim("code")))
    return rows.join(have, "k", "left_anti").select("id", "code")


def shared_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts whose source file serves more than one of them."""
    rows = table(spark, sf_dir, "transcripts", "id", "source_path").distinct()
    shared = rows.groupBy("source_path").count().filter("count > 1 and source_path is not null")
    return rows.join(shared, "source_path", "left_semi").select("id", "source_path")


def code_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in both the catalogue and the transcripts, and in one of them only."""
    a = items(spark, sf_dir).select(F.upper(F.trim("code")).alias("code")).filter("code <> ''")
    b = table(spark, sf_dir, "transcripts", "item_code").select(F.upper(F.trim("item_code")).alias("code")).filter("code <> ''")
    mark = lambda df, m: df.select("code", F.lit(m).alias("side"))
    both = mark(a.intersect(b), "both")
    return both.unionByName(mark(a.distinct().exceptAll(b.distinct()), "catalogue")).unionByName(mark(b.distinct().exceptAll(a.distinct()), "transcripts"))


def compact_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series as one row each, then items without a series."""
    rows = items(spark, sf_dir)
    alone = rows.filter("series_code is null or trim(series_code) = ''").select(F.lit("item").alias("row_kind"), F.col("code").alias("key"), F.lit(1).cast("bigint").alias("episodes"), F.coalesce("duration_minutes", F.lit(0)).cast("bigint").alias("minutes"))
    series = rows.filter("trim(series_code) <> ''").groupBy("series_code").agg(F.count("*").alias("episodes"), F.coalesce(F.sum("duration_minutes"), F.lit(0)).alias("minutes"))
    return series.select(F.lit("series").alias("row_kind"), F.col("series_code").alias("key"), "episodes", "minutes").unionByName(alone)


def tier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and transcripts whose stored tier (of items also the inclusion) differs, null-safely, from what the event type says."""
    rows = items(spark, sf_dir).select(F.lit("items").alias("held_in"), "id", "corpus_tier", "corpus_include", corpus_tier("event_type").alias("tier"))
    rows = rows.withColumn("include", (F.col("tier") != "X").cast("int"))
    held = table(spark, sf_dir, "transcripts", "id", "corpus_tier", "event_type").dropDuplicates(["id"])
    held = held.select(F.lit("transcripts").alias("held_in"), "id", "corpus_tier", F.lit(None).cast("int").alias("corpus_include"), corpus_tier("event_type").alias("tier"), F.lit(None).cast("int").alias("include"))
    rows = rows.unionByName(held).filter(~F.col("corpus_tier").eqNullSafe(F.col("tier")) | ~F.col("corpus_include").eqNullSafe(F.col("include")))
    return rows.select("held_in", "id", "tier", "include")


def _first_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "items", "id", "title", "place_name", "media_type", "deleted_at", "updated_at")
    return rows.groupBy("id").agg(F.min_by(F.struct("title", "place_name", "media_type", "deleted_at"), "updated_at").alias("x")).select("id", "x.*")


def item_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What synchronising the recordings in the first version of the catalogue to the last would do; deleted items go."""
    desired = items(spark, sf_dir).filter("deleted_at is null").select("id", "title", "place_name")
    current = _first_version(spark, sf_dir).filter("media_type is not null").select("id", "title", "place_name")
    return change_set(current, desired, ["id"], ["title", "place_name"])


def item_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions to append where an item's last row says something else than its first."""
    versions = _first_version(spark, sf_dir).select("id", F.lit(1).alias("version"), "title", "place_name", "deleted_at")
    return next_versions(versions, items(spark, sf_dir).select("id", "title", "place_name", "deleted_at"), "id", ["title", "place_name", "deleted_at"])


def media_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per item and medium: later rows over earlier ones, sizes kept where the later has none."""
    rows = table(spark, sf_dir, "item_media", "id", "item_id", "media", "status", "file_size").distinct().filter("item_id is not null")
    key = ["item_id", "media"]
    pick = lambda f: rows.groupBy(*key).agg(f(F.struct("id", "status", "file_size")).alias("x")).select(*key, "x.id", "x.status", "x.file_size")
    return upsert(pick(F.min), pick(F.max), key, ["file_size"])


def subtitle_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual subtitles, and automatic ones for items and languages that have no manual one."""
    rows = subtitles(spark, sf_dir).filter("item_id is not null").select("item_id", "language", "kind", "id")
    manual = rows.filter("kind = 'manual'")
    return insert_new(manual, rows.filter("kind <> 'manual'"), ["item_id", "language"])


def best_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per title: the first, or a later one that adds what it lacks."""
    rows = items(spark, sf_dir).filter("title is not null").select("title", "id", "media_type", "duration_minutes")
    return keep_best(rows, "title", ["media_type", "duration_minutes"], "id")


QUERIES = {
    "item_columns": item_columns, "item_texts": item_texts, "label_counts": label_counts, "top_types_with_tail": top_types_with_tail, "series_rollup": series_rollup, "series_labels": series_labels,
    "first_appearance": first_appearance, "group_counts": group_counts, "best_subtitle": best_subtitle, "ingest_scope": ingest_scope, "work_list": work_list, "missing_video": missing_video,
    "low_bitrate": low_bitrate, "newest_media": newest_media, "missing_transcripts": missing_transcripts, "shared_sources": shared_sources, "code_sets": code_sets, "compact_list": compact_list,
    "tier_changes": tier_changes, "item_changes": item_changes, "item_versions": item_versions, "media_upsert": media_upsert, "subtitle_insert": subtitle_insert, "best_rows": best_rows,
}

_IT = "it AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)"
_FIRST = "fi AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at) = 1)"
_TIER = """CASE WHEN upper(trim(event_type)) = 'EBM' THEN 'X' WHEN upper(trim(event_type)) IN ('T','TS','TSS','TYP','TR','Q','S','SBR','D','DT','DS','DSS') THEN 'A'
  WHEN upper(trim(event_type)) LIKE 'F%' THEN 'C' ELSE 'B' END"""


def _label_sql() -> str:
    from rostrum.functions.text import EVENT_LABELS

    rows = ", ".join(f"('{k}', '{v}')" for k, v in EVENT_LABELS.items())
    return f"lab AS (SELECT t.event_type, arg_max(v.label, length(v.key)) AS label FROM (SELECT DISTINCT event_type FROM items) t JOIN (VALUES {rows}) v(key, label) ON starts_with(t.event_type, v.key) GROUP BY t.event_type)"


_SERIES = f"""{_IT}, se AS (SELECT series_code, mega_group, max(series_title) AS series_title, min(pdf_order) AS pdf_order, count(*) AS episodes, CAST(coalesce(sum(duration_minutes), 0) AS BIGINT) AS minutes,
  CASE WHEN count(DISTINCT place_name) = 1 THEN max(place_name) END AS place_name, coalesce(string_agg(DISTINCT media_type, ',' ORDER BY media_type), '') AS media_types, min(year) AS year_from, max(year) AS year_to
  FROM it WHERE series_code IS NOT NULL AND trim(series_code) <> '' GROUP BY series_code, mega_group)"""

ORACLE = {
    "item_columns": rf"""WITH {_IT}, {_label_sql()},
      b AS (SELECT *, CASE WHEN contains(code, '-') AND NOT code LIKE '%&2' THEN split_part(code, '-', 1) ELSE code END AS base, CASE WHEN contains(code, '-') AND NOT code LIKE '%&2' THEN regexp_extract(code, '^[^-]*-(.*)$', 1) END AS code_suffix FROM it),
      c AS (SELECT *, regexp_matches(base, '^([A-Z]{{2,3}})(\d{{2,4}})([A-Z][A-Z0-9.]*)$') AS strict, regexp_matches(base, '^([A-Z]{{2,3}})(\d{{0,4}})([A-Z].*)$') AS loose FROM b),
      d AS (SELECT *, CASE WHEN strict OR loose THEN regexp_extract(base, CASE WHEN strict THEN '^([A-Z]{{2,3}})\d{{2,4}}[A-Z][A-Z0-9.]*$' ELSE '^([A-Z]{{2,3}})\d{{0,4}}[A-Z].*$' END, 1) END AS place,
        CASE WHEN strict THEN regexp_extract(base, '^[A-Z]{{2,3}}(\d{{2,4}})[A-Z][A-Z0-9.]*$', 1) WHEN loose THEN regexp_extract(base, '^[A-Z]{{2,3}}(\d{{0,4}})[A-Z].*$', 1) END AS digits,
        CASE WHEN strict THEN regexp_extract(base, '^[A-Z]{{2,3}}\d{{2,4}}([A-Z][A-Z0-9.]*)$', 1) WHEN loose THEN regexp_extract(base, '^[A-Z]{{2,3}}\d{{0,4}}([A-Z].*)$', 1) END AS rest FROM c)
      SELECT id, place AS code_place, CASE WHEN length(digits) IN (2, 4) THEN 1900 + CAST(digits[:2] AS INT) END AS code_year,
        CASE WHEN strict AND regexp_matches(rest, '^[A-Z]+\d.*$') THEN regexp_extract(rest, '^([A-Z]+)', 1) WHEN strict THEN rest WHEN loose THEN regexp_replace(rest, '[0-9&]+$', '') END AS code_type,
        CASE WHEN strict THEN CASE WHEN regexp_matches(rest, '^[A-Z]+\d.*$') THEN regexp_extract(rest, '^[A-Z]+(\d.*)$', 1) END WHEN loose THEN nullif(regexp_replace(rest, '^[A-Z]+', ''), '') END AS code_number, code_suffix,
        CASE WHEN len(regexp_extract_all(event_date, '\b\d{{4}}\b')) > 0 AND CAST(regexp_extract_all(event_date, '\b\d{{4}}\b')[-1] AS INT) BETWEEN 1900 AND 2100 THEN CAST(regexp_extract_all(event_date, '\b\d{{4}}\b')[-1] AS INT) END AS date_year,
        coalesce(CAST(coalesce(year, 1900 + CAST(nullif(regexp_extract(code, '\d{{2}}'), '') AS INT)) // 10 * 10 AS VARCHAR) || 's', 'unknown') AS decade, coalesce(lab.label, d.event_type) AS label,
        CASE WHEN coalesce(d.event_type, '') = '' THEN CASE WHEN contains(code, 'F') THEN 'film' ELSE 'recording' END WHEN d.event_type LIKE 'I%' OR contains(d.event_type, 'IM') THEN 'interview' WHEN d.event_type LIKE 'EBM%' THEN 'excerpt'
          WHEN d.event_type LIKE 'F%' OR d.event_type = 'HF' THEN 'film' WHEN d.event_type LIKE 'C%' THEN 'conversation' WHEN d.event_type IN ('DS','DSG','DSS','DT','DYP','TS') THEN 'school' WHEN d.event_type = 'S' THEN 'seminar'
          WHEN d.event_type = 'T' THEN 'talk' WHEN d.event_type = 'D' THEN 'discussion' WHEN d.event_type = 'Q' THEN 'qa' ELSE 'recording' END AS kind,
        {_TIER.replace("event_type", "d.event_type")} AS tier,
        coalesce(upper(trim(d.event_type)) IN ('EBM','T','TS','TSS','TYP','TR','Q','S','SBR','D','DT','DS','DSS','CCT','IFV','DSG','DYP','DCO','DTV','WOL','HF') OR upper(trim(d.event_type))[1] IN ('F','C','I'), false) AS mapped,
        ({_TIER.replace("event_type", "d.event_type")}) <> 'X' AS included
      FROM d LEFT JOIN lab ON lab.event_type = d.event_type""",
    "item_texts": rf"""WITH {_IT}, x AS (SELECT *, lower(regexp_replace(regexp_replace(title, '[–—]', '-', 'g'), '&', '', 'g')) AS t, list_filter(string_split(regexp_replace(title, '[–—]', '-', 'g'), '-'), lambda p: trim(p) <> '') AS parts FROM it),
      y AS (SELECT *, CASE WHEN len(parts) > 0 THEN parts[-1] ELSE title END AS last FROM x)
      SELECT id, coalesce(nullif(substr(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(title)), '[^a-z0-9_\s-]', '', 'g'), '[-\s]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), ''), 'untitled') AS slug,
        CASE WHEN contains(summary, '. ') THEN split_part(summary, '. ', 1) || '.' WHEN contains(summary, '? ') THEN split_part(summary, '? ', 1) || '?' WHEN contains(summary, '! ') THEN split_part(summary, '! ', 1) || '!' ELSE summary END AS lead,
        trim(regexp_replace(regexp_replace(t, '[^a-z0-9 -]', '', 'g'), '\s+', ' ', 'g')) AS normal_title, trim(regexp_replace(regexp_replace(lower(regexp_replace(last, '&', '', 'g')), '[^a-z0-9 -]', '', 'g'), '\s+', ' ', 'g')) AS tail,
        len(regexp_extract_all(coalesce(summary, ''), '\S+')) AS summary_words, CASE WHEN series_order IS NOT NULL THEN lpad(CAST(series_order AS VARCHAR), 4, '0') || '-' || series_code ELSE series_code END AS folder,
        regexp_replace(future_path, '(?i)\.(m4a|mp3|mp4|webm|mkv)$', '') || '.mp4' AS video_path, coalesce(length(summary) > 0, false) AS has_summary FROM y""",
    "label_counts": f"WITH {_IT}, {_label_sql()} SELECT coalesce(lab.label, it.event_type, '') AS label, count(*) AS items, CAST(coalesce(sum(duration_minutes), 0) AS BIGINT) AS minutes FROM it LEFT JOIN lab ON lab.event_type = it.event_type GROUP BY 1",
    "top_types_with_tail": f"""WITH {_IT}, c AS (SELECT coalesce(event_type, '') AS e, count(*) AS n FROM it GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, e) AS place FROM c)
      SELECT CASE WHEN place <= 12 THEN e ELSE '(other)' END AS event_type, CAST(sum(n) AS BIGINT) AS items, count(*) AS types FROM r GROUP BY 1""",
    "series_rollup": f"WITH {_SERIES} SELECT * FROM se",
    "series_labels": f"WITH {_SERIES} SELECT series_code, mega_group, episodes, CASE WHEN year_from IS NULL THEN '' WHEN year_from = year_to THEN CAST(year_from AS VARCHAR) ELSE year_from || '–' || year_to END AS years FROM se",
    "first_appearance": f"WITH {_IT} SELECT id, min(pdf_order) OVER (PARTITION BY series_code) AS series_first, row_number() OVER (PARTITION BY series_code ORDER BY pdf_order NULLS LAST, id) AS episode FROM it WHERE series_code IS NOT NULL AND trim(series_code) <> ''",
    "group_counts": f"WITH {_IT} SELECT s.title AS section, mega_group, count(*) AS items, count(DISTINCT series_code) AS series, count(DISTINCT place_name) AS places FROM it LEFT JOIN sections s ON s.id = it.section_id GROUP BY 1, 2",
    "best_subtitle": """SELECT item_id, arg_min(id, (CASE language WHEN 'en' THEN 1 WHEN 'en-GB' THEN 2 WHEN 'en-US' THEN 3 ELSE CASE WHEN language LIKE 'en%' THEN 10 ELSE 20 END END, coalesce(language, '~'), id)) AS subtitle_id
      FROM (SELECT DISTINCT * FROM item_subtitles) WHERE status = 'downloaded' AND item_id IS NOT NULL GROUP BY item_id""",
    "ingest_scope": f"WITH {_IT} SELECT it.id, it.code, it.event_type, it.duration_minutes, s.id AS subtitle_id, s.language FROM it JOIN (SELECT DISTINCT * FROM item_subtitles) s ON s.item_id = it.id AND s.kind = 'manual' AND s.status = 'downloaded' AND s.language IN ('en', 'en-GB') WHERE corpus_include = 1",
    "work_list": f"""WITH {_IT}, x AS (SELECT *, coalesce(event_type IN ('T', 'TS', 'TYP'), false) AS talk FROM it WHERE deleted_at IS NULL AND id NOT IN (SELECT item_id FROM item_subtitles WHERE item_id IS NOT NULL))
      SELECT id, code, talk, coalesce(pdf_order, 2147483647) AS sort_order, dense_rank() OVER (PARTITION BY talk ORDER BY pdf_order NULLS LAST, id) AS place FROM x""",
    "missing_video": f"WITH {_IT}, m AS (SELECT item_id, max(status) AS status FROM item_media WHERE media = 'video' GROUP BY item_id) SELECT it.id, it.code, coalesce(m.status, 'pending') AS status FROM it LEFT JOIN m ON m.item_id = it.id WHERE coalesce(m.status, 'pending') <> 'downloaded'",
    "low_bitrate": f"WITH {_IT}, m AS (SELECT DISTINCT * FROM item_media), x AS (SELECT m.id, m.item_id, m.media, round(m.file_size * 8.0::DOUBLE / 1000.0::DOUBLE / (it.duration_minutes * 60.0::DOUBLE), 3) AS kbps FROM m JOIN it ON it.id = m.item_id WHERE m.file_size IS NOT NULL AND it.duration_minutes > 0) SELECT * FROM x WHERE kbps < 64",
    "newest_media": "SELECT id, item_id, media, row_number() OVER (PARTITION BY item_id ORDER BY downloaded_at DESC NULLS LAST, id) AS place FROM (SELECT DISTINCT * FROM item_media) WHERE item_id IS NOT NULL QUALIFY place <= 2",
    "missing_transcripts": f"WITH {_IT} SELECT id, code FROM it WHERE corpus_include = 1 AND upper(trim(code)) NOT IN (SELECT upper(trim(item_code)) FROM transcripts WHERE item_code IS NOT NULL)",
    "shared_sources": "WITH t AS (SELECT DISTINCT id, source_path FROM transcripts) SELECT id, source_path FROM t WHERE source_path IN (SELECT source_path FROM t GROUP BY source_path HAVING count(*) > 1)",
    "code_sets": f"""WITH {_IT}, a AS (SELECT DISTINCT upper(trim(code)) AS code FROM it WHERE trim(code) <> ''), b AS (SELECT DISTINCT upper(trim(item_code)) AS code FROM transcripts WHERE trim(item_code) <> '')
      SELECT code, CASE WHEN a.code IS NULL THEN 'transcripts' WHEN b.code IS NULL THEN 'catalogue' ELSE 'both' END AS side FROM a FULL JOIN b USING (code)""",
    "compact_list": f"""WITH {_IT} SELECT 'series' AS row_kind, series_code AS key, count(*) AS episodes, CAST(coalesce(sum(duration_minutes), 0) AS BIGINT) AS minutes FROM it WHERE trim(series_code) <> '' GROUP BY series_code
      UNION ALL SELECT 'item', code, 1, CAST(coalesce(duration_minutes, 0) AS BIGINT) FROM it WHERE series_code IS NULL OR trim(series_code) = ''""",
    "tier_changes": f"""WITH {_IT}, x AS (SELECT 'items' AS held_in, id, corpus_tier, corpus_include, {_TIER} AS tier FROM it), y AS (SELECT *, CAST(tier <> 'X' AS INT) AS include FROM x
      UNION ALL SELECT 'transcripts', id, corpus_tier, NULL, {_TIER}, NULL FROM (SELECT DISTINCT * FROM transcripts)) SELECT held_in, id, tier, include FROM y WHERE corpus_tier IS DISTINCT FROM tier OR corpus_include IS DISTINCT FROM include""",
    "item_changes": f"""WITH {_IT}, {_FIRST}, d AS (SELECT id, title, place_name FROM it WHERE deleted_at IS NULL), c AS (SELECT id, title, place_name FROM fi WHERE media_type IS NOT NULL)
      SELECT id, CASE WHEN c.rowid_ IS NULL THEN 'insert' WHEN d.rowid_ IS NULL THEN 'delete' WHEN c.title IS NOT DISTINCT FROM d.title AND c.place_name IS NOT DISTINCT FROM d.place_name THEN 'keep' ELSE 'update' END AS change
      FROM (SELECT *, 1 AS rowid_ FROM c) c FULL JOIN (SELECT *, 1 AS rowid_ FROM d) d USING (id)""",
    "item_versions": f"WITH {_IT}, {_FIRST} SELECT it.id, 2 AS version, it.title, it.place_name, it.deleted_at FROM it JOIN fi USING (id) WHERE it.title IS DISTINCT FROM fi.title OR it.place_name IS DISTINCT FROM fi.place_name OR it.deleted_at IS DISTINCT FROM fi.deleted_at",
    "media_upsert": """WITH m AS (SELECT DISTINCT id, item_id, media, status, file_size FROM item_media WHERE item_id IS NOT NULL),
      x AS (SELECT item_id, media, arg_min(file_size, id) FILTER (true) AS f0, max(id) AS id, min(id) AS first_id FROM m GROUP BY ALL)
      SELECT x.item_id, x.media, x.id, l.status, coalesce(l.file_size, f.file_size) AS file_size FROM x JOIN m l ON l.id = x.id JOIN m f ON f.id = x.first_id""",
    "subtitle_insert": """WITH s AS (SELECT DISTINCT item_id, language, kind, id FROM item_subtitles WHERE item_id IS NOT NULL)
      SELECT item_id, language, kind, id FROM s WHERE kind = 'manual'
      UNION ALL SELECT item_id, language, kind, id FROM s o WHERE kind <> 'manual' AND NOT EXISTS (SELECT 1 FROM s m WHERE m.kind = 'manual' AND m.item_id = o.item_id AND m.language = o.language)
      QUALIFY row_number() OVER (PARTITION BY item_id, language ORDER BY kind, id) = 1""",
    "best_rows": f"""WITH {_IT}, g AS (SELECT title, min(id) AS id, list_reduce(list({{'m': media_type, 'd': duration_minutes}} ORDER BY id), lambda a, b: CASE WHEN (b.m IS NOT NULL AND a.m IS NULL) OR (b.d IS NOT NULL AND a.d IS NULL) THEN b ELSE a END) AS x
      FROM it WHERE title IS NOT NULL GROUP BY title) SELECT title, id, x.m AS media_type, x.d AS duration_minutes FROM g""",
}
