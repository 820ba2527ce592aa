"""Queries that choose what to work on: strata, optional filters, kept notes, runs, gates, registry rules, figures per concept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions.text import decade, future_path, ordered_series_path, output_path
from rostrum.operators import selection as S
from rostrum.operators.evaluate import membership_differences, weighted_measures
from rostrum.operators.joins import PLACE_WORDS, link_scores
from rostrum.operators.quality import registry_rules, share, violations
from rostrum.operators.sync import restore_children
from rostrum.plans.catalogue import items
from rostrum.plans.corpus import ORACLE as CORPUS
from rostrum.plans.corpus import citation_check
from rostrum.plans.relational import _JUDGED, judgments
from rostrum.session import r6, table

SECTION, RESUME_FROM = "1a/", "H"


def footage_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What footage an item's medium means, and whether the item says so."""
    rows = items(spark, sf_dir).select("id", S.footage_type("media_type").alias("footage"), "footage_type")
    return rows.select("id", "footage", F.col("footage").eqNullSafe(F.col("footage_type")).alias("as_stated"))


def section_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of each item by its section's number, and whether the item says so."""
    sections = table(spark, sf_dir, "sections", F.col("id").alias("section_id"), "number")
    rows = items(spark, sf_dir).select("id", "section_id", "mega_group").join(sections, "section_id", "left").withColumn("group_id", S.section_group("number"))
    return rows.select("id", "number", "group_id", F.col("group_id").eqNullSafe(F.col("mega_group")).alias("as_stated"))


def evaluation_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the main speaker in manual transcripts of tiers A and B by stratum: the key, what it was made of (read back from the key), and its members."""
    spoken = table(spark, sf_dir, "segments", "id", "transcript_id", "speaker_code", "timestamps_synthetic").filter("speaker_code = 'K'").dropDuplicates(["id"])
    held = table(spark, sf_dir, "transcripts", "id", "item_code", "event_type", "corpus_tier", "kind").dropDuplicates(["id"]).filter("corpus_tier in ('A', 'B') and kind = 'manual'")
    rows = spoken.join(held.drop("kind").withColumnRenamed("id", "transcript_id"), "transcript_id")
    key = S.stratum_key(decade=decade(F.lit(None).cast("int"), F.upper(F.trim("item_code"))), event_type=F.col("event_type"), corpus_tier=F.col("corpus_tier"), timestamps_synthetic=F.col("timestamps_synthetic"))
    counts = rows.groupBy(key.alias("stratum")).agg(F.count("*").alias("members"))
    return counts.select("stratum", *S.stratum_columns("stratum"), "members")


def resumed_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of one section's folder, from a code on, without a subtitle file of more than fifty bytes."""
    chosen = S.select_items(items(spark, sf_dir).select("id", "code", "future_path"), path_prefix=SECTION, from_code=RESUME_FROM)
    return S.without_files(chosen.withColumnRenamed("id", "item_id"), table(spark, sf_dir, "item_subtitles", "item_id", "file_size"), "item_id").select("item_id", "code")


def kept_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of items after a new discovery among the items of section 1A: those with a tape's note stay, the others of the section come from the media table."""
    rows = items(spark, sf_dir).filter("code is not null")
    current = rows.select("code", F.col("media_type").alias("kind"), F.col("id").alias("target"), "notes").filter("kind is not null")
    scope = S.select_items(rows.select("code", "future_path"), path_prefix=SECTION)
    found = table(spark, sf_dir, "item_media").distinct().join(rows.select(F.col("id").alias("item_id"), "code").join(scope.select("code").distinct(), "code"), "item_id")
    found = found.select("code", F.col("media").alias("kind"), F.col("id").alias("target"), F.lit(None).cast("string").alias("notes"))
    return S.rediscovered(current.groupBy("code", "kind").agg(F.min(F.struct("target", "notes")).alias("x")).select("code", "kind", "x.*"), found, ["code", "kind"], scope, kept="tape")


def kind_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of documents of one kind within each item, by id, and whether every kind has one run only."""
    rows = table(spark, sf_dir, "documents", "doc_id", "doc_kind", F.upper(F.trim("item_code")).alias("item")).filter("item <> ''")
    return S.runs(rows, "item", "doc_kind", ["doc_id"])


def section_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a list of each group's items in order of the catalogue begins a new table."""
    rows = items(spark, sf_dir).select("id", "mega_group", "section_id", F.coalesce("pdf_order", F.lit(1 << 40)).alias("at"))
    return S.table_breaks(rows, "mega_group", "section_id", ["at", "id"]).select("id", "opens")


def source_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source its documents, kinds in order of their first, years and items."""
    rows = table(spark, sf_dir, "documents", "doc_id", "source", "doc_kind", F.year("collected_at").alias("year"), F.upper(F.trim("item_code")).alias("item")).withColumn("source", F.coalesce("source", F.lit("")))
    found = S.concept_figures(rows, "source", "doc_kind", "year", "item", "doc_id")
    return found.select("source", "citations", F.array_join("themes", ",").alias("kinds"), "first_year", "last_year", "items", "first_at")


def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents have something in each facet."""
    return S.facet_coverage(table(spark, sf_dir, "documents", "lang", "source", "item_code", "doc_kind", "title"), ["lang", "source", "item_code", "doc_kind", "title"])


def stale_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts that were parsed before their item's last change, or whose item is gone."""
    notes = table(spark, sf_dir, "transcripts", "id", "item_code", "parsed_at").dropDuplicates(["id"]).filter("trim(item_code) <> ''").withColumn("code", F.upper(F.trim("item_code")))
    sources = items(spark, sf_dir).select(F.upper(F.trim("code")).alias("code"), "updated_at")
    found = S.stale_notes(notes.select("code", "parsed_at").distinct(), sources, "code", "parsed_at", "updated_at")
    return found.groupBy("code", "reason").agg(F.count("*").alias("notes"))


def catalogue_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What breaks the catalogue's rules, by rule: its rows of today against its rows with all versions."""
    versions = table(spark, sf_dir, "items", "id").count()
    rules = S.catalogue_gate(items(spark, sf_dir).select("code", "section_id", "pdf_order"), table(spark, sf_dir, "sections", "id"), versions)
    return violations(rules).groupBy("rule").agg(F.count("*").alias("broken"))


def registry_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's items as a registry: which rules they break, and how often."""
    rows = items(spark, sf_dir)
    concepts = rows.select(F.col("code").alias("slug"), F.col("title").alias("name"), F.col("summary").alias("definition"), F.when(F.col("corpus_include") == 1, "active").when(F.col("deleted_at").isNotNull(), "gone").alias("status"))
    aliases = rows.filter("event_number is not null").select(F.col("code").alias("slug"), F.col("event_number").alias("alias"))
    relations = rows.filter("series_code is not null").select(F.col("code").alias("slug"), F.col("series_code").alias("target"), F.when(F.col("series_order") == 1, "broader").otherwise("part_of").alias("relation"))
    return violations(registry_rules(concepts, relations, aliases)).groupBy("rule").agg(F.count("*").alias("broken"))


def restored_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media of a snapshot after the items were rebuilt under new ids: each with its new parent, found by code, or none."""
    old = items(spark, sf_dir).select(F.col("id").alias("item_id"), F.col("code").alias("item_code"))
    children = table(spark, sf_dir, "item_media", "id", "item_id").distinct().withColumnRenamed("id", "media_id").join(old, "item_id")
    rebuilt = items(spark, sf_dir).filter("deleted_at is null and code is not null").groupBy(F.col("code").alias("item_code")).agg((F.min("id") + 1_000_000).alias("id"))
    restored, orphans = restore_children(children, rebuilt, "item_code")
    return restored.select("media_id", "parent_id").unionByName(orphans.select("media_id", F.lit(None).cast("bigint").alias("parent_id")))


def import_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of an evaluation set that an import of it states otherwise: the set by all rows of the subtitles table, the import by its distinct rows with the size of the first."""
    rows = table(spark, sf_dir, "item_subtitles", "id", "item_id", "language", "file_size").filter("item_id is not null")
    imported = rows.groupBy("item_id", "language").agg(F.min_by("id", "id").alias("id"), F.min_by("file_size", "id").alias("file_size"))
    columns = ["id", "item_id", "language", "file_size"]
    return membership_differences(rows.select(*columns), imported.select(*columns)).groupBy("side", "language").agg(F.count("*").alias("members"))


def link_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to recordings, titled as a channel would (by title or by event, in turn), that may belong to an item, with their scores: by the titles, or by the event's number, among those that name one of its years and its place."""
    rows = items(spark, sf_dir)
    wanted = rows.select(F.col("id").alias("item_id"), "title", F.col("event_type_label").alias("event_label"), "event_number", "year", "code", "place_name")
    at = F.concat_ws(" ", "place_name", F.col("year").cast("string"))
    titled, numbered = F.concat_ws(" - ", at, "title"), F.concat_ws(", ", F.concat_ws(" ", "event_type_label", "event_number"), at)
    links = rows.select(F.col("id").alias("link_id"), F.when(F.col("id") % 2 == 0, titled).otherwise(numbered).alias("link_title"))
    return link_scores(wanted, links).filter("score > 0")


def media_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path that the catalogue plans for each item, with its series' folder in order, and where its downloads go."""
    sections = table(spark, sf_dir, "sections", F.col("id").alias("section_id"), F.col("slug").alias("section_slug"))
    rows = items(spark, sf_dir).select("id", "code", "title", "media_type", "series_code", "series_order", "section_id").join(sections, "section_id", "left")
    rows = rows.withColumn("path", future_path("section_slug", "code", "title", "media_type", "series_code"))
    return rows.select("id", "path", ordered_series_path("path", "series_code", "series_order").alias("ordered"), output_path("path", "video", "/media", "series_code").alias("video"), output_path("path", "mp3", "/media", "series_code").alias("sound"))


def definition_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted measures of what judgments call a definition against what long documents of the kind are held to be, by concept."""
    docs = table(spark, sf_dir, "documents", F.col("doc_id").alias("anchor_id"), "doc_kind", "n_chars")
    rows = judgments(spark, sf_dir).filter("outcome = 'completed'").join(docs, "anchor_id")
    pairs = rows.select("slug", F.col("definition_confidence").isNotNull().alias("predicted"), ((F.col("doc_kind") == F.col("slug")) & (F.col("n_chars") > 1500)).alias("gold"), F.when(F.col("n_chars") > 1000, 2.0).otherwise(1.0).alias("weight"))
    found = weighted_measures(pairs.na.fill(False), "slug", "predicted", "gold", "weight")
    return found.select("slug", *(r6(c).alias(c) for c in ("precision", "recall", "f1")))


def citation_faithfulness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations by state and the share of all that resolve to the main speaker's own words."""
    rows = citation_check(spark, sf_dir).groupBy("state").agg(F.count("*").alias("citations"))
    totals = rows.agg(F.sum("citations").alias("cited"), F.coalesce(F.sum(F.when(F.col("state") == "resolved", F.col("citations"))), F.lit(0)).alias("resolved"))
    return rows.join(F.broadcast(totals)).select("state", "citations", r6(share(F.col("resolved"), F.col("cited"))).alias("faithful"))


QUERIES = {
    "media_paths": media_paths, "definition_measures": definition_measures, "citation_faithfulness": citation_faithfulness,
    "link_candidates": link_candidates,
    "footage_types": footage_types, "section_groups": section_groups, "evaluation_frame": evaluation_frame, "resumed_work": resumed_work, "kept_notes": kept_notes, "kind_runs": kind_runs,
    "section_breaks": section_breaks, "source_figures": source_figures, "facets": facets, "stale_transcripts": stale_transcripts, "catalogue_gate": catalogue_gate,
    "registry_violations": registry_violations, "restored_media": restored_media, "import_check": import_check,
}

_IT = "it AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1)"
_TR = "tr AS (SELECT * FROM transcripts QUALIFY row_number() OVER (PARTITION BY id ORDER BY parsed_at) = 1)"
_GROUPS = ", ".join(f"({k}, '{v}')" for k, v in S.GROUPS.items())


def _normal(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(translate(lower({x}), '–—', '--'), '[^a-z0-9 -]+', '', 'g'), ' {{2,}}', ' ', 'g'))"


_LAST = "regexp_extract(translate(title, '–—', '--'), '([^-]*[^- ][^-]*)[- ]*$', 1)"
_LINKS = rf"""{_IT}, i AS (SELECT id AS item_id, {_normal("title")} AS t, {_normal("concat_ws(' ', event_type_label, event_number)")} AS phrase,
    list_filter(list_concat([{_normal("split_part(place_name, ',', 1)")}], list_filter({PLACE_WORDS}, lambda w: contains(lower(place_name), w))), lambda w: length(w) >= 4) AS places,
    regexp_extract(CASE WHEN contains(code, '-') AND NOT ends_with(code, '&2') THEN split_part(code, '-', 1) ELSE code END, '^[A-Z]{{2,3}}(\d{{0,4}})[A-Z]+.*$', 1) AS d1, regexp_extract(code, '^[A-Z]{{2,3}}(\d{{2,4}})', 1) AS d2, year FROM it),
  iy AS (SELECT *, list_filter([year, CASE WHEN length(d1) IN (2, 4) THEN 1900 + d1[:2]::INT END, CASE WHEN length(d2) = 2 THEN CASE WHEN d2::INT > 30 THEN 1900 ELSE 2000 END + d2::INT END, CASE WHEN length(d2) = 4 THEN 1900 + d2[:2]::INT END,
    CASE WHEN length(d2) = 4 THEN 1900 + d2[3:]::INT END], lambda y: y BETWEEN 1900 AND 2035) AS years FROM i),
  named AS (SELECT id AS link_id, CASE WHEN id % 2 = 0 THEN concat_ws(' - ', concat_ws(' ', place_name, year), title) ELSE concat_ws(', ', concat_ws(' ', event_type_label, event_number), concat_ws(' ', place_name, year)) END AS title FROM it),
  l AS (SELECT link_id, {_normal("title")} AS lt, {_normal(f"CASE WHEN {_LAST} <> '' THEN {_LAST} ELSE title END")} AS tail,
    list_filter(list_concat(list_transform(regexp_extract_all(title, '\b((?:19|20)\d{{2}})\b', 1), lambda y: y::INT), list_transform(regexp_extract_all(title, '\b(\d{{2}})/(\d{{2}})\b', 1), lambda y: 1900 + y::INT),
      list_transform(regexp_extract_all(title, '\b(\d{{2}})/(\d{{2}})\b', 2), lambda y: 1900 + y::INT)), lambda y: y BETWEEN 1900 AND 2035) AS named FROM named),
  sc AS (SELECT item_id, link_id, CASE WHEN len(places) > 0 AND NOT list_bool_or(list_transform(places, lambda w: contains(lt, w))) THEN 0.0::DOUBLE
    WHEN t <> '' AND (contains(lt, t[:20]) OR contains(t, tail[:25]) OR contains(tail, t[:25])) AND NOT regexp_full_match(t, '\d+(?:st|nd|rd|th)\s+question\s+and\s+answer\s+meeting') THEN 1.0::DOUBLE
    WHEN phrase <> '' AND contains(lt, phrase) THEN 0.88::DOUBLE ELSE 0.0::DOUBLE END AS score FROM iy, l WHERE len(years) = 0 OR list_has_any(years, named))"""

ORACLE = {
    "media_paths": rf"""WITH {_IT}, x AS (SELECT it.id, trim(series_code) AS sc, series_order AS so, concat_ws('/', 'library', s.slug, CASE WHEN trim(series_code) <> '' THEN series_code END,
        it.code || ' - ' || left(trim(regexp_replace(regexp_replace(coalesce(it.title, ''), '[<>:"/\|?*]', '', 'g'), '\s+', ' ', 'g')), 100) || '.' || CASE media_type WHEN 'video' THEN 'mp4' WHEN 'audio' THEN 'm4a' ELSE 'bin' END) AS path FROM it LEFT JOIN sections s ON s.id = it.section_id),
      y AS (SELECT *, string_split(path, '/') AS p, coalesce(sc, '') <> '' AS has FROM x), z AS (SELECT *, CASE WHEN len(p) = 3 AND has THEN p[2] || '/' || sc || '/' || p[3] ELSE array_to_string(p[2:], '/') END AS inside FROM y)
      SELECT id, path, CASE WHEN len(p) >= 4 AND has THEN 'library/' || p[2] || '/' || CASE WHEN so IS NOT NULL THEN lpad(so::VARCHAR, 4, '0') || '-' || sc ELSE sc END || '/' || p[-1] ELSE path END AS ordered,
        '/media/library/' || regexp_replace(inside, '\.m4a$', '.mp4') AS video, regexp_replace('/media/library/' || inside, '([^/])\.[^./]*$', '\1') || '.mp3' AS sound FROM z""",
    "definition_measures": f"""WITH {_JUDGED}, x AS (SELECT j.slug, j.definition_confidence IS NOT NULL AS p, coalesce(d.doc_kind = j.slug AND d.n_chars > 1500, false) AS g, CASE WHEN d.n_chars > 1000 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM jd j JOIN documents d ON d.doc_id = j.anchor_id WHERE outcome = 'completed'),
      s AS (SELECT slug, coalesce(sum(w) FILTER (p AND g), 0) AS tp, coalesce(sum(w) FILTER (p AND NOT g), 0) AS fp, coalesce(sum(w) FILTER (NOT p AND g), 0) AS fn FROM x GROUP BY slug)
      SELECT slug, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM s""",
    "citation_faithfulness": f"WITH q AS ({CORPUS['citation_check']}), g AS (SELECT state, count(*) AS citations FROM q GROUP BY state) SELECT state, citations, round(coalesce((SELECT sum(citations) FROM g WHERE state = 'resolved'), 0)::DOUBLE / (SELECT sum(citations) FROM g), 6) AS faithful FROM g",
    "link_candidates": f"WITH {_LINKS} SELECT item_id, link_id, score FROM sc WHERE score > 0",
    "footage_types": f"WITH {_IT}, x AS (SELECT id, CASE media_type WHEN 'audio' THEN 'audio_only' WHEN 'video' THEN 'video_footage' END AS footage, footage_type FROM it) SELECT id, footage, footage IS NOT DISTINCT FROM footage_type AS as_stated FROM x",
    "section_groups": f"WITH {_IT}, g(number, group_id) AS (VALUES {_GROUPS}) SELECT it.id, s.number, g.group_id, g.group_id IS NOT DISTINCT FROM it.mega_group AS as_stated FROM it LEFT JOIN sections s ON s.id = it.section_id LEFT JOIN g ON g.number = s.number",
    "evaluation_frame": f"""WITH {_TR}, x AS (SELECT DISTINCT s.id, s.timestamps_synthetic AS synth, regexp_extract(upper(trim(tr.item_code)), '\\d{{2}}') AS d, tr.event_type, tr.corpus_tier FROM segments s JOIN tr ON tr.id = s.transcript_id WHERE s.speaker_code = 'K' AND tr.corpus_tier IN ('A', 'B') AND tr.kind = 'manual'),
      y AS (SELECT CASE WHEN coalesce(d, '') = '' THEN 'unknown' ELSE ((1900 + d::INT) // 10 * 10) || 's' END AS decade, event_type, corpus_tier, CAST(synth AS INT) AS timestamps_synthetic FROM x)
      SELECT concat_ws('|', 'decade:' || decade, 'type:' || event_type, 'tier:' || corpus_tier, 'synth:' || timestamps_synthetic) AS stratum, decade, event_type, corpus_tier, timestamps_synthetic, count(*) AS members FROM y GROUP BY ALL""",
    "resumed_work": f"WITH {_IT} SELECT id AS item_id, code FROM it WHERE lower(future_path) LIKE '{SECTION}%' AND code >= '{RESUME_FROM}' AND id NOT IN (SELECT item_id FROM item_subtitles WHERE item_id IS NOT NULL AND file_size > 50)",
    "kept_notes": f"""WITH {_IT}, c AS (SELECT code, media_type AS kind, id AS target, notes FROM it WHERE code IS NOT NULL AND media_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code, media_type ORDER BY id) = 1),
      sc AS (SELECT DISTINCT code FROM it WHERE lower(future_path) LIKE '{SECTION}%'), f AS (SELECT it.code, m.media AS kind, min(m.id) AS target FROM item_media m JOIN it ON it.id = m.item_id JOIN sc ON sc.code = it.code GROUP BY ALL),
      kept AS (SELECT * FROM c WHERE coalesce(starts_with(notes, 'tape'), false) OR code NOT IN (SELECT code FROM sc WHERE code IS NOT NULL))
      SELECT * FROM kept UNION ALL SELECT f.code, f.kind, f.target, NULL FROM f ANTI JOIN kept ON kept.code = f.code AND kept.kind = f.kind""",
    "kind_runs": """WITH x AS (SELECT upper(trim(item_code)) AS item, doc_kind, CASE WHEN doc_kind IS NOT DISTINCT FROM lag(doc_kind) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS opens FROM documents WHERE trim(item_code) <> '' WINDOW w AS (PARTITION BY upper(trim(item_code)) ORDER BY doc_id))
      SELECT item, CAST(sum(opens) AS BIGINT) AS runs, count(DISTINCT doc_kind) + max((doc_kind IS NULL)::BIGINT) AS kinds, sum(opens) = count(DISTINCT doc_kind) + max((doc_kind IS NULL)::BIGINT) AS contiguous FROM x GROUP BY item""",
    "section_breaks": f"WITH {_IT} SELECT id, row_number() OVER w = 1 OR section_id IS DISTINCT FROM lag(section_id) OVER w AS opens FROM it WINDOW w AS (PARTITION BY mega_group ORDER BY pdf_order NULLS LAST, id)",
    "source_figures": """WITH d AS (SELECT coalesce(source, '') AS source, doc_kind, doc_id, year(collected_at) AS y, upper(trim(item_code)) AS item FROM documents), k AS (SELECT source, doc_kind, min(doc_id) AS first_doc FROM d WHERE doc_kind IS NOT NULL GROUP BY ALL),
      l AS (SELECT source, string_agg(doc_kind, ',' ORDER BY first_doc) AS kinds FROM k GROUP BY source)
      SELECT source, count(*) AS citations, coalesce(any_value(kinds), '') AS kinds, CAST(min(y) AS INT) AS first_year, CAST(max(y) AS INT) AS last_year, count(DISTINCT item) AS items, min(doc_id) AS first_at FROM d LEFT JOIN l USING (source) GROUP BY source""",
    "facets": " UNION ALL ".join(f"SELECT '{f}' AS facet, count(*) FILTER (trim({f}) <> '') AS filled, count(*) AS notes FROM documents" for f in ("lang", "source", "item_code", "doc_kind", "title")),
    "stale_transcripts": f"""WITH {_IT}, {_TR}, n AS (SELECT DISTINCT upper(trim(item_code)) AS code, parsed_at FROM tr WHERE trim(item_code) <> ''), s AS (SELECT upper(trim(code)) AS code, max(updated_at) AS changed FROM it WHERE code IS NOT NULL GROUP BY 1),
      x AS (SELECT n.code, CASE WHEN s.code IS NULL THEN 'gone' WHEN changed > parsed_at THEN 'changed' END AS reason FROM n LEFT JOIN s ON s.code = n.code) SELECT code, reason, count(*) AS notes FROM x WHERE reason IS NOT NULL GROUP BY ALL""",
    "catalogue_gate": f"""WITH {_IT}, b AS (SELECT count(*) AS n FROM items), r AS (SELECT 'shrunk' AS rule FROM b WHERE (SELECT count(*) FROM it) < 0.98 * n
      UNION ALL SELECT 'unknown_section' FROM it WHERE section_id IS NULL OR section_id NOT IN (SELECT id FROM sections) UNION ALL SELECT 'order_taken_twice' FROM (SELECT pdf_order FROM it WHERE pdf_order IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) SELECT rule, count(*) AS broken FROM r GROUP BY rule""",
    "registry_violations": f"""WITH {_IT}, c AS (SELECT code AS slug, title AS name, summary AS definition, CASE WHEN corpus_include = 1 THEN 'active' WHEN deleted_at IS NOT NULL THEN 'gone' END AS status FROM it),
      a AS (SELECT code AS slug, event_number AS alias FROM it WHERE event_number IS NOT NULL), l AS (SELECT code AS slug, series_code AS target, CASE WHEN series_order = 1 THEN 'broader' ELSE 'part_of' END AS relation FROM it WHERE series_code IS NOT NULL),
      r AS (SELECT 'missing_text' AS rule FROM c WHERE coalesce(trim(slug), '') = '' OR coalesce(trim(name), '') = '' OR coalesce(trim(definition), '') = '' UNION ALL SELECT 'duplicate_slug' FROM (SELECT lower(slug) FROM c GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT 'unknown_status' FROM c WHERE coalesce(status, '') NOT IN ('pilot', 'active', 'deprecated') UNION ALL SELECT 'duplicate_alias' FROM (SELECT lower(slug), lower(alias) FROM a GROUP BY 1, 2 HAVING count(*) > 1)
      UNION ALL SELECT 'unknown_relation' FROM l WHERE relation <> 'broader' UNION ALL SELECT 'self_relation' FROM l WHERE lower(slug) = lower(target) UNION ALL SELECT 'duplicate_relation' FROM (SELECT lower(slug), lower(target), relation FROM l GROUP BY 1, 2, 3 HAVING count(*) > 1)
      UNION ALL SELECT 'unknown_target' FROM l WHERE lower(target) NOT IN (SELECT lower(slug) FROM c WHERE slug IS NOT NULL)) SELECT rule, count(*) AS broken FROM r GROUP BY rule""",
    "restored_media": f"""WITH {_IT}, p AS (SELECT code, min(id) + 1000000 AS id FROM it WHERE deleted_at IS NULL AND code IS NOT NULL GROUP BY code), m AS (SELECT DISTINCT id, item_id FROM item_media)
      SELECT m.id AS media_id, p.id AS parent_id FROM m JOIN it ON it.id = m.item_id LEFT JOIN p ON p.code = it.code""",
    "import_check": """WITH s AS (SELECT id, item_id, language, file_size FROM item_subtitles WHERE item_id IS NOT NULL), i AS (SELECT id, item_id, language, file_size FROM s QUALIFY row_number() OVER (PARTITION BY item_id, language ORDER BY id) = 1),
      d AS (SELECT 'existing' AS side, language FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM i) UNION ALL SELECT 'imported', language FROM (SELECT * FROM i EXCEPT ALL SELECT * FROM s)) SELECT side, language, count(*) AS members FROM d GROUP BY ALL""",
}
