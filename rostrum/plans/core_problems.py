"""The core problems over the tables of the transcript project: p1 (intervals) and p6 (orphans)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators.intervals import periods_and_gaps
from rostrum.operators.orphans import Parent, Reference, orphan_counts, orphans
from rostrum.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods_and_gaps(table(spark, sf_dir, "segments"), "transcript_id", "t_start", "t_end", "timestamps_synthetic")
    return found.withColumnRenamed("owner", "transcript_id")


def p1_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoken and silent time per transcript, from its periods and gaps."""
    length = F.col("end_ms") - F.col("start_ms")
    total = lambda kind: F.coalesce(F.sum(F.when(F.col("period_kind") == kind, length)), F.lit(0)).cast("bigint")
    return p1_found(spark, sf_dir).groupBy("transcript_id").agg(
        F.count_if(F.col("period_kind") == "period").alias("periods"), total("period").alias("period_ms"),
        total("gap").alias("gap_ms"), total("gap_synthetic").alias("gap_synthetic_ms"),
    )


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name, *columns: table(spark, sf_dir, name, *columns)
    items = t("items", "id", "code", "added_at", "updated_at", "deleted_at")
    transcripts = t("transcripts", "id", "item_code", "parsed_at")
    return orphans(
        [
            Reference("transcripts", transcripts, "id", "item_code", "parsed_at", "items.code"),
            Reference("segments", t("segments", "id", "transcript_id", "loaded_at"), "id", "transcript_id", "loaded_at", "transcripts.id"),
            Reference("item_subtitles", t("item_subtitles", "id", "item_id", "probed_at"), "id", "item_id", "probed_at", "items.id"),
            Reference("item_media", t("item_media", "id", "item_id", "downloaded_at"), "id", "item_id", "downloaded_at", "items.id"),
        ],
        [
            Parent("items.code", items, "code", "added_at", "deleted_at", "updated_at", "id"),
            Parent("items.id", items, "id", "added_at", "deleted_at", "updated_at", "id"),
            Parent("transcripts.id", transcripts, "id", "parsed_at"),
        ],
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).select("ref_table", "row_id", "orphan_state")


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_counts(_orphans(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p1_coverage": p1_coverage, "p6_found": p6_found, "p6_counts": p6_counts}

_P1 = """
iv AS (
  SELECT transcript_id, timestamps_synthetic AS kind, CAST(round(t_start * 1000) AS BIGINT) AS s, CAST(round(t_end * 1000) AS BIGINT) AS e
  FROM segments WHERE transcript_id IS NOT NULL AND t_start IS NOT NULL AND t_end IS NOT NULL),
realiv AS (SELECT DISTINCT transcript_id, s, e FROM iv WHERE kind = 0 AND e > s),
syn AS (SELECT DISTINCT transcript_id, s, e FROM iv WHERE kind = 1 AND e > s),
seen AS (SELECT *, max(e) OVER (PARTITION BY transcript_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM realiv),
numbered AS (SELECT *, sum(CASE WHEN latest IS NULL OR s > latest + 1500 THEN 1 ELSE 0 END) OVER (PARTITION BY transcript_id ORDER BY s, e) AS island FROM seen),
period AS (SELECT transcript_id, island, min(s) AS start_ms, max(e) AS end_ms FROM numbered GROUP BY ALL),
hole AS (SELECT transcript_id, end_ms AS a, lead(start_ms) OVER (PARTITION BY transcript_id ORDER BY start_ms) AS b FROM period),
found AS (
  SELECT transcript_id, 'period' AS period_kind, start_ms, end_ms FROM period
  UNION ALL
  SELECT transcript_id, CASE WHEN EXISTS (SELECT 1 FROM syn WHERE syn.transcript_id = hole.transcript_id AND syn.s < hole.b AND syn.e > hole.a) THEN 'gap_synthetic' ELSE 'gap' END, a, b
  FROM hole WHERE b IS NOT NULL)
"""

_P6 = """
it AS (SELECT id, code, added_at, deleted_at FROM items QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC NULLS LAST, deleted_at DESC NULLS LAST) = 1),
refs AS (
  SELECT 'transcripts' AS ref_table, t.id AS row_id, t.seen, t.key IS NOT NULL AND i.id IS NULL AS missing, i.deleted_at IS NOT NULL AS deleted, i.added_at AS since
  FROM (SELECT id, nullif(upper(trim(item_code)), '') AS key, min(parsed_at) AS seen FROM transcripts GROUP BY ALL) t LEFT JOIN it i ON upper(trim(i.code)) = t.key WHERE t.key IS NOT NULL
  UNION ALL
  SELECT 'segments', s.id, s.seen, t.id IS NULL, false, t.since
  FROM (SELECT id, transcript_id, min(loaded_at) AS seen FROM segments GROUP BY ALL) s LEFT JOIN (SELECT id, min(parsed_at) AS since FROM transcripts GROUP BY id) t ON t.id = s.transcript_id WHERE s.transcript_id IS NOT NULL
  UNION ALL
  SELECT 'item_subtitles', s.id, s.seen, i.id IS NULL, i.deleted_at IS NOT NULL, i.added_at
  FROM (SELECT id, item_id, min(probed_at) AS seen FROM item_subtitles GROUP BY ALL) s LEFT JOIN it i ON i.id = s.item_id WHERE s.item_id IS NOT NULL
  UNION ALL
  SELECT 'item_media', s.id, s.seen, i.id IS NULL, i.deleted_at IS NOT NULL, i.added_at
  FROM (SELECT id, item_id, min(downloaded_at) AS seen FROM item_media GROUP BY ALL) s LEFT JOIN it i ON i.id = s.item_id WHERE s.item_id IS NOT NULL),
found AS (
  SELECT ref_table, row_id, CASE WHEN missing THEN 'missing' WHEN deleted THEN 'deleted' ELSE 'late' END AS orphan_state, CAST(date_trunc('month', seen) AS DATE) AS period
  FROM refs WHERE missing OR deleted OR since > seen)
"""

ORACLE = {
    "p1_found": f"WITH {_P1} SELECT transcript_id, period_kind, start_ms, end_ms FROM found",
    "p1_coverage": f"""WITH {_P1} SELECT transcript_id, count(*) FILTER (period_kind = 'period') AS periods,
      CAST(coalesce(sum(end_ms - start_ms) FILTER (period_kind = 'period'), 0) AS BIGINT) AS period_ms,
      CAST(coalesce(sum(end_ms - start_ms) FILTER (period_kind = 'gap'), 0) AS BIGINT) AS gap_ms,
      CAST(coalesce(sum(end_ms - start_ms) FILTER (period_kind = 'gap_synthetic'), 0) AS BIGINT) AS gap_synthetic_ms
      FROM found GROUP BY transcript_id""",
    "p6_found": f"WITH {_P6} SELECT ref_table, row_id, orphan_state FROM found",
    "p6_counts": f"WITH {_P6} SELECT ref_table, period, orphan_state, count(*) AS orphans FROM found GROUP BY ALL",
}
