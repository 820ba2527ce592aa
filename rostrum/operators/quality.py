"""Data-quality gates: rules are queries for rows that break them, and are gathered before anything fails."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rules: dict[str, DataFrame]) -> DataFrame:
    """rule, detail of every row that breaks a rule; each rule's rows are shown by their columns."""
    parts = [df.select(F.lit(name).alias("rule"), F.to_json(F.struct(*df.columns)).alias("detail")) for name, df in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def require(rules: dict[str, DataFrame]) -> None:
    """An error that names all broken rules with their counts; rows stay on the executors."""
    counts = {r["rule"]: r["n"] for r in violations(rules).groupBy("rule").agg(F.count("*").alias("n")).collect()}
    if counts:
        raise ValueError("broken rules: " + ", ".join(f"{k} ({v})" for k, v in sorted(counts.items())))


def registry_rules(concepts: DataFrame, relations: DataFrame, aliases: DataFrame, known: DataFrame | None = None) -> dict[str, DataFrame]:
    """Rules of a concept registry: texts that must be there, unique slugs and aliases without regard to case, known states and relations, targets that exist."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    slugs = concepts.select(F.lower("slug").alias("key"))
    targets = slugs if known is None else slugs.unionByName(known.select(F.lower("slug").alias("key")))
    return {
        "missing_text": concepts.filter(blank("slug") | blank("name") | blank("definition")).select("slug"),
        "duplicate_slug": concepts.groupBy(F.lower("slug").alias("slug")).count().filter("count > 1"),
        "unknown_status": concepts.filter(~F.coalesce(F.col("status").isin("pilot", "active", "deprecated"), F.lit(False))).select("slug", "status"),
        "duplicate_alias": aliases.groupBy(F.lower("slug").alias("slug"), F.lower("alias").alias("alias")).count().filter("count > 1"),
        "unknown_relation": relations.filter(~F.coalesce(F.col("relation").isin("broader", "related", "contrasts_with"), F.lit(False))).select("slug", "relation"),
        "self_relation": relations.filter(F.lower("slug") == F.lower("target")).select("slug"),
        "duplicate_relation": relations.groupBy(F.lower("slug").alias("slug"), F.lower("target").alias("target"), "relation").count().filter("count > 1"),
        "unknown_target": relations.withColumn("key", F.lower("target")).join(targets.distinct(), "key", "left_anti").select("slug", "target"),
    }


def not_shrunk(before: int, after: int, share: float = 0.98) -> bool:
    """Whether a rebuilt table kept at least this share of its rows."""
    return after >= share * before


def citation_states(cites: DataFrame, segments: DataFrame, links: DataFrame, speaker: str = "K", width: float = 2.0) -> DataFrame:
    """cite_id, state and the segment a citation resolves to: within `width` seconds in its item, the speaker's own first, then the nearest, then the first id.

    States, the first that holds: no_segments, drifted (none within the width),
    not_speaker, synthetic, no_link, resolved.
    """
    from rostrum.operators.joins import band_join

    near = band_join(cites.select("cite_id", "item_code", F.col("t_start").alias("cited_at")), segments.select("item_code", "segment_id", "speaker_code", "timestamps_synthetic", F.col("t_start").alias("at")), ["item_code"], "cited_at", "at", width)
    rank = F.struct((~F.col("speaker_code").eqNullSafe(F.lit(speaker))).alias("other"), F.abs(F.col("at") - F.col("cited_at")).alias("d"), "segment_id")
    best = near.groupBy("cite_id").agg(F.min_by(F.struct("segment_id", "speaker_code", "timestamps_synthetic"), rank).alias("x"))
    items = segments.select("item_code").distinct().withColumn("has_segments", F.lit(True))
    linked = links.select("item_code").distinct().withColumn("has_link", F.lit(True))
    rows = cites.select("cite_id", "item_code").join(best, "cite_id", "left").join(items, "item_code", "left").join(linked, "item_code", "left")
    state = (
        F.when(F.col("has_segments").isNull(), "no_segments").when(F.col("x").isNull(), "drifted").when(~F.col("x.speaker_code").eqNullSafe(F.lit(speaker)), "not_speaker")
        .when(F.col("x.timestamps_synthetic") == 1, "synthetic").when(F.col("has_link").isNull(), "no_link").otherwise("resolved")
    )
    return rows.select("cite_id", state.alias("state"), F.col("x.segment_id").alias("segment_id"))


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))
