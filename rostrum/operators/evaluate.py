"""Judgments of models: import with validation, outcomes, accepted tags, weighted measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.session import lookup_rows

# What a judgment may say.
RELEVANCE = ["substantive", "mention_only", "not_relevant"]
DEFINITION = ["yes", "partial", "no", "not_applicable"]
CONFIDENCE = {"low": 0.33, "medium": 0.67, "high": 1.0}
LONGEST_RATIONALE = 300
JUDGMENT = "map<string, struct<relevance string, confidence string, definition_like string, rationale string>>"


def import_judgments(results: DataFrame, concepts: DataFrame, anchors: DataFrame) -> DataFrame:
    """anchor_id, slug, outcome, relevance, confidence, definition_like: one row per result and concept.

    `results` has custom_id, type ('succeeded' or another) and text, a JSON object
    with exactly one judgment per concept. A failed result is an api_error for
    every concept, a text that can't be read or breaks the form a parse_error for
    every concept. Results of unknown anchors are left out; of several results of
    one anchor the last by text holds.
    """
    slugs = sorted(r[0] for r in lookup_rows(concepts.select("slug").distinct()))
    known = anchors.select(F.col("anchor_id"), F.col("anchor_id").cast("string").alias("custom_id"))
    rows = results.join(known, "custom_id").groupBy("anchor_id").agg(F.max_by(F.struct("type", "text"), F.coalesce("text", F.lit(""))).alias("r"))
    parsed = F.from_json("r.text", JUDGMENT)
    rows = rows.select("anchor_id", F.col("r.type").alias("type"), parsed.alias("judged"))
    wanted = F.array(*(F.lit(s) for s in slugs)).cast("array<string>")
    one = lambda v: v["relevance"].isin(RELEVANCE) & v["confidence"].isin(list(CONFIDENCE)) & v["definition_like"].isin(DEFINITION) & v["rationale"].isNotNull() & (F.length(v["rationale"]) <= LONGEST_RATIONALE)
    keys = F.map_keys("judged")
    whole = F.col("judged").isNotNull() & (F.size(F.array_except(keys, wanted)) == 0) & (F.size(F.array_except(wanted, keys)) == 0)
    whole = whole & F.forall(F.map_values("judged"), lambda v: F.coalesce(one(v), F.lit(False)))
    outcome = F.when(F.col("type") != "succeeded", "api_error").when(F.coalesce(whole, F.lit(False)), "completed").otherwise("parse_error")
    rows = rows.withColumn("outcome", outcome).withColumn("slug", F.explode(wanted))
    said = F.when(F.col("outcome") == "completed", F.try_element_at("judged", F.col("slug")))
    rows = rows.withColumn("said", said)
    number = F.create_map(*(F.lit(x) for kv in CONFIDENCE.items() for x in kv))
    sure = F.try_element_at(number, F.col("said.confidence"))
    return rows.select(
        "anchor_id", "slug", "outcome", F.col("said.relevance").alias("relevance"), sure.alias("confidence"), F.col("said.definition_like").alias("definition_like"),
        F.when(F.col("said.definition_like") != "not_applicable", sure).alias("definition_confidence"),
    )


def accepted_tags(predictions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Pairs that a completed judgment calls substantive and an adjudication accepts."""
    chosen = predictions.filter("outcome = 'completed' and relevance = 'substantive'").select("anchor_id", "slug").distinct()
    return chosen.join(verdicts.filter("verdict = 'accept'"), ["anchor_id", "slug"], "left_semi")


def weighted_measures(pairs: DataFrame, group: str, predicted: str, gold: str, weight: str) -> DataFrame:
    """Weighted precision, recall and F1 per group, 0 where undefined."""
    w = lambda c: F.coalesce(F.sum(F.when(c, F.col(weight))), F.lit(0.0))
    p, g = F.col(predicted), F.col(gold)
    sums = pairs.groupBy(group).agg(w(p & g).alias("tp"), w(p & ~g).alias("fp"), w(~p & g).alias("fn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(group, ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def requests(passages: DataFrame, concepts: DataFrame, model: str, instruction: str) -> DataFrame:
    """custom_id, body: one request per anchor, a JSON text with the concepts in order; passages have anchor_id and text, concepts slug and definition."""
    listed = sorted((r[0], r[1] or "") for r in lookup_rows(concepts.select("slug", "definition").distinct()))
    guide = "\n".join([instruction, *(f"- {slug}: {definition}" for slug, definition in listed)])
    body = F.to_json(F.struct(F.lit(model).alias("model"), F.lit(guide).alias("system"), F.col("text").alias("user"), F.array(*(F.lit(s) for s, _ in listed)).cast("array<string>").alias("slugs")))
    return passages.filter("anchor_id is not null and text is not null").select(F.col("anchor_id").cast("string").alias("custom_id"), body.alias("body"))


def membership_differences(existing: DataFrame, imported: DataFrame) -> DataFrame:
    """Rows of two versions of one evaluation set that only one of them has, counting repeats, with the side that has them."""
    imported = imported.select(*existing.columns)
    lost, new = existing.exceptAll(imported), imported.exceptAll(existing)
    return lost.withColumn("side", F.lit("existing")).unionByName(new.withColumn("side", F.lit("imported")))
