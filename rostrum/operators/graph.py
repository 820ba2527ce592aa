"""Components and links of graphs kept as edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.session import materialize


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the least node that it is connected with, by alternating large and small stars.

    Each round is written to the shared folder; their number is logarithmic in the
    size of the largest component. Loops and repeated edges are ignored.
    """
    pairs = edges.select(F.greatest(F.col(a), F.col(b)).alias("a"), F.least(F.col(a), F.col(b)).alias("b")).filter("a is not null and b is not null and a <> b")
    now = materialize(pairs.distinct(), "component-stars")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        centre = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(centre, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        then = materialize(small.filter("a <> b").distinct(), "component-stars")
        done = then.exceptAll(now).isEmpty() and now.exceptAll(then).isEmpty()
        now = then
        if done:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()


def dead_links(notes: DataFrame, name: str = "name", text: str = "text", pattern: str = r"\[\[([^\]|#]+)") -> DataFrame:
    """source, target of links between notes whose target is no note."""
    links = notes.select(F.col(name).alias("source"), F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), 1))).alias("target"))
    links = links.withColumn("target", F.trim("target"))
    return links.join(notes.select(F.col(name).alias("target")), "target", "left_anti").select("source", "target")
