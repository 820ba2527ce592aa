"""Reproducible stratified samples with weights."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import size_in_bytes


def allocate(sizes: DataFrame, stratum: str, size: int) -> DataFrame:
    """stratum, members, quota: one for each, the rest by members less one, remainders to the largest fractions (of ties the first stratum).

    `sizes` has the stratum and `members`. A sample smaller than the number of
    strata is an error; one larger than the frame takes all.
    """
    totals = sizes.agg(F.count("*").alias("strata"), F.sum("members").alias("frame")).first()
    strata, frame = totals["strata"], totals["frame"] or 0
    if size < strata:
        raise ValueError(f"a sample of {size} can't hold {strata} strata")
    size = min(size, frame)
    rest, room = size - strata, frame - strata
    exact = (F.col("members") - 1) * F.lit(rest) / F.lit(room or 1)
    rows = sizes.select(stratum, "members", F.floor(exact).alias("whole"), (((F.col("members") - 1) * F.lit(rest)) % F.lit(room or 1)).alias("fraction"))
    given = rows.agg(F.coalesce(F.sum("whole"), F.lit(0)).alias("given"))
    # the strata are few: they were aggregated before
    rank = F.row_number().over(Window.orderBy(F.col("fraction").desc(), stratum))
    rows = rows.withColumn("rank", rank).join(F.broadcast(given))
    extra = ((F.col("rank") <= F.lit(rest) - F.col("given")) & (F.col("fraction") > 0)).cast("bigint")
    return rows.select(stratum, "members", (1 + F.col("whole") + extra).cast("bigint").alias("quota"))


def stratified_sample(frame: DataFrame, key: str, stratum: str, size: int, seed: int, slice_bytes: int = 8 << 20) -> DataFrame:
    """The frame's rows that are drawn, with sample_weight = members / quota.

    The draw is by the hash of seed and key: the same seed draws the same rows,
    whatever their order. A stratum's rows are ranked in two steps: counts per
    slice of the hash range find the slice in which its quota ends, and only that
    slice is ranked; so a stratum with a third of all rows is no single task. There
    are as many slices as the frame's size asks for, and the draw does not depend on
    their number.
    """
    digits = max(2, ceil(log(max(1, size_in_bytes(frame) // slice_bytes), 16)))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    rows = frame.withColumn("_draw", draw).withColumn("_slice", F.conv(F.substring("_draw", 1, digits), 16, 10).cast("bigint"))
    counts = rows.groupBy(stratum, "_slice").agg(F.count("*").alias("n"))
    sizes = counts.groupBy(stratum).agg(F.sum("n").alias("members"))
    quotas = allocate(sizes, stratum, size)
    upto = Window.partitionBy(stratum).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(quotas, stratum)
    placed = placed.filter("before < quota").select(stratum, "_slice", "before", "n", "quota", "members")
    chosen = rows.join(placed, [stratum, "_slice"])
    edge = F.col("before") + F.col("n") > F.col("quota")
    rank = F.row_number().over(Window.partitionBy(stratum, "_slice").orderBy("_draw", key))
    ranked = chosen.filter(edge).withColumn("_rank", rank).filter("before + _rank <= quota").drop("_rank")
    out = chosen.filter(~edge).unionByName(ranked)
    return out.withColumn("sample_weight", F.col("members") / F.col("quota")).drop("_draw", "_slice", "before", "n", "quota", "members")
