"""WEBVTT subtitles: files to cues, in SQL expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# How a time, a timing line and a label are written.
_TIME = r"(\d{2}):(\d{2}):(\d{2})[.,](\d{3})"
TIMING = rf"{_TIME}\s*-->\s*{_TIME}"
LABEL = r"(?s)^([A-Za-z][A-Za-z0-9 .'’-]{0,30}?):(\s*)(.*)$"


def read_files(spark: SparkSession, glob: str) -> DataFrame:
    """path and text of whole files, a byte-order mark stripped."""
    rows = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.withColumn("text", F.regexp_replace("text", "^﻿", ""))


def seconds(line: Column, first_group: int, pattern: str = TIMING) -> Column:
    g = lambda i: F.regexp_extract(line, pattern, first_group + i).cast("int")
    return F.when(line.rlike(pattern), g(0) * 3600 + g(1) * 60 + g(2) + g(3) / 1000.0)


def parse_cues(files: DataFrame, key: str = "path", text: str = "text", tight_labels: list[str] = ()) -> DataFrame:
    """key, cue_seq, t_start, t_end, text, label, rest of every cue.

    Blocks are parted by blank lines. A block's first line with an arrow is its
    timing; blocks without one, or with one that can't be read, are no cues. The
    lines after it are joined, tags are taken out. A label is what stands before
    the first colon if a blank or the end follows, or if it is one of
    `tight_labels` or a short word in capitals.
    """
    plain = F.regexp_replace(text, "\r\n?", "\n")
    blocks = files.select(key, F.posexplode(F.split(plain, r"\n\s*\n")).alias("block", "body"))
    lines = F.filter(F.split("body", "\n"), lambda x: F.trim(x) != "")
    arrow = F.transform(lines, lambda x: x.contains("-->"))
    at = F.array_position(arrow, True).cast("int")
    blocks = blocks.withColumn("lines", lines).withColumn("at", at).filter("at > 0")
    timing = F.try_element_at("lines", F.col("at"))
    blocks = blocks.withColumn("timing", timing).filter(F.col("timing").rlike(TIMING))
    said = F.array_join(F.transform(F.slice(F.col("lines"), F.col("at") + 1, F.greatest(F.size("lines") - F.col("at"), F.lit(0))), lambda x: F.trim(x)), " ")
    cues = blocks.select(key, "block", seconds(F.col("timing"), 1).alias("t_start"), seconds(F.col("timing"), 5).alias("t_end"), F.regexp_replace(F.trim(said), r"<[^>]+>", "").alias("text"))
    name, gap, tail = (F.regexp_extract("text", LABEL, i) for i in (1, 2, 3))
    tight = F.lower(F.trim(name)).isin(list(tight_labels)) if tight_labels else F.lit(False)
    short = name.rlike(r"^\s*[A-Z][A-Z0-9 .]{0,3}\s*$") & ~name.rlike("[a-z]")
    labelled = F.col("text").rlike(LABEL) & ((gap != "") | (tail == "") | tight | short)
    cues = cues.withColumn("label", F.when(labelled, F.trim(name))).withColumn("rest", F.when(labelled, F.trim(tail)).otherwise(F.col("text")))
    order = Window.partitionBy(key).orderBy("block")
    return cues.select(key, F.row_number().over(order).alias("cue_seq"), "t_start", "t_end", "text", "label", "rest")


def last_timestamp(files: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """key and the end time of the last timing in the file (the last, not the greatest); null without one."""
    found = F.regexp_extract_all(F.col(text), F.lit(rf"-->\s*({_TIME})"), 1)
    last = F.try_element_at(found, F.lit(-1))
    return files.select(key, seconds(last, 1, _TIME).alias("duration_secs"))


def duration_fits(actual: Column, expected_minutes: Column) -> Column:
    """Whether two durations differ by at most three minutes or eight in a hundred; false if either is unknown, as a runtime of 0 is too."""
    expected = expected_minutes * 60.0
    return F.coalesce((expected != 0) & (F.abs(actual - expected) <= F.greatest(F.lit(180.0), 0.08 * expected)), F.lit(False))


#: Letters of a file's code by which a recording's base code is looked up.
CODE_LETTERS = 16


def resolve_sources(items: DataFrame, listing: DataFrame) -> DataFrame:
    """code, path, resolved_via for every item: its own file, else the first sibling whose duration fits, else 'missing'.

    `items` has code and duration_minutes, `listing` has path, code (of the file
    name) and duration_secs. The siblings of 'X.2' are tried in order: the files of
    'X', English before British English before others, then files whose code begins
    with 'X', each by path. A file is met by the beginnings of its code, one row
    each, so no place's items meet all files of the place.
    """
    wanted = items.select("code", "duration_minutes", F.substring_index("code", ".", 1).alias("base"))
    files = listing.select(F.col("code").alias("file_code"), "path", "duration_secs")
    own = wanted.join(files, F.col("code") == F.col("file_code")).select("code", "path", F.lit("direct").alias("via"), F.lit(0).alias("rank"))
    begun = files.withColumn("base", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.greatest(F.length("file_code"), F.lit(1)), F.lit(CODE_LETTERS))), lambda n: F.substr("file_code", F.lit(1), n))))
    siblings = wanted.join(begun, "base").filter(F.col("file_code") != F.col("code")).filter(duration_fits(F.col("duration_secs"), F.col("duration_minutes")))
    same = F.col("file_code") == F.col("base")
    rank = F.when(same & ~F.col("path").rlike(r"\.en-[^./]*\.[^./]*$"), 1).when(same & F.col("path").contains(".en-GB."), 2).when(same, 3).otherwise(4)
    siblings = siblings.select("code", "path", F.lit("sibling").alias("via"), rank.alias("rank"))
    best = own.unionByName(siblings).groupBy("code").agg(F.min(F.struct("rank", "path", "via")).alias("x")).select("code", "x.path", "x.via")
    return items.select("code").join(best, "code", "left").select("code", "path", F.coalesce("via", F.lit("missing")).alias("resolved_via"))


def first_claims(resolved: DataFrame, order: str) -> DataFrame:
    """A file serves one item: the first by `order` (then code) that claims it."""
    rank = F.row_number().over(Window.partitionBy("path").orderBy(F.col(order).asc_nulls_last(), "code"))
    return resolved.filter("path is not null").withColumn("claim", rank).filter("claim = 1").drop("claim")
