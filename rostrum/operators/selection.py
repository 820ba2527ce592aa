"""What to work on, and what to leave alone: optional filters, kept notes, runs, gates, and figures per concept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What footage a medium means; section numbers by the group they belong to.
FOOTAGE = {"audio": "audio_only", "video": "video_footage"}
GROUPS = {1: "01", 2: "02", 3: "03", 4: "04", 5: "05", 6: "06", 8: "08", 9: "09", 10: "10", 11: "11"}
#: The parts of a stratum's key and the columns they stand for.
STRATUM = {"decade": "decade", "type": "event_type", "tier": "corpus_tier", "synth": "timestamps_synthetic"}
LEAST_FILE_BYTES = 51


def _lookup(values: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)


def footage_type(media_type: Column | str) -> Column:
    """The footage of a medium; null for others."""
    return _lookup(FOOTAGE, F.col(media_type) if isinstance(media_type, str) else media_type)


def section_group(number: Column | str) -> Column:
    """The group of a section's number; null for numbers of none."""
    return _lookup(GROUPS, (F.col(number) if isinstance(number, str) else number).cast("int"))


def stratum_key(**columns: Column) -> Column:
    """'decade:1960s|type:T|tier:A|synth:0' of columns named as in STRATUM; a null part is left out."""
    return F.concat_ws("|", *(F.concat(F.lit(f"{part}:"), columns[name].cast("string")) for part, name in STRATUM.items()))


def stratum_columns(key: Column | str) -> list[Column]:
    """The columns that a key was made of, null where it has no such part."""
    parts = F.str_to_map(key, F.lit(r"\|"), F.lit(":"))
    kinds = {"synth": "int"}
    return [F.try_element_at(parts, F.lit(part)).cast(kinds.get(part, "string")).alias(name) for part, name in STRATUM.items()]


def select_items(items: DataFrame, *, codes: list[str] | None = None, path_prefix: str | None = None, from_code: str | None = None, series: str | None = None, code: str = "code", path: str = "future_path") -> DataFrame:
    """The items that pass all filters that are given; each is a predicate that reaches the scan.

    `from_code` resumes in order of the code; `path_prefix` is a folder, without
    regard to case. Items with a null in a filtered column don't pass.
    """
    rows = items
    if codes is not None:
        rows = rows.filter(F.col(code).isin(codes))
    if path_prefix is not None:
        rows = rows.filter(F.startswith(F.lower(path), F.lit(path_prefix.lower())))
    if from_code is not None:
        rows = rows.filter(F.col(code) >= from_code)
    return rows if series is None else rows.filter(F.col("series_code") == series)


def without_files(items: DataFrame, files: DataFrame, key: str, size: str = "file_size", least: int = LEAST_FILE_BYTES) -> DataFrame:
    """Items for which no file of at least `least` bytes is listed."""
    there = files.filter(F.col(size) >= least).select(key).distinct()
    return items.join(there, key, "left_anti")


def rediscovered(current: DataFrame, found: DataFrame, keys: list[str], scope: DataFrame | None = None, note: str = "notes", kept: str = "Manually verified") -> DataFrame:
    """Links after a new discovery: rows whose note begins with `kept` stay and keep others from their keys; all others of the scope (a table of the first key, by default all) give way to what was found.

    `found` has the columns of `current`; of several found rows of one key the first
    in column order is taken. A null note is an empty one.
    """
    manual = current.filter(F.startswith(F.coalesce(note, F.lit("")), F.lit(kept)))
    outside = current.limit(0) if scope is None else current.join(scope.select(keys[0]).distinct(), keys[0], "left_anti").join(manual.select(*keys).distinct(), keys, "left_anti")
    rest = [c for c in current.columns if c not in keys]
    one = found.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("x")).select(*keys, "x.*")
    fresh = one.join(manual.unionByName(outside).select(*keys).distinct(), keys, "left_anti")
    return manual.unionByName(outside).unionByName(fresh.select(*current.columns))


def runs(rows: DataFrame, group: str, value: str, order: list[str]) -> DataFrame:
    """group, runs, kinds, contiguous: runs of equal values in order, and whether each value has one run only."""
    by_order = Window.partitionBy(group).orderBy(*order)
    opens = F.coalesce(~F.col(value).eqNullSafe(F.lag(value).over(by_order)) | (F.row_number().over(by_order) == 1), F.lit(True))
    found = rows.select(group, F.col(value).alias("_v"), opens.cast("bigint").alias("_opens"))
    found = found.groupBy(group).agg(F.sum("_opens").alias("runs"), (F.count_distinct("_v") + F.max(F.col("_v").isNull().cast("bigint"))).alias("kinds"))
    return found.select(group, "runs", "kinds", (F.col("runs") == F.col("kinds")).alias("contiguous"))


def table_breaks(rows: DataFrame, group: str, section: str, order: list[str]) -> DataFrame:
    """The rows with `opens`: whether a new table begins at them, at the first of a group and where the section changes."""
    before = F.lag(F.struct(section)).over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("opens", before.isNull() | ~before[section].eqNullSafe(F.col(section)))


def concept_figures(cites: DataFrame, concept: str, theme: str, year: str, item: str, position: str) -> DataFrame:
    """Per concept its citations, distinct themes in order of their first, first and last year, distinct items, and the place of its first citation.

    Themes are aggregated first, so that a concept with a third of all citations
    gives a row per theme and no more. Years of 0 and null are none.
    """
    themes = cites.groupBy(concept, theme).agg(F.min(position).alias("_at"), F.count("*").alias("_n"), F.min(F.nullif(F.col(year), F.lit(0))).alias("_low"), F.max(F.nullif(F.col(year), F.lit(0))).alias("_high"))
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col(theme).isNotNull(), F.struct("_at", theme)))), lambda x: x[theme])
    items = cites.groupBy(concept).agg(F.count_distinct(item).alias("items"))
    out = themes.groupBy(concept).agg(F.sum("_n").alias("citations"), listed.alias("themes"), F.min("_low").alias("first_year"), F.max("_high").alias("last_year"), F.min("_at").alias("first_at"))
    return out.join(items, concept)


def facet_coverage(notes: DataFrame, facets: list[str]) -> DataFrame:
    """facet, filled, notes: how many notes have something in each facet. One pass."""
    filled = [F.count_if(F.trim(F.col(f).cast("string")) != "").alias(f) for f in facets]
    row = notes.agg(F.count("*").alias("notes"), *filled)
    return row.select(F.explode(F.array(*(F.struct(F.lit(f).alias("facet"), F.col(f).alias("filled"), F.col("notes").alias("notes")) for f in facets))).alias("x")).select("x.*")


def stale_notes(notes: DataFrame, sources: DataFrame, key: str, written: str, changed: str) -> DataFrame:
    """Notes that were written before their source changed, or whose source is gone: key and reason."""
    rows = notes.select(key, written).join(sources.groupBy(key).agg(F.max(changed).alias("_changed"), F.lit(True).alias("_there")), key, "left")
    reason = F.when(F.col("_there").isNull(), "gone").when(F.col("_changed") > F.col(written), "changed")
    return rows.select(key, reason.alias("reason")).filter("reason is not null")


def catalogue_gate(parsed: DataFrame, sections: DataFrame, before: int, share: float = 0.98) -> dict[str, DataFrame]:
    """Rules for a catalogue that was parsed anew, as tables of what breaks them: too few items, sections that are not known, places in the order taken twice.

    `parsed` has code, section_id and pdf_order; `sections` has id. For `quality.require`.
    """
    counted = parsed.agg(F.count("*").alias("items"), F.lit(before).cast("bigint").alias("before"))
    known = sections.select(F.col("id").alias("section_id")).distinct()
    return {
        "shrunk": counted.filter(F.col("items") < share * F.col("before")),
        "unknown_section": parsed.select("code", "section_id").join(known, "section_id", "left_anti"),
        "order_taken_twice": parsed.filter("pdf_order is not null").groupBy("pdf_order").agg(F.count("*").alias("items")).filter("items > 1"),
    }
