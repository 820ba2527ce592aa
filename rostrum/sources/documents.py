"""Line-wise and nested sources: JSON lines with their errors, overlays, HTML, catalogue text, file listings."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jsonl_rows(lines: DataFrame, schema: str, path: str = "path", line: str = "line", number: str = "line_no") -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of JSON lines: blank lines are skipped, every bad line is reported."""
    parsed_schema = T._parse_datatype_string(schema)
    with_corrupt = T.StructType([*parsed_schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = lines.filter(F.trim(line) != "").select(path, number, line, F.from_json(line, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("x"))
    bad = F.col("x").isNull() | F.col("x._corrupt").isNotNull() | ~F.trim(line).startswith("{")
    rows = parsed.filter(~bad).select(path, number, *(F.col(f"x.{f.name}").alias(f.name) for f in parsed_schema.fields))
    errors = parsed.filter(bad).select(path, number, F.lit("not a JSON object of the expected form").alias("message"))
    return rows, errors


def read_lines(spark: SparkSession, glob: str) -> DataFrame:
    """path, line_no, line. Line numbers are those within a file, which is read whole."""
    files = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.posexplode(F.split("value", "\r?\n")).alias("i", "line")).select("path", (F.col("i") + 1).alias("line_no"), "line")


def overlay_entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The entries of JSON overlays, each with its section and series."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select("section", "series", F.posexplode("entries").alias("position", "entry"))


_PARAGRAPH = re.compile(r"<p(?:\s[^>]*)?>(.*?)(?=</p\s*>|<p[\s>]|\Z)", re.I | re.S)
_BREAK, _TAG = re.compile(r"<br\s*/?>", re.I), re.compile(r"<[^>]*>")


def _lines(body: str) -> str:
    """The text of a paragraph: a line per line break, other blanks collapsed, empty lines left out."""
    text = html.unescape(_TAG.sub("", _BREAK.sub("\n", re.sub(r"\s*\n\s*", "\n", body))))
    return "\n".join(filter(None, (" ".join(x.split()) for x in text.split("\n"))))


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_paragraphs(pages: pd.Series) -> pd.Series:
    """The texts of a page's paragraphs: line breaks kept, other blanks collapsed, empty ones left out; a paragraph that isn't closed ends at the next."""
    return pages.map(lambda page: [x for body in _PARAGRAPH.findall(page or "") if (x := _lines(body))])


def html_links(pages: DataFrame, key: str, html: str, pattern: str = r'href="([^"]+)"') -> DataFrame:
    """key, position, url: links in order, each only where it stands first."""
    links = pages.select(key, F.posexplode(F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), 1))).alias("position", "url"))
    return links.filter("url <> ''")


# The form of a recording's code in a catalogue, of a written date, and the kinds of media.
CODE, DATE, MEDIA = r"^[A-Z]{2,3}[\d&][A-Z0-9.&]*(?:-[A-Z0-9]+)?$", r"^\d{1,2}\s+\w+\s+\d{4}$", ["Audio", "Video"]


def _line_kinds(line: Column, person: str) -> Column:
    """What a catalogue's line is, by its words: a struct of kind ('section', 'item', 'series', 'media' or 'text') and its fields."""
    words = F.split(line, r"\s+")
    word = lambda i: F.coalesce(F.get(words, F.lit(i)), F.lit(""))
    after = lambda n: F.array_join(F.slice(words, n + 1, F.greatest(F.size(words) - n, F.lit(0))), " ")
    section = word(0).rlike(r"^\d+$") & word(1).rlike("^[A-Z]$") & (word(2) == "-") & (F.size(words) > 3)
    of_series = F.startswith(line, F.lit("Series:"))
    entry = F.trim(F.when(of_series, F.substr(line, F.lit(8))).otherwise(line))
    named = F.regexp_extract(entry, rf"^(?:{person})\s+(.*)$", 1)
    code, title = F.substring_index(named, " ", 1), F.trim(F.substr(named, F.length(F.substring_index(named, " ", 1)) + 1))
    entered = (named != "") & (title != "") & F.when(of_series, code.rlike("^[A-Z0-9.&-]+$")).otherwise(code.rlike(CODE))
    parts = F.transform(F.split(line, r"\s+-\s+"), lambda x: F.trim(x))
    minutes = F.regexp_extract(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"^(\d+)\s+minutes?$", 1)
    media = F.get(parts, F.lit(0)).isin(MEDIA) & (minutes != "")
    last = F.element_at(parts, -1)
    dated = (F.size(parts) > 2) & last.rlike(DATE)
    place = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2 - dated.cast("int"), F.lit(0))), " - ")
    kind = F.when(section, "section").when(entered, F.when(of_series, "series").otherwise("item")).when(media, "media").otherwise("text")
    return F.struct(
        kind.alias("kind"), F.struct(word(0).try_cast("int").alias("number"), word(1).alias("letter"), after(3).alias("title")).alias("section"), code.alias("code"), title.alias("title"),
        F.get(parts, F.lit(0)).alias("media_type"), minutes.try_cast("int").alias("minutes"), F.nullif(place, F.lit("")).alias("place"), F.when(dated, last).alias("date"),
    )


def catalogue_items(lines: DataFrame, doc: str = "doc", number: str = "line_no", line: str = "line", person: str = r"[A-Z]\. \w+") -> DataFrame:
    """Sections and items of a catalogue's text.

    A line '3 A - Title' opens a section, '<person> CODE Title' an item; the lines
    after it belong to it: 'Audio - 48 minutes - Place - 3 May 1961' (place and date
    may be missing), 'Series: <person> CODE Title', else its summary. Lines before
    the first item of a section (a table of contents names sections only), page
    numbers and blank lines are left out. Sections carry forward over windows, items
    are runs of lines.
    """
    rows = lines.select(doc, number, F.trim(line).alias("line")).filter(r"line <> '' and not line rlike '^\\d+$'").withColumn("x", _line_kinds(F.col("line"), person))
    order = Window.partitionBy(doc).orderBy(number)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    is_section, is_item = F.col("x.kind") == "section", F.col("x.kind") == "item"
    rows = rows.withColumn("section", F.last(F.when(is_section, F.col("x.section")), ignorenulls=True).over(so_far)).filter("section is not null")
    rows = rows.withColumn("item_no", F.sum(is_item.cast("int")).over(so_far)).filter("item_no > 0").filter(~is_section)
    first = lambda kind, field: F.min_by(F.col(f"x.{field}"), F.when((F.col("x.kind") == kind) & F.col(f"x.{field}").isNotNull(), F.col(number)))
    plain = F.when(F.col("x.kind") == "text", F.struct(number, "line"))
    return rows.groupBy(doc, "item_no").agg(
        F.min_by("section", number).alias("section"), first("item", "code").alias("code"), first("item", "title").alias("title"),
        first("media", "media_type").alias("media_type"), first("media", "minutes").alias("duration_minutes"), first("media", "place").alias("place_name"),
        first("media", "date").alias("event_date"), first("series", "code").alias("series_code"), first("series", "title").alias("series_title"),
        F.array_join(F.transform(F.array_sort(F.collect_list(plain)), lambda p: p["line"]), " ").alias("summary"),
    )


def page_links(links: DataFrame, doc: str = "doc") -> DataFrame:
    """doc, position, uri of the links found on a document's pages (page, y, uri), from the top of the first page down, each only where it stands first."""
    first = links.filter("uri <> ''").groupBy(doc, "uri").agg(F.min(F.struct("page", (-F.col("y")).alias("down"))).alias("at"))
    return first.select(doc, (F.row_number().over(Window.partitionBy(doc).orderBy("at", "uri")) - 1).alias("position"), "uri")


def api_records(responses: DataFrame, key: str, body: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, failures) of JSON responses: the key with the fields of each, and the keys of those that are no object of the form."""
    parsed = responses.select(key, F.from_json(body, schema, {"mode": "PERMISSIVE"}).alias("x"), F.trim(body).alias("body"))
    good = F.col("x").isNotNull() & F.startswith("body", F.lit("{")) & F.json_object_keys("body").isNotNull()
    return parsed.filter(F.coalesce(good, F.lit(False))).select(key, "x.*"), parsed.filter(~F.coalesce(good, F.lit(False))).select(key)


def cached(wanted: DataFrame, cache: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(found, to fetch): wanted keys with what a cache holds for them, and those it lacks, once each."""
    asked = wanted.select(*keys).distinct()
    return asked.join(cache, keys), asked.join(cache.select(*keys).distinct(), keys, "left_anti")


def file_states(spark: SparkSession, glob: str) -> DataFrame:
    """path, size and modification time of files; their content is not read."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("file_size"), F.col("modificationTime").alias("modified_at"))
