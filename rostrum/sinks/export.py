"""Exports: CSV, JSON lines with a head line, Markdown tables, marked blocks, manifests and upserts of partitions."""

from __future__ import annotations

import json
import os
import re
import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that an export to one local file may have.
MAX_LOCAL_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, order: list, files: int | None = 1) -> None:
    """CSV with a header, sorted. One file by default, for reports; `files=None` keeps the sorted partitions, for tables of any size."""
    rows = df.orderBy(*order)
    (rows.coalesce(files) if files else rows).write.mode("overwrite").option("header", True).csv(path)


def replace_file(path: str, content: str) -> None:
    """Writes a local file at once: readers see the old or the new content."""
    folder = os.path.dirname(os.path.abspath(path))
    with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
        f.write(content)
    os.replace(f.name, path)


def write_jsonl(df: DataFrame, path: str, head: dict, order: list) -> int:
    """A head line, then the rows in order, keys sorted; returns the number of rows. Rows stream through the driver one partition at a time."""
    columns = sorted(df.columns)
    lines = [json.dumps(head, sort_keys=True, ensure_ascii=False)]
    for n, row in enumerate(df.orderBy(*order).select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).toLocalIterator(), 1):
        if n > MAX_LOCAL_ROWS:
            raise ValueError(f"more than {MAX_LOCAL_ROWS} rows; write a table instead")
        lines.append(row[0])
    replace_file(path, "\n".join(lines) + "\n")
    return len(lines) - 1


def markdown_table(df: DataFrame, order: list, limit: int = 10_000) -> str:
    """A Markdown table of a small result, columns padded, pipes escaped; more rows than `limit` are an error."""
    rows = df.orderBy(*order).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    cells = [df.columns, *([("" if v is None else str(v)).replace("|", "\\|").replace("\n", " ") for v in r] for r in rows)]
    widths = [max(len(c[i]) for c in cells) for i in range(len(df.columns))]
    line = lambda c: "| " + " | ".join(v.ljust(w) for v, w in zip(c, widths, strict=True)) + " |"
    return "\n".join([line(cells[0]), "|" + "|".join("-" * (w + 2) for w in widths) + "|", *map(line, cells[1:])])


def splice(text: str, name: str, block: str) -> str:
    """The text with the block between its marks replaced; an error if they are not there once each."""
    begin, end = f"<!-- begin {name} -->", f"<!-- end {name} -->"
    if text.count(begin) != 1 or text.count(end) != 1:
        raise ValueError(f"marks of {name} must stand once")
    return text[: text.index(begin) + len(begin)] + "\n" + block.strip() + "\n" + text[text.index(end) :]


def is_stale(current: str, block: str) -> bool:
    """Whether a block differs from the current one in more than its dates."""
    undated = lambda x: re.sub(r"\d{4}-\d{2}-\d{2}", "", x).strip()
    return undated(current) != undated(block)


def write_scopes(df: DataFrame, path: str, scope: list[str]) -> None:
    """Replaces the scopes that df has in a partitioned table, and leaves the others as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*scope).parquet(path)


def file_manifest(files: DataFrame) -> DataFrame:
    """path, size and SHA-256 of binary files (columns path, length, content)."""
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def write_manifest(path: str, facts: dict) -> None:
    """A manifest of one JSON object, keys in the order given; written at once."""
    replace_file(path, json.dumps(facts, indent=2, ensure_ascii=False, default=str) + "\n")


def report(title: str, parts: list[tuple[str, DataFrame, list]]) -> str:
    """A Markdown report: each part a heading and the table of a small result in order; an empty one says so."""
    blocks = [f"# {title}"]
    for heading, df, order in parts:
        table = markdown_table(df, order)
        blocks += [f"## {heading}", table if table.count("\n") > 1 else "None."]
    return "\n\n".join(blocks) + "\n"


def to_prune(files: DataFrame, group: str, at: str, keep: int) -> DataFrame:
    """The files beyond the `keep` newest of each group (of ties the last path stays longest)."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col(at).desc_nulls_last(), F.col("path").desc()))
    return files.withColumn("_n", rank).filter(F.col("_n") > keep).drop("_n")
