from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from rostrum.operators import selection as S
from rostrum.sinks.export import report, to_prune, write_manifest
from rostrum.sources.documents import api_records, cached, page_links


def test_lookups_and_stratum_keys(spark, rows):
    df = spark.createDataFrame([("audio", 6), ("video", 7), (None, None), ("film", 11)], "medium string, number int")
    assert [tuple(r) for r in df.select(S.footage_type("medium"), S.section_group("number")).collect()] == [("audio_only", "06"), ("video_footage", None), (None, None), (None, "11")]
    keys = spark.createDataFrame([("1960s", "T", "A", 0), ("unknown", None, "B", 1)], "decade string, event_type string, corpus_tier string, timestamps_synthetic int")
    made = keys.withColumn("key", S.stratum_key(**{c: F.col(c) for c in keys.columns}))
    assert rows(made.select("key")) == [("decade:1960s|type:T|tier:A|synth:0",), ("decade:unknown|tier:B|synth:1",)]
    assert rows(made.select(*S.stratum_columns("key"))) == rows(keys)


def test_filters_are_optional_and_chained(spark, rows):
    items = spark.createDataFrame([("A1", "1A/x", "s"), ("B1", "1a/y", None), ("C1", "2A/z", "s"), (None, "1A/n", "s"), ("D1", None, "s")], "code string, future_path string, series_code string")
    codes = lambda **kw: [r[0] for r in rows(S.select_items(items, **kw).select("code"))]
    assert len(codes()) == 5 and codes(path_prefix="1a/", from_code="A2") == ["B1"] and codes(codes=["A1", "D1"], series="s") == ["A1", "D1"] and codes(codes=[]) == []
    files = spark.createDataFrame([("A1", 50), ("A1", None), ("B1", 51)], "code string, file_size int")
    assert sorted(r.code for r in S.without_files(items.filter("code is not null"), files, "code").collect()) == ["A1", "C1", "D1"]


def test_rediscovery_keeps_what_was_verified(spark, rows):
    schema = "code string, kind string, target string, notes string"
    current = spark.createDataFrame([("a", "yt", "1", "Manually verified: x"), ("a", "ar", "2", None), ("b", "yt", "3", "old"), ("c", "yt", "4", None)], schema)
    found = spark.createDataFrame([("a", "yt", "9", None), ("a", "ar", "8", None), ("a", "ar", "7", None), ("b", "ar", "6", None)], schema)
    assert rows(S.rediscovered(current, found, ["code", "kind"])) == [("a", "ar", "7", None), ("a", "yt", "1", "Manually verified: x"), ("b", "ar", "6", None)]
    scope = spark.createDataFrame([("a",)], "code string")
    assert rows(S.rediscovered(current, found.filter("code = 'a'"), ["code", "kind"], scope)) == [("a", "ar", "7", None), ("a", "yt", "1", "Manually verified: x"), ("b", "yt", "3", "old"), ("c", "yt", "4", None)]
    assert S.rediscovered(current.limit(0), found.limit(0), ["code", "kind"]).count() == 0


def test_runs_breaks_and_figures(spark, rows):
    df = spark.createDataFrame([("x", 1, "a", 1960), ("x", 2, "a", None), ("x", 3, "b", 0), ("y", 1, "b", 1961), ("y", 2, None, 1950), ("y", 3, "b", 1970), ("y", 3, "b", 1970)], "g string, n int, v string, year int")
    assert rows(S.runs(df, "g", "v", ["n"])) == [("x", 2, 2, True), ("y", 3, 2, False)]
    assert rows(S.table_breaks(df.filter("g = 'y' and n < 3"), "g", "v", ["n"]).select("n", "opens")) == [(1, True), (2, True)]
    got = {r.g: tuple(r)[1:] for r in S.concept_figures(df, "g", "v", "year", "n", "n").collect()}
    assert got == {"x": (3, ["a", "b"], 1960, 1960, 1, 3), "y": (4, ["b"], 1950, 1970, 1, 3)}
    assert rows(S.facet_coverage(df, ["v", "year"])) == [("v", 6, 7), ("year", 6, 7)]


def test_gates_and_stale_notes(spark, rows):
    items = spark.createDataFrame([("a", 1, 5), ("b", 9, 5), ("c", None, None)], "code string, section_id int, pdf_order int")
    rules = S.catalogue_gate(items, spark.createDataFrame([(1,)], "id int"), 4)
    assert {k: v.count() for k, v in rules.items()} == {"shrunk": 1, "unknown_section": 2, "order_taken_twice": 1}
    assert S.catalogue_gate(items, items.select(F.col("section_id").alias("id")), 3)["shrunk"].count() == 0
    notes = spark.createDataFrame([("a", 5), ("b", 5), ("c", None), ("d", 1)], "k string, at int")
    assert rows(S.stale_notes(notes, spark.createDataFrame([("a", 6), ("a", 2), ("b", 5), ("c", 9)], "k string, changed int"), "k", "at", "changed")) == [("a", "changed"), ("d", "gone")]


def test_links_responses_and_caches(spark, rows):
    links = spark.createDataFrame([("d", 2, 1.0, "u1"), ("d", 1, 9.0, "u2"), ("d", 1, 3.0, "u3"), ("d", 3, 1.0, "u2"), ("e", 1, 1.0, ""), ("e", 1, 1.0, None)], "doc string, page int, y double, uri string")
    assert rows(page_links(links)) == [("d", 0, "u2"), ("d", 1, "u3"), ("d", 2, "u1")]
    bodies = spark.createDataFrame([(1, '{"title": "a", "n": 2}'), (2, "not json"), (3, None), (4, "{}"), (5, "[1]"), (6, '{"title": ')], "id int, body string")
    good, bad = api_records(bodies, "id", "body", "title string, n int")
    assert rows(good) == [(1, "a", 2), (4, None, None)] and rows(bad) == [(2,), (3,), (5,), (6,)]
    found, fetch = cached(spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string"), spark.createDataFrame([("x", 1), ("z", 2)], "k string, v int"), ["k"])
    assert rows(found) == [("x", 1)] and rows(fetch) == [("y",), (None,)] or rows(fetch) == [(None,), ("y",)]


def test_manifests_reports_and_pruning(spark, rows, tmp_path):
    write_manifest(str(tmp_path / "m.json"), {"items": 3, "source": "é"})
    assert json.loads((tmp_path / "m.json").read_text()) == {"items": 3, "source": "é"}
    df = spark.createDataFrame([(2, "b"), (1, None)], "n int, s string")
    text = report("R", [("All", df, ["n"]), ("Few", df.limit(0), ["n"])])
    assert text.startswith("# R\n\n## All\n\n| n | s |") and text.endswith("## Few\n\nNone.\n")
    files = spark.createDataFrame([("a1", "a", 1), ("a2", "a", 2), ("a3", "a", 2), ("b1", "b", None)], "path string, grp string, at int")
    assert rows(to_prune(files, "grp", "at", 1)) == [("a1", "a", 1), ("a2", "a", 2)] and to_prune(files, "grp", "at", 3).count() == 0
    with pytest.raises(ValueError):
        report("R", [("Many", spark.range(10_001).toDF("n"), ["n"])])
