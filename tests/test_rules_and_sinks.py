from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rostrum.functions import text as X
from rostrum.operators.evaluate import accepted_tags, import_judgments, weighted_measures
from rostrum.operators.quality import registry_rules, require, violations
from rostrum.sinks.export import is_stale, markdown_table, splice, write_csv, write_jsonl, write_scopes
from rostrum.sources.documents import catalogue_items, file_states, html_links, html_paragraphs, jsonl_rows, overlay_entries, read_lines
from rostrum.streaming.ingest import file_stream, import_results, ingest_scopes, latest_results, sessions, stream_turns, windowed_counts, work_off


def one(spark, column, **values):
    types = {str: "string", int: "bigint", float: "double", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in values.items()))
    return df.select(column.alias("x")).first().x


def test_text_functions(spark):
    assert one(spark, X.timecode("s"), s=3725.9) == "1:02:05"
    assert one(spark, X.timed_url("https://v.example/", F.col("v"), "s"), v="id", s=61.9) == "https://v.example/id?t=61"
    assert one(spark, X.timed_url("https://v.example/", F.col("v"), "s"), v=None, s=61.9) is None
    assert [one(spark, X.word_count("t"), t=t) for t in ("", "  ", " a  b\nc ", None)] == [0, 0, 3, 0]
    assert one(spark, X.slug("t"), t="Étude  No. 5 -- now!") == "etude-no-5-now" and one(spark, X.slug("t"), t="?!") == "untitled"
    assert [one(spark, X.first_sentence("t"), t=t) for t in ("One? Two. Three", "No end", "A! B? C")] == ["One? Two.", "No end", "A! B?"]
    assert [one(spark, X.corpus_tier("e"), e=e) for e in ("T", "DSG", "FQA", "EBM", "NEW", "CCT")] == ["A", "B", "C", "X", "B", "B"]
    assert [one(spark, X.event_label("e"), e=e) for e in ("DSG", "DSX", "ZZ")] == ["Discussion with Small Group", "Discussion with Students", "ZZ"]
    assert one(spark, X.year_of_date("d"), d="3 May 1961, printed 1999") == 1999 and one(spark, X.year_of_date("d"), d="1 May 1234") is None
    parse = lambda c: tuple(one(spark, X.code_parts("c"), c=c))
    assert parse("BW61T1") == ("BW", 1961, "T", "1", None)
    assert parse("MA8182D3-A1") == ("MA", 1981, "D", "3", "A1")
    assert parse("KHF1&2")[0::3] == ("KHF"[:2], "1&2") or parse("KHF1&2")[4] is None
    assert parse("OM24F") == ("OM", 1924, "F", None, None) and parse("lower") == (None,) * 5
    assert one(spark, X.media_path("p"[:1], "mp4"), p="a/b.v1.2.M4A") == "a/b.v1.2.mp4"
    assert one(spark, X.decade("y", "c"), y=None, c="XX74T1") == "1970s" and one(spark, X.decade("y", "c"), y=None, c="none") == "unknown"
    assert one(spark, X.titles_match("a", "b"), a="The Quiet Mind", b="X 1961 – the quiet mind") is True


def test_registry_rules_gather_all_errors(spark):
    concepts = spark.createDataFrame([("a", "A", "active", "d"), ("A", "B", "active", "d"), ("c", "", "odd", "d")], "slug string, name string, status string, definition string")
    relations = spark.createDataFrame([("a", "a", "related"), ("a", "zz", "broader"), ("a", "c", "near"), ("a", "c", "near")], "slug string, target string, relation string")
    aliases = spark.createDataFrame([("a", "x"), ("a", "X")], "slug string, alias string")
    rules = registry_rules(concepts, relations, aliases)
    assert {r.rule for r in violations(rules).collect()} == {"missing_text", "duplicate_slug", "unknown_status", "duplicate_alias", "unknown_relation", "self_relation", "duplicate_relation", "unknown_target"}
    with pytest.raises(ValueError, match="unknown_target"):
        require(rules)
    require({"fine": concepts.limit(0)})


def judgment(relevance="substantive", confidence="high", like="yes", rationale="r"):
    return {"relevance": relevance, "confidence": confidence, "definition_like": like, "rationale": rationale}


def test_judgments(spark):
    good = {"a": judgment(), "b": judgment("not_relevant", "low", "not_applicable")}
    cases = [("1", "succeeded", json.dumps(good)), ("2", "errored", None), ("3", "succeeded", "{"), ("4", "succeeded", json.dumps({"a": judgment()})), ("5", "succeeded", json.dumps({**good, "a": judgment(rationale="x" * 301)})), ("99", "succeeded", json.dumps(good)), ("6", "succeeded", json.dumps({**good, "a": judgment(confidence="sure")}))]
    results = spark.createDataFrame(cases, "custom_id string, type string, text string")
    concepts, anchors = spark.createDataFrame([("a",), ("b",)], "slug string"), spark.range(1, 8).withColumnRenamed("id", "anchor_id")
    found = import_judgments(results, concepts, anchors)
    outcomes = {}
    for r in found.collect():
        outcomes.setdefault(r.anchor_id, set()).add(r.outcome)
    assert outcomes == {1: {"completed"}, 2: {"api_error"}, 3: {"parse_error"}, 4: {"parse_error"}, 5: {"parse_error"}, 6: {"parse_error"}}
    rows = {r.slug: r for r in found.filter("anchor_id = 1").collect()}
    assert rows["a"].confidence == 1.0 and rows["b"].definition_confidence is None and rows["b"].confidence == 0.33
    verdicts = spark.createDataFrame([(1, "a", "accept"), (1, "b", "accept"), (2, "a", "accept")], "anchor_id bigint, slug string, verdict string")
    assert [tuple(r) for r in accepted_tags(found, verdicts).collect()] == [(1, "a")]


def test_weighted_measures(spark):
    df = spark.createDataFrame([("g", True, True, 2.0), ("g", True, False, 1.0), ("g", False, True, 1.0), ("h", False, False, 1.0)], "g string, p boolean, q boolean, w double")
    got = {r.g: (round(r.precision, 4), round(r.recall, 4), round(r.f1, 4)) for r in weighted_measures(df, "g", "p", "q", "w").collect()}
    assert got == {"g": (0.6667, 0.6667, 0.6667), "h": (0.0, 0.0, 0.0)}


def test_json_lines_report_every_error(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"slug": "a"}\n\nnot json\n{"slug": "b"}\n[1]\n')
    rows, errors = jsonl_rows(read_lines(spark, str(tmp_path / "a.jsonl")), "slug string")
    assert [r.slug for r in rows.orderBy("line_no").collect()] == ["a", "b"]
    assert sorted(r.line_no for r in errors.collect()) == [3, 5]


def test_overlay_html_and_listing(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"section": {"code": "10A"}, "series": {"code": "S"}, "entries": [{"title": "x"}, {"title": "y"}]}))
    got = overlay_entries(spark, str(tmp_path / "o.json"), "section struct<code: string>, series struct<code: string>, entries array<struct<title: string>>")
    assert [(r.section.code, r.position, r.entry.title) for r in got.collect()] == [("10A", 0, "x"), ("10A", 1, "y")]
    page = '<p>One <b>two</b><br>three</p><p> </p><div>no</div><p>four &amp; five</p><a href="u1">x</a><a href="u2">y</a><a href="u1">z</a>'
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string")
    assert [r.x for r in pages.orderBy("id").select(html_paragraphs("html").alias("x")).collect()] == [["One two\nthree", "four & five"], [], []]
    assert [(r.position, r.url) for r in html_links(pages, "id", "html").orderBy("position").collect()] == [(0, "u1"), (1, "u2")]
    states = file_states(spark, str(tmp_path / "*.json")).collect()
    assert len(states) == 1 and states[0].file_size > 0


def test_catalogue_text(spark):
    text = ["contents", "12", "1 A - Public talks", "A. Speaker BW61T1 Of silence", "Audio - 48 minutes - Brenwick - 3 May 1961", "What is silence?", "It is so.", "13", "Series: A. Speaker BW61T Talks in Brenwick", "A. Speaker BW62D1 Of thought", "Video - 9 minutes", "2 B - Films", "A. Speaker OM24F A film"]
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(text)], "doc string, line_no int, line string")
    got = [(r.section.title, r.code, r.title, r.media_type, r.duration_minutes, r.place_name, r.event_date, r.series_code, r.summary) for r in catalogue_items(lines).orderBy("item_no").collect()]
    assert got == [
        ("Public talks", "BW61T1", "Of silence", "Audio", 48, "Brenwick", "3 May 1961", "BW61T", "What is silence? It is so."),
        ("Public talks", "BW62D1", "Of thought", "Video", 9, None, None, None, ""), ("Films", "OM24F", "A film", None, None, None, None, None, ""),
    ]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b|c"), (1, None)], "n int, s string")
    assert write_jsonl(df, str(tmp_path / "x.jsonl"), {"kind": "set"}, ["n"]) == 2
    lines = [json.loads(x) for x in (tmp_path / "x.jsonl").read_text().splitlines()]
    assert lines == [{"kind": "set"}, {"n": 1, "s": None}, {"n": 2, "s": "b|c"}]
    assert markdown_table(df, ["n"]).splitlines()[3] == "| 2 | b\\|c |"
    write_csv(df, str(tmp_path / "csv"), ["n"])
    assert [r.n for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()] == ["1", "2"]
    text = "x <!-- begin s -->\nold 2024-01-01\n<!-- end s --> y"
    assert splice(text, "s", "new") == "x <!-- begin s -->\nnew\n<!-- end s --> y"
    assert not is_stale("n 2024-01-01", "n 2025-02-02") and is_stale("n", "m")
    with pytest.raises(ValueError):
        splice("none", "s", "new")


def test_scopes_are_replaced_and_streams_are_idempotent(spark, tmp_path):
    table, source = str(tmp_path / "t"), str(tmp_path / "in")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    write_scopes(df, table, ["k"])
    write_scopes(spark.createDataFrame([("a", 9)], "k string, v int"), table, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(table).collect()) == [("a", 9), ("b", 3)]
    df.filter("k = 'b'").write.parquet(source)
    for _ in range(2):
        ingest_scopes(file_stream(spark, source, "k string, v int"), lambda d: d.withColumn("v", F.col("v") * 10), table, ["k"], str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(table).collect()) == [("a", 9), ("b", 30)]


def test_media_paths(spark):
    schema = "slug string, code string, title string, medium string, series string, n int"
    df = spark.createDataFrame([("1A", "B1", 'A/b: "c"?  d\\e', "video", "S", 7), ("1A", "B2", None, None, " ", None), ("1A", "B3", "x" * 200, "audio", None, 1)], schema)
    path = X.future_path("slug", "code", "title", "medium", "series")
    rows = df.withColumn("p", path).select("p", X.ordered_series_path("p", "series", "n").alias("o"), X.output_path("p", "mp3", "/r/", "series").alias("s"), X.output_path("p", "best", "/r", F.lit("Z")).alias("b"))
    got = [tuple(r) for r in rows.collect()]
    assert got[0] == ("library/1A/S/B1 - Ab c de.mp4", "library/1A/0007-S/B1 - Ab c de.mp4", "/r/library/1A/S/B1 - Ab c de.mp3", "/r/library/1A/S/B1 - Ab c de.m4a")
    assert got[1] == ("library/1A/B2 - .bin", "library/1A/B2 - .bin", "/r/library/1A/B2 - .mp3", "/r/library/1A/Z/B2 - .bin")
    assert got[2][0] == "library/1A/B3 - " + "x" * 100 + ".m4a"


def test_a_scope_in_two_batches_is_whole(spark, tmp_path):
    table, source = str(tmp_path / "t"), str(tmp_path / "in")
    total = lambda d: d.groupBy("k").agg(F.sum("v").alias("v"))
    for rows in ([("a", 1)], [("a", 2), ("b", 5)], [("c", 7)]):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(source)
        ingest_scopes(file_stream(spark, source, "k string, v int", 1), total, table, ["k"], str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(table).collect()) == [("a", 3), ("b", 5), ("c", 7)]


def test_results_overwrite_as_they_arrive(spark, tmp_path):
    table, source = str(tmp_path / "t"), str(tmp_path / "in")
    for rows in ([("a", 1), ("a", 3), ("b", 5)], [("b", None), ("c", 7)]):
        spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(source)
        import_results(file_stream(spark, source, "k string, v int"), table, ["k"], str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.k, r.v) for r in latest_results(spark, table).collect()) == [("a", 3), ("b", None), ("c", 7)]


def test_turns_are_carried_from_batch_to_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "transcript_id int, seq int, speaker_code string, text string, final boolean"
    batches = [
        [(1, 1, "K", "One.", False), (1, 2, None, "two.", False), (2, 1, "Q", "Who?", False), (1, 2, None, "two.", False)], [(1, 4, "K", "three.", False), (1, 5, "Q", "Why?", False), (None, 1, "K", "x", False)],
        [(1, 3, "K", "late.", False), (1, 6, None, "So.", True), (2, 2, "K", None, True)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        turns = stream_turns(file_stream(spark, source, schema))
        turns.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [(1, 1, 4, "K", "One. two. three.", False), (1, 3, 3, "K", "late.", True), (1, 5, 6, "Q", "Why? So.", False), (2, 1, 1, "Q", "Who?", False), (2, 2, 2, "K", "", False)]


def test_work_is_resumed(spark, tmp_path):
    done, seen = str(tmp_path / "done"), []
    work = spark.range(7)

    def process(step):
        seen.append(sorted(r.id for r in step.collect()))
        return step.withColumn("x", F.lit(1))

    assert work_off(work, ["id"], process, done, 3, stop=lambda: len(seen) == 2) == 2 and seen == [[0, 1, 2], [3, 4, 5]]
    assert work_off(work, ["id"], process, done, 3) == 1 and seen[2:] == [[6]]
    assert work_off(work, ["id"], process, done, 3) == 0


def test_registry_sync_and_rows_set_by_hand(spark, rows):
    from rostrum.operators.sync import refuse_lost, registry_sync, replace_scopes, upsert

    schema = "slug string, name string, definition string"
    old, new = spark.createDataFrame([("a", "A", "x"), ("b", "B", None), ("c", "C", "z")], schema), spark.createDataFrame([("a", "A", "y"), ("b", "B", None), ("d", "D", "w")], schema)
    versions = spark.createDataFrame([("a", 1, "x"), ("b", 1, "q"), ("b", 2, None)], "slug string, version int, definition string")
    table, report, fresh = registry_sync(old, new, "slug", ["name", "definition"], versions, ["definition"])
    assert rows(table) == [("a", "A", "y"), ("b", "B", None), ("c", "C", "z"), ("d", "D", "w")]
    assert dict(rows(report)) == {"a": "update", "b": "keep", "c": "absent", "d": "insert"} and rows(fresh) == [("a", 2, "y"), ("d", 1, "w")]
    assert rows(upsert(old, spark.createDataFrame([("a", "A1", "1"), ("a", "A2", "2")], schema), ["slug"]))[0] == ("a", "A2", "2")
    assert rows(replace_scopes(old, spark.createDataFrame([("a", "n", "n"), ("a", "n", "n"), ("a", "m", "m")], schema), ["slug"])) == [("a", "m", "m"), ("a", "n", "n"), ("b", "B", None), ("c", "C", "z")]
    assert refuse_lost(old.filter("slug = 'a'"), "name = 'B'").count() == 1
    with pytest.raises(ValueError, match="B"):
        refuse_lost(old, "name = 'B'")


def test_windows_and_sessions(spark):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    events = spark.createDataFrame([(at(1), "u"), (at(4), "u"), (at(12), "u"), (at(30), "v")], "ts timestamp, k string")
    assert sorted((r.window_start.minute, r.k, r.events) for r in windowed_counts(events, "ts", "k").collect()) == [(0, "u", 2), (10, "u", 1), (30, "v", 1)]
    assert sorted((r.k, r.events) for r in sessions(events, "ts", "k").collect()) == [("u", 1), ("u", 2), ("v", 1)]


def test_requests_and_membership(spark):
    from rostrum.operators.evaluate import membership_differences, requests

    passages = spark.createDataFrame([(1, "a text"), (2, None), (None, "x")], "anchor_id bigint, text string")
    concepts = spark.createDataFrame([("b", "B."), ("a", None)], "slug string, definition string")
    got = requests(passages, concepts, "m", "Judge:").collect()
    assert [r.custom_id for r in got] == ["1"] and json.loads(got[0].body) == {"model": "m", "system": "Judge:\n- a: \n- b: B.", "user": "a text", "slugs": ["a", "b"]}
    one = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 1.0)], "anchor_id bigint, weight double")
    two = spark.createDataFrame([(2.0, 1), (1.0, 2), (1.0, 3)], "weight double, anchor_id bigint")
    assert sorted(map(tuple, membership_differences(one, two).collect())) == [(1, 2.0, "existing"), (3, 1.0, "imported")]
    assert membership_differences(one, one).count() == 0
