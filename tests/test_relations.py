from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rostrum.functions.text import normal_title, titles_match
from rostrum.operators.graph import connected, dead_links
from rostrum.operators.joins import band_join, close_calls, greedy_assignment, link_scores, misattributed, nearest, reanchor
from rostrum.operators.sampling import allocate, stratified_sample
from rostrum.operators.sync import change_set, check_not_empty, insert_new, keep_best, next_versions, replace_scopes, restore_children, upsert
from rostrum.plans.corpus import _source_claims, misattributed_sources


def test_band_and_nearest_against_brute_force(spark):
    rng = random.Random(2)
    left = [(i, rng.choice("aab"), round(rng.uniform(-20, 20), 1)) for i in range(200)] + [(900, "a", None), (901, None, 1.0)]
    right = [(i, rng.choice("aac"), round(rng.uniform(-20, 20), 1)) for i in range(150)]
    a, b = spark.createDataFrame(left, "lid int, k string, x double"), spark.createDataFrame(right, "rid int, k string, y double")
    near = {(l[0], r[0]) for l in left for r in right if l[1] == r[1] and None not in (l[2], r[2]) and abs(l[2] - r[2]) <= 1.5}
    assert {(r.lid, r.rid) for r in band_join(a, b, ["k"], "x", "y", 1.5).collect()} == near
    want = {}
    for i, k, x in left:
        close = [(abs(x - y), j) for j, kk, y in right if kk == k] if x is not None else []
        if close:
            want[i] = min(close)[0]
    got = nearest(a, b.withColumnRenamed("y", "x"), ["k"], "lid", "x", "x", "rid").collect()
    assert {r.lid: pytest.approx(r.distance) for r in got} == want


def test_reanchor_by_place_then_by_text(spark, rows):
    anchors = spark.createDataFrame([(1, "i", "m", "en", 4, "dup"), (2, "i", "m", "en", 9, "moved"), (3, "i", "m", "en", 5, "gone"), (4, "i", "w", "en", 1, "moved"), (5, "i", "m", "en", 8, "dup")], "anchor_id int, item_code string, kind string, language string, seq int, sha string")
    now = spark.createDataFrame([("i", "m", "en", 3, "dup"), ("i", "m", "en", 4, "dup"), ("i", "m", "en", 7, "moved")], "item_code string, kind string, language string, seq int, sha string")
    assert rows(reanchor(anchors, now)) == [(1, "live", 4), (2, "live", 7), (3, "stale", None), (4, "stale", None), (5, "stale", None)]


def test_greedy_assignment_takes_the_best_unused(spark, rows):
    scores = spark.createDataFrame([(1, 10, 1.0), (1, 11, 0.88), (2, 10, 1.0), (2, 11, 0.88), (3, 10, 1.0), (4, 12, 0.5), (5, 13, 0.9)], "item_id bigint, link_id bigint, score double")
    order = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (4, 4), (5, 5)], "item_id bigint, position int")
    assert rows(greedy_assignment(scores, order)) == [(1, 11, 0.88), (2, 10, 1.0), (5, 13, 0.9)]


def test_link_scores(spark, rows):
    items = spark.createDataFrame([(1, "The quiet mind of man", "Public Talk", "2", 1961), (2, "Question", "Public Talk", "3", 1962)], "item_id bigint, title string, event_label string, event_number string, year int")
    links = spark.createDataFrame([(7, "Audio | Brenwick 1961 - The quiet mind of man"), (8, "Public Talk 3, 1962"), (9, "no year")], "link_id bigint, link_title string")
    assert rows(link_scores(items, links)) == [(1, 7, 1.0), (2, 8, 0.88)]


def test_link_scores_of_undated_items_places_and_generic_titles(spark, rows):
    schema = "item_id bigint, title string, event_label string, event_number string, year int, code string, place_name string"
    data = [
        (1, "The quiet mind of man", None, None, None, None, None), (2, "Order", "Public Talk", "3", None, "BW61T3", "Brenwick, Oshmar"), (3, "Order", "Public Talk", "3", None, "BW6162T3", "Tarnholm"),
        (4, "2nd Question and Answer Meeting", "Q", "9", 1961, None, None), (5, "Sorrow", "Small Talk", "12", None, None, None), (6, "A long life of fear and order", None, None, None, None, None),
    ]
    links = spark.createDataFrame([(7, "No year - The quiet mind of man"), (8, "Public Talk 3 Brenwick 1961"), (9, "2nd Question and Answer Meeting 1961"), (10, "Small Talk 12, Brenwick 1970"), (11, "Public Talk 3, Tarnholm 61/62"), (12, "Audio - life of fear")], "link_id bigint, link_title string")
    got = [r for r in rows(link_scores(spark.createDataFrame(data, schema), links)) if r[2] > 0]
    assert got == [(1, 7, 1.0), (2, 8, 0.88), (3, 11, 0.88), (5, 10, 0.88), (6, 12, 1.0)]


def test_undated_link_scores_against_all_pairs(spark, rows):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab -") for _ in range(rng.randrange(0, 14)))
    items = spark.createDataFrame([(i, word(), word() or None, None, None) for i in range(60)], "item_id bigint, title string, event_label string, event_number string, year int")
    links = spark.createDataFrame([(i, word() + rng.choice(["", " - "]) + word()) for i in range(60)], "link_id bigint, link_title string")
    phrase = normal_title(F.concat_ws(" ", "event_label", "event_number"))
    score = F.when(titles_match("title", "link_title"), 1.0).when(F.contains(normal_title("link_title"), phrase) & (phrase != ""), 0.88)
    want = rows(items.crossJoin(links).select("item_id", "link_id", score.alias("score")).filter("score > 0"))
    assert len(want) > 50 and rows(link_scores(items, links).filter("score > 0")) == want


def test_link_scores_are_never_broadcast_and_keep_years_and_places(spark, rows, tmp_path):
    rng = random.Random(5)
    places, words = ["Brenwick", "near Brenwick", "Port Ellery, Oshmar", "Ab", None], "order fear mind quiet".split()
    text = lambda: rng.choice([" ", " - "]).join(rng.choice(words) for _ in range(rng.randrange(1, 5)))
    items = [(i, text(), "Talk", str(rng.randrange(1, 30)), rng.choice([1961, 1962, None]), rng.choice(places)) for i in range(80)]
    links = [(i, " ".join([rng.choice(["Brenwick", "Port Ellery", "Ab"]), rng.choice(["1961", "62/61", ""]), rng.choice(["- ", "", "Talk 1", "Talk 12 - "]), text(), rng.choice(["", " – …"])])) for i in range(80)]
    spark.createDataFrame(items, "item_id bigint, title string, event_label string, event_number string, year int, place_name string").write.parquet(f"{tmp_path}/items")
    spark.createDataFrame(links, "link_id bigint, link_title string").write.parquet(f"{tmp_path}/links")
    items, links = spark.read.parquet(f"{tmp_path}/items"), spark.read.parquet(f"{tmp_path}/links")
    found = link_scores(items, links)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()  # the planner takes texts cut into runs of letters to be small
    place, phrase = normal_title(F.substring_index("place_name", ",", 1)), normal_title(F.concat_ws(" ", "event_label", "event_number"))
    named = F.contains("link_title", F.col("year").cast("string")) | F.contains("link_title", F.concat(F.lit("/"), F.substring(F.col("year").cast("string"), 3, 2))) | F.contains("link_title", F.concat(F.substring(F.col("year").cast("string"), 3, 2), F.lit("/")))
    there = place.isNull() | (F.length(place) < 4) | F.contains(normal_title("link_title"), place)
    score = F.when(titles_match("title", "link_title"), 1.0).when(F.contains(normal_title("link_title"), phrase), 0.88)
    want = rows(items.crossJoin(links).filter((F.col("year").isNull() | named) & there).select("item_id", "link_id", score.alias("score")).filter("score > 0"))
    assert len({s for _, _, s in want}) == 2 and rows(found.filter("score > 0")) == want


def test_misattributed(spark, rows):
    claims = spark.createDataFrame([("A", "f", 3600.0, 61), ("B", "f", 3600.0, 30), ("C", "f", 3600.0, None), ("D", "g", 60.0, 1)], "code string, path string, actual_secs double, expected_minutes int")
    assert rows(misattributed(claims)) == [("B", "f", "A"), ("C", "f", "A")]


def test_misattributed_keeps_only_what_fits(spark, rows):
    # f: none within 3 min or 8 %; g: two fit; h: 8 % of a long runtime; k: runtimes of 0 and null and a null duration fit nothing
    data = [("A", "f", 3600.0, 80), ("B", "f", 3600.0, 30), ("C", "g", 3600.0, 62), ("D", "g", 3600.0, 61), ("E", "g", 3600.0, 90), ("F", "h", 7600.0, 120), ("G", "h", 7600.0, None)]
    data += [("H", "k", 100.0, 0), ("I", "k", 100.0, None), ("J", "k", None, 2), ("L", "alone", 60.0, 90)]
    claims = spark.createDataFrame(data, "code string, path string, actual_secs double, expected_minutes int")
    want = [("A", "f", None), ("B", "f", None), ("C", "g", "D"), ("E", "g", "D"), ("G", "h", "F"), ("H", "k", None), ("I", "k", None), ("J", "k", None)]
    assert rows(misattributed(claims)) == want
    assert rows(close_calls(claims)) == [("g", "D", ["C"])]


def test_misattributed_sources_by_the_rule_of_the_reference(spark, rows):
    sf = "/root/testdata/sf0.01"
    groups = {}
    for r in _source_claims(spark, sf).collect():
        groups.setdefault(r.path, []).append(r)
    want = []
    for path, members in groups.items():
        fit = sorted((abs(m.actual_secs - 60 * m.expected_minutes), m.code) for m in members if m.actual_secs is not None and m.expected_minutes and abs(m.actual_secs - 60 * m.expected_minutes) <= max(180, 4.8 * m.expected_minutes))
        keeper = fit[0][1] if fit else None
        want += [(m.code, path, keeper) for m in members if len(members) > 1 and m.code != keeper]
    assert rows(misattributed_sources(spark, sf)) == sorted(want, key=repr)


def test_components_and_dead_links(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (None, 3)]
    got = dict(rows(connected(spark.createDataFrame(edges, "a int, b int"))))
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}
    assert connected(spark.createDataFrame([], "a int, b int")).count() == 0
    notes = spark.createDataFrame([("a", "[[b]] [[c|see]] [[d#x]]"), ("b", None), ("d", "[[a]]")], "name string, text string")
    assert rows(dead_links(notes)) == [("a", "c")]


def test_allocation_and_sample(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 5), ("c", 1)], "stratum string, members bigint")
    assert {r.stratum: r.quota for r in allocate(sizes, "stratum", 9).collect()} == {"a": 5, "b": 3, "c": 1}
    with pytest.raises(ValueError):
        allocate(sizes, "stratum", 2)
    frame = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("stratum"))
    one, two = (stratified_sample(frame.repartition(n), "id", "stratum", 300, 17).select("id", "sample_weight").collect() for n in (1, 5))
    assert sorted(one) == sorted(two) and len(one) == 300
    assert sum(r.sample_weight for r in one) == pytest.approx(5000)
    assert sorted(one) != sorted(stratified_sample(frame, "id", "stratum", 300, 18).select("id", "sample_weight").collect())


def test_change_sets_and_versions(spark, rows):
    now = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "id int, name string, note string")
    then = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", "z")], "id int, name string, note string")
    assert rows(change_set(now, then, ["id"], ["name", "note"])) == [(1, "keep"), (2, "update"), (3, "delete"), (4, "insert")]
    assert rows(upsert(now, then, ["id"], ["note"])) == [(1, "a", None), (2, "b", "x"), (3, "c", "y"), (4, "d", "z")]
    assert rows(upsert(now, then, ["id"])) == [(1, "a", None), (2, "b", None), (3, "c", "y"), (4, "d", "z")]
    assert rows(insert_new(now, then, ["id"])) == [(1, "a", None), (2, "b", "x"), (3, "c", "y"), (4, "d", "z")]
    assert rows(replace_scopes(now, then.filter("id = 2"), ["id"])) == [(1, "a", None), (2, "b", None), (3, "c", "y")]
    versions = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "id int, version int, name string")
    wanted = spark.createDataFrame([(1, "b"), (2, "n"), (3, None)], "id int, name string")
    assert rows(next_versions(versions, wanted, "id", ["name"])) == [(2, 2, "n"), (3, 1, None)]
    with pytest.raises(ValueError):
        check_not_empty(now.limit(0), "rows")


def test_restore_children(spark, rows):
    children = spark.createDataFrame([("A", "u1"), ("B", "u2"), ("X", "u3")], "code string, url string")
    parents = spark.createDataFrame([(7, "A"), (8, "B")], "id int, code string")
    live = spark.createDataFrame([("B", "u2")], "code string, url string")
    kept, orphans = restore_children(children, parents, "code", live, ["code", "url"])
    assert rows(kept) == [("A", "u1", 7)] and rows(orphans) == [("X", "u3")]


def test_keep_best_folds_in_order(spark, rows):
    data = [("t", 1, None, 5), ("t", 2, "audio", None), ("t", 3, "video", 9), ("u", 4, None, None), ("u", 5, None, 3), ("u", 6, "audio", None)]
    df = spark.createDataFrame(data, "title string, pdf_order int, media string, minutes int")

    def fold(items):
        kept = items[0]
        for r in items[1:]:
            if any(r[c] is not None and kept[c] is None for c in (2, 3)):
                kept = r
        return (kept[0], items[0][1], *kept[2:])

    want = [fold([r for r in data if r[0] == k]) for k in "tu"]
    assert rows(keep_best(df, "title", ["media", "minutes"], "pdf_order")) == sorted(want, key=repr)
