from __future__ import annotations

import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from rostrum.operators.search import Index, bm25, capped_distinct, postings, purge, query_terms, text_key

WORDS = ["thought", "thinking", "think", "äther", "étude", "naïve", "the", "sea", "seas", "straße", "x1"]


def corpus(n=200):
    rng = random.Random(8)
    return [(i, " ".join(rng.choice(WORDS) + rng.choice(["", ",", ".", " -"]) for _ in range(rng.randrange(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("terms", [["think"], ["thou", "ether", "sea"], ["the", "th"], ["nai", "x1", "étu"]])
def test_scores_are_those_of_a_full_text_table(spark, terms):
    docs = corpus()
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(text, tokenize = 'unicode61 remove_diacritics 2')")
    con.executemany("INSERT INTO f(rowid, text) VALUES (?, ?)", docs)
    want = dict(con.execute("SELECT rowid, bm25(f) FROM f WHERE f MATCH ?", (" OR ".join(f"{t}*" for t in terms),)))
    df = spark.createDataFrame(docs, "id bigint, text string")
    got = {r.id: r.score for r in bm25(df, "text", terms).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_null_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "sea")], "id bigint, text string")
    assert [r.id for r in bm25(df, "text", ["sea"]).collect()] == [3]
    assert bm25(df, "text", []).count() == 0
    assert bm25(df.limit(0), "text", ["sea"]).count() == 0
    assert [tuple(r) for r in postings(df, "id", "text").collect()] == [("sea", 3, 1, 1)]


def test_terms():
    assert query_terms("Observer & the Observed", ["will", "what is seen"], ["Is it"]) == ["observer", "observed", "will", "seen"]
    assert query_terms("the", []) == ["the"]
    assert query_terms("one's self") == ["one", "self"]


def sequential(rows, per, limit):
    counts, texts, out = {}, set(), []
    for i, g, t in rows:
        key = " ".join(t.split())
        if counts.get(g, 0) >= per or key in texts:
            continue
        texts.add(key)
        counts[g] = counts.get(g, 0) + 1
        out.append(i)
        if len(out) == limit:
            break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_capped_list_is_the_sequential_pass(spark, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice("ABCD"), rng.choice(["x", "y", "z", "x ", "w  w", "w w", f"u{i}"])) for i in range(300)]
    df = spark.createDataFrame(data, "id int, grp string, text string").withColumn("key", text_key("text"))
    for per, limit in ((5, 12), (12, 12), (1, 3), (3, 4), (2, 40), (20, 12)):
        got = capped_distinct(df, [F.col("id")], "grp", "key", per, limit).orderBy("rank")
        assert [r.id for r in got.collect()] == sequential(data, per, limit)
    assert capped_distinct(df.limit(0), [F.col("id")], "grp", "key", 5, 12).count() == 0


def test_a_kept_index_scores_as_a_scan_and_is_maintained(spark, tmp_path):
    docs = corpus()
    df = spark.createDataFrame([*docs, (900, None), (901, "")], "id bigint, text string")
    rounded = lambda rows: {r.id: (r.doc_len, round(r.score, 9)) for r in rows.collect()}
    index = Index.of(df, "id", "text").write(str(tmp_path / "index"))
    for terms in (["think"], ["thou", "ether", "sea"], ["th"]):
        assert rounded(index.search(terms)) == rounded(bm25(df, "text", terms)) != {}
    assert index.search([]).count() == 0 and index.search(["zzz"]).count() == 0
    assert "PartitionFilters: [isnotnull(bucket" in index.postings.filter("bucket = 3")._jdf.queryExecution().toString()
    # removed and added rows
    some, fresh = df.filter("id % 3 = 0"), spark.createDataFrame([(0, "thinking of the sea"), (1000, "sea")], "id bigint, text string")
    left, counts = purge(index, some.select("id"))
    assert counts["before"] - counts["removed"] == counts["after"] == df.filter("id % 3 <> 0").count()
    assert rounded(left.search(["sea"])) == rounded(bm25(df.filter("id % 3 <> 0"), "text", ["sea"]))
    again = index.add(Index.of(fresh, "id", "text"))
    assert rounded(again.search(["sea"])) == rounded(bm25(df.filter("id <> 0").unionByName(fresh), "text", ["sea"]))


def test_citations_of_every_kind_are_looked_for(spark):
    from rostrum.plans.retrieval import QUERIES
    from rostrum.session import table

    sf = "/root/testdata/sf0.01"
    first = {}
    for r in table(spark, sf, "documents", "doc_id", "item_code", "doc_kind").collect():
        if r.item_code is not None and r.doc_kind in ("letter", "study_note", "dialogue"):
            key = (r.item_code.strip().upper(), r.doc_kind)
            first[key] = min(r.doc_id, first.get(key, r.doc_id))
    assert len({item for item, _ in first}) < len(first)
    assert sorted(r.doc_id for r in QUERIES["recall_gaps_by_kind"](spark, sf).collect()) == sorted(first.values())
