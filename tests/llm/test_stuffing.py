from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from rostrum.llm.stuffing import _pack, list_words, page_evidence, stuffed_pages

SCHEMA = "doc_id bigint, text string, source string, bucket string, words string"
PROSE = ["I do not know what the mind is when it looks at its own fear.", "They asked whether we could live without any conflict!", "Der Lehrer fragt, ob das Leben eine Ordnung hat.", "El miedo no es lo que la memoria dice de ese dolor.", "Le silence est dans chaque question que nous posons."]


def share(text):
    data = np.frombuffer(text.lower().encode(), np.uint8)
    words, listed, _, _ = list_words(data, np.array([0, len(data)]))
    return listed[0] / max(1, words[0])


def test_list_shares():
    for text in PROSE:
        assert share(text * 4) < 0.2
    assert share("Who is afraid of the sea? " * 20) < 0.2
    assert share("1. I know that it is so.\n2. We cannot say it.\n- They do not ask us.") < 0.2
    for text in ["Home > Talks > Brenwick > 1961 | " * 9, "peace,mind,peace-book+free;silence" * 9, "#peace #mind20 #freebook " * 9, "box lecture in Brenwick, box lecture in Tarnholm, " * 9, "[Calm Mind](https://a.example/b-c?id=3)\n" * 9, "Cheap silence book! Your silence book for silence book. Get silence book today. " * 9, "quiet dvd sale Rivanza 1981 NEW\n" * 9]:
        assert share(text) > 0.8, text
    assert 0.3 < share(" ".join(PROSE[:2]) + "\nTags: " + "peace, mind, free, book, " * 3) < 0.6
    assert share("") == 0 and share("?!") == 0


def test_flags_and_hosts(spark):
    rng = random.Random(1)
    spam = "Tags: " + ", ".join(rng.choice(["peace", "mind", "book", "free", "dvd"]) for _ in range(60))
    prose = " ".join(rng.choice(PROSE) for _ in range(30))
    rows = [(1, spam, "a"), (2, prose, "a"), (3, prose, "b"), (4, None, "a"), (5, "", None), (6, prose, None), (7, spam, "a"), (None, spam, "b"), (8, spam + "\n" + prose, "c"), (9, (prose + " ") * 300, "d"), (1, spam, "a")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = {r.doc_id: r for r in page_evidence(df, "doc_id", "text", "source").collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6, 7, 8, 9}
    assert found[2].stitched_share == 1.0 and found[2].list_share < 0.2 and found[4].words == 0 and found[5].list_share == 0.0
    assert found[1].phrases > 0 and found[1].list_share == 1.0
    assert sorted(r.doc_id for r in stuffed_pages(page_evidence(df, "doc_id", "text", "source")).collect()) == [1, 7]
    assert stuffed_pages(page_evidence(df.limit(0), "doc_id", "text", "source")).count() == 0


def test_short_pages_of_lists_only(spark):
    # 1, 2: tags or a link and nothing else; 3: a heading over prose; 4: prose; 5: no words
    rows = [(1, "peace, mind, book, dvd", "a"), (2, "[Calm Mind](https://a.example/b)", "a"), (3, "Public Talk 3, Brenwick 1961, Audio\nI do not know it.", "a"), (4, "They do not ask us.", "a"), (5, "?!", "a")]
    evidence = page_evidence(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA), "doc_id", "text", "source")
    assert {r.doc_id: r.list_share for r in evidence.collect()}[3] > 0.5
    assert sorted(r.doc_id for r in stuffed_pages(evidence).collect()) == [1, 2]


def test_hosts_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 40))), rng.choice(["x", "y", "z", None])) for i in range(150)]
    hosts, own = {}, {}
    for i, text, host in rows:
        w = text.split()
        own[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
        for p in own[i]:
            hosts.setdefault(p, set()).add(host)
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    got = {r.doc_id: (r.phrases, r.replicated) for r in page_evidence(df, "doc_id", "text", "source").collect()}
    assert got == {i: (len(ps), sum(len(hosts[p]) >= 2 for p in ps)) for i, ps in own.items()}


def test_buckets_change_no_count_and_add_few_bytes(spark):
    rng = random.Random(9)
    boiler = " ".join(rng.choice("abcdefgh") for _ in range(30))
    rows = [(i, (boiler + " " if i % 3 == 0 else "") + " ".join(f"w{rng.randrange(300)}" for _ in range(60)), rng.choice(["x", "y", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = [sorted((r.doc_id, r.phrases, r.replicated) for r in page_evidence(df, "doc_id", "text", "source", bucket_bytes=n).collect()) for n in (1 << 30, 20_000, 1_000)]
    assert got[0] == got[1] == got[2] and max(r[2] for r in got[0]) >= 26
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([hash(r[2]) % 3 for r in rows], pa.int64()), pa.array([r[1] for r in rows])], names=["a", "b", "c"])
    packed = [sum(len(x.as_py()) for b in _pack(n, 2)(iter([batch])) for x in b.column(1)) for n in (1, 8)]
    # each bucket names the pages of its entries, at most once an entry
    assert packed[1] <= packed[0] + 8 * 16 * len(rows)
