from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rostrum.llm.neardup import bands, similar_groups, similar_pairs, similar_sets
from rostrum.llm.shingles import shingle_hashes, text_buffer, word_hashes


def shingles(text, k):
    w = re.findall("[a-z0-9]+", text.lower())
    return w, frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, t, k, least):
    sets = {}
    for i, text in rows:
        if i is None or text is None:
            continue
        w, s = shingles(text, k)
        if len(w) >= max(k, least):
            sets[i] = s
    out = set()
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both >= t * (len(sets[a]) + len(sets[b]) - both) - 1e-12:
                out.add((a, b))
    return out


def edited(rng, words, voc, share):
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            continue
        out.append(rng.choice(voc) if r < 2 * share / 3 else w)
        if r > 1 - share / 3:
            out.append(rng.choice(voc))
    if rng.random() < 0.3 and len(out) > 4:
        cut = rng.randrange(len(out))
        out = out[cut:] + out[:cut]
    return out


def collection(seed, n=160):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(60)] + ["the", "of", "and"] * 10
    rows, i = [], 0
    boiler = [rng.choice(voc) for _ in range(30)]
    while len(rows) < n:
        size = rng.choice([3, 6, 12, 40, 60, 90, 150, 400, 700])
        base = [rng.choice(voc) for _ in range(size)] + (boiler if rng.random() < 0.3 else [])
        for _ in range(rng.choice([1, 1, 2, 4])):
            i += 1
            text = " ".join(edited(rng, base, voc, rng.choice([0, 0.02, 0.08, 0.15])))
            rows.append((i, text.upper() if rng.random() < 0.2 else text.replace(" ", rng.choice([" ", ", ", "\n"]))))
    copy = rows[0][1]
    rows += [(10_000 + j, copy) for j in range(n // 10)]  # copies of one text
    rows += [(20_000, None), (20_001, ""), (None, copy), (20_002, "...!"), (20_003, "a b"), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize(("t", "k", "least", "seed"), [(0.5, 3, 0, 1), (0.5, 3, 40, 2), (0.8, 5, 0, 3), (0.3, 2, 5, 4), (0.9, 1, 0, 5), (1.0, 3, 0, 6)])
def test_pairs_equal_brute_force(spark, t, k, least, seed):
    rows = collection(seed)
    df = spark.createDataFrame([(*r, "g", "s", 1) for r in rows], "id bigint, text string, grp string, set_hash string, a int")
    got = similar_pairs(similar_sets(df, "id", "text", t, k, least))
    assert {(r.id_a, r.id_b) for r in got.collect()} == brute(rows, t, k, least)


def test_groups(spark):
    rows = collection(9, 80)
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = similar_sets(df, "id", "text", 0.5, 3, 0)
    got = {r.id: r for r in similar_groups(found).collect()}
    pairs = brute(rows, 0.5, 3, 0)
    for a, b in pairs:
        assert got[a].group_id == got[b].group_id
    classes = {}
    for i, text in rows:
        if i in got and text is not None:
            classes.setdefault(got[i].class_id, set()).add(shingles(text, 3)[1])
    assert all(len(s) == 1 for s in classes.values())
    linked = {x for p in pairs for x in p}
    assert all(r.group_id == r.class_id and r.copies == 1 for i, r in got.items() if i not in linked)
    degree = {c: len({got[b if a == m else a].class_id for a, b in pairs for m in [c] if c in (a, b)} - {c}) for c in classes}
    assert all(got[c].links == degree[c] for c in classes)


def test_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, text string")
    found = similar_sets(df, "id", "text", 0.5, 3, 0)
    assert similar_pairs(found).count() == 0 and similar_groups(found).count() == 0


def test_words_and_shingles_of_odd_texts():
    texts = ["", None, "Ä b-c", "x" * 10_000 + " y", "naïve É9", " a  b "]
    data, offsets = text_buffer(pa.array([None if t is None else t.lower() for t in texts]))
    text, words = word_hashes(data, offsets)
    assert np.bincount(text, minlength=6).tolist() == [len(re.findall("[a-z0-9]+", (t or "").lower())) for t in texts]
    assert len(set(words.tolist())) == len({w for t in texts for w in re.findall("[a-z0-9]+", (t or "").lower())})
    assert shingle_hashes(text, words, 2)[0].tolist() == [2, 3, 4, 4, 5] or len(shingle_hashes(text, words, 2)[0]) == 4


def test_bands_hold_every_pair():
    from fractions import Fraction

    t = Fraction(1, 2)
    plan = bands(t, 1, 5000)
    for n in range(1, 600):
        for m in range(-(-n // 2), n + 1):
            band = next(b for b in plan if b.low <= m < b.high)
            shared = -(-(n + m) // 3)
            p, q = (int(band.prefix(np.array([x]), t)[0]) for x in (n, m))
            k = band.classes + 1
            assert p >= min(n, n - shared + k) and q >= min(m, m - shared + k) and shared >= k


@pytest.mark.parametrize("bucket_bytes,hot", [(200, 1), (8 << 20, 3), (2_000, 2_000)])
def test_buckets_and_hot_signatures_lose_nothing(spark, bucket_bytes, hot):
    rng = random.Random(8)
    voc = [f"w{i}" for i in range(50)]
    base = [rng.choice(voc) for _ in range(60)]
    # a third of all texts are small edits of one text, and a third have one opening
    rows = [(i, " ".join(edited(rng, base, voc, 0.06))) for i in range(40)]
    rows += [(100 + i, " ".join(base[:25] + [rng.choice(voc) for _ in range(40)])) for i in range(40)]
    rows += [(200 + i, " ".join(rng.choice(voc) for _ in range(50))) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    found = similar_pairs(similar_sets(df, "id", "text", 0.5, 3, 0, bucket_bytes, hot))
    assert {(r.id_a, r.id_b) for r in found.collect()} == brute(rows, 0.5, 3, 0)
