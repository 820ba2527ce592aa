from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np

from rostrum.functions.bitmap import Bitmap
from rostrum.operators.orphans import Parent, Reference, orphan_counts, orphans

DAY = datetime(2024, 1, 15)


def test_bitmap_sets():
    rng = np.random.default_rng(3)
    for n in (0, 5, 50_000):
        a, b = (set(rng.integers(0, 200_000, n).tolist()) for _ in range(2))
        x, y = Bitmap.of(np.array(sorted(a))), Bitmap.of(np.array(sorted(b)))
        assert x.andnot(y).codes().tolist() == sorted(a - b)
        assert (x | y).codes().tolist() == sorted(a | b)
        assert (x & y).codes().tolist() == sorted(a & b)
        assert len(x) == len(a)


def build(spark, refs, parents):
    r = spark.createDataFrame(refs, "id bigint, ref string, at timestamp, since string, key string, period string")
    p = spark.createDataFrame(parents, "id bigint, code string, added timestamp, deleted timestamp, updated timestamp, domain string")
    return [Reference("r", r, "id", "ref", "at", "d")], [Parent("d", p, "code", "added", "deleted", "updated", "id")]


def test_states_keys_and_versions(spark, rows):
    late = DAY + timedelta(days=2)
    refs = [
        (1, "a ", DAY, "", "", ""), (2, "A", DAY, "", "", ""), (3, "zz", DAY, "", "", ""), (4, " ", DAY, "", "", ""), (5, None, DAY, "", "", ""), (6, "b", DAY, "", "", ""),
        (7, "c", DAY, "", "", ""), (8, "c", None, "", "", ""), (9, "b", None, "", "", ""), (7, "c", DAY + timedelta(days=9), "", "", ""), (None, "zz", DAY, "", "", ""), (3, "zz", DAY, "", "", ""),
    ]
    parents = [
        (10, "A", DAY - timedelta(days=1), None, DAY, ""), (11, "b", DAY, None, DAY, ""), (11, "b", DAY, DAY, DAY + timedelta(days=1), ""),
        (12, "C", late, None, DAY, ""), (12, "C", late, None, None, ""), (13, None, DAY, None, DAY, ""),
    ]
    found = orphans(*build(spark, refs, parents))
    assert rows(found.select("row_id", "orphan_state")) == [(3, "missing"), (6, "deleted"), (7, "late"), (9, "deleted")]
    counts = {(str(r.period), r.orphan_state): r.orphans for r in orphan_counts(found).collect()}
    assert counts == {("2024-01-01", "missing"): 1, ("2024-01-01", "deleted"): 1, ("2024-01-01", "late"): 1, ("None", "deleted"): 1}


def test_empty_sides(spark, rows):
    assert rows(orphans(*build(spark, [], []))) == []
    found = orphans(*build(spark, [(1, "x", DAY, "", "", "")], []))
    assert [r.orphan_state for r in found.collect()] == ["missing"]


def test_random_with_a_hot_key(spark):
    rng = random.Random(5)
    times = [DAY + timedelta(days=rng.randrange(200)) for _ in range(50)]
    parents = [(i, f"k{i}", rng.choice(times), rng.choice([None, None, DAY]), DAY, "") for i in range(0, 60, 2)]
    refs = [(i, "k7" if i % 3 == 0 else f"K{rng.randrange(70)}", rng.choice(times), "", "", "") for i in range(3000)]
    by_key = {p[1]: p for p in parents}
    want = set()
    for i, key, at, *_ in refs:
        p = by_key.get(key.lower())
        state = "missing" if p is None else "deleted" if p[3] else "late" if p[2] > at else None
        if state:
            want.add((i, state))
    assert {(r.row_id, r.orphan_state) for r in orphans(*build(spark, refs, parents)).collect()} == want
