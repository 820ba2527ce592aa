from __future__ import annotations

import random

import pytest

from rostrum.operators.intervals import periods_and_gaps

SCHEMA = "t bigint, s double, e double, k int, owner string, cell string"


def run(spark, data, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in data], SCHEMA)
    return sorted(map(tuple, periods_and_gaps(df, "t", "s", "e", "k", **kw).collect()))


def brute(data, tolerance=1500):
    out = set()
    ms = [(t, round(s * 1000), round(e * 1000), k) for t, s, e, k in data if None not in (t, s, e, k)]
    for owner in {x[0] for x in ms}:
        real = sorted((s, e) for t, s, e, k in ms if t == owner and k == 0 and e > s)
        fake = [(s, e) for t, s, e, k in ms if t == owner and k == 1 and e > s]
        periods = []
        for s, e in real:
            if periods and s <= periods[-1][1] + tolerance:
                periods[-1][1] = max(periods[-1][1], e)
            else:
                periods.append([s, e])
        out |= {(owner, "period", *p) for p in periods}
        for (_, a), (b, _) in zip(periods, periods[1:]):
            out.add((owner, "gap_synthetic" if any(s < b and e > a for s, e in fake) else "gap", a, b))
    return sorted(out)


def test_merges_and_gaps(spark):
    data = [(1, 0.0, 1.0, 0), (1, 2.5, 3.0, 0), (1, 4.501, 5.0, 0), (1, 3.0, 4.0, 1), (2, 0.0, 9.0, 0), (2, 1.0, 2.0, 0)]
    assert run(spark, data) == [(1, "gap_synthetic", 3000, 4501), (1, "period", 0, 3000), (1, "period", 4501, 5000), (2, "period", 0, 9000)]


def test_synthetic_that_only_touches_a_gap(spark):
    data = [(1, 0.0, 1.0, 0), (1, 5.0, 6.0, 0), (1, 0.5, 1.0, 1), (1, 5.0, 5.5, 1)]
    assert (1, "gap", 1000, 5000) in run(spark, data)


def test_nulls_reversed_nan_and_repeats(spark):
    nan = float("nan")
    data = [(1, None, 1.0, 0), (1, 0.0, None, 0), (1, 2.0, 1.0, 0), (1, 1.0, 1.0, 0), (None, 0.0, 1.0, 0), (1, nan, 2.0, 0), (1, 0.0, 1.0, None), (3, 0.0, 1.0, 1), (1, 7.0, 8.0, 0), (1, 7.0, 8.0, 0)]
    assert run(spark, data) == [(1, "period", 7000, 8000)]


def test_empty(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("cell", [1_000, 7_777, 1_800_000])
def test_random_against_brute_force_over_cells(spark, cell):
    rng = random.Random(cell)
    data = []
    for _ in range(3000):
        s = rng.uniform(-50, 3000) if rng.random() < 0.9 else rng.uniform(0, 50)
        length = rng.choice([rng.uniform(0, 2), rng.uniform(0, 40), rng.uniform(-3, 1), rng.uniform(100, 900) if rng.random() < 0.02 else 0.5])
        # one owner holds a third of the rows
        data.append((rng.choice([1, rng.randrange(40), rng.randrange(40)]), round(s, 3), round(s + length, 3), rng.choice([0, 0, 1])))
    assert run(spark, data, cell_ms=cell) == brute(data)
