from __future__ import annotations

import random
from datetime import datetime

import pytest

from rostrum.llm.canonical import LevenshteinAutomaton, Trie, allowed, alias_paths, canonical_codes, fold, match_values, parts_of

PLACES = [("BW", "Brenwick", "Oshmar", None), ("AM", "Aldermere", "Oshmar", None), ("ALM", "Aldermere", "Vessaly", None), ("PE", "Port Ellery", "Vessaly", "Ellery Roads"), ("FE", "Fort Ellery", "Cundrath", None), ("TV", "Tværby Strand", "Nordvland", "Long Beach; Old Quay"), ("OK", "Okanissee Springs", None, None)]
PSCHEMA = "place_code string, place_name string, region_name string, other_names string"
ISCHEMA = "id bigint, place_name string, place_code string, updated_at timestamp, codes string, value string"
T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(PLACES, PSCHEMA)


def damerau(a, b):
    """True Damerau-Levenshtein distance."""
    top = len(a) + len(b)
    d = {(-1, -1): top}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = top, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = top, j
    last = {}
    for i, x in enumerate(a, 1):
        at = 0
        for j, y in enumerate(b, 1):
            k, l = last.get(y, 0), at
            if x == y:
                at = j
            d[i, j] = min(d[i - 1, j - 1] + (x != y), d[i, j - 1] + 1, d[i - 1, j] + 1, d[k - 1, l - 1] + (i - k - 1) + 1 + (j - l - 1))
        last[x] = i
    return d[len(a), len(b)]


def test_the_automaton_finds_what_brute_force_finds():
    rng = random.Random(6)
    forms = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(3, 13))) for _ in range(150)})
    trie = Trie([(f, f) for f in forms])
    for _ in range(300):
        word = list(rng.choice(forms))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(word) + 1)
            r = rng.random()
            if r < 0.3:
                word.insert(i, rng.choice("abcd"))
            elif r < 0.6 and word:
                word.pop(i % len(word))
            elif i + 1 < len(word):
                word[i], word[i + 1] = word[i + 1], word[i]
        word = "".join(word)
        want = {f: d for f in forms if (d := damerau(word, f)) <= allowed(len(f))}
        assert trie.search(word) == (want if word else {})


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_the_automaton_gives_true_distances(edits):
    machine = LevenshteinAutomaton(edits)
    rng = random.Random(edits)
    for _ in range(20_000):
        word, entry = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(2))
        state, at = machine.start, 0
        for c in entry:
            mask = sum(1 << i for i, x in enumerate(word[at : at + machine.reach]) if x == c)
            state, moved = machine.step(state, mask, min(len(word) - at, machine.reach))
            if state < 0:
                break
            at += moved
        got = machine.distance(state, len(word) - at) if state >= 0 else 9
        want = damerau(word, entry)
        assert got == want if want <= edits else got > edits, (word, entry)
    assert len(machine.positions) < 2_000


def test_folding_and_parts():
    assert fold("Ødersund-0slo 1") == "odersundoslol" and "tvaerbystrand" in alias_paths("Tværby Strand") and "ptellery" in alias_paths("Port Ellery")
    assert parts_of("near Brenwick / Oshmar (?)") == ["Brenwick", "Oshmar"] and parts_of("Aldermere - the Barn") == ["Aldermere", "the Barn"] and parts_of("") == []


def test_codes(spark, places):
    cases = {
        "Brenwick": None, "brenwick ": "BW", "Bernwick": "BW", "Bren-wick, Oshmar": "BW", "(BW)": "BW", "ok": "OK", "Pt. Ellery": "PE", "Ft Ellery / Cundrath": "FE", "Ellery Roads": "PE",
        "old quay": "TV", "Tvaerby Strand": "TV", "Town Hall, P0rt E1lery": "PE", "Nowhere": "NONE", "TBC": "NONE", "At sea": "NONE", "123": None, " ": None, None: None, "aldermere, Vessaly": "ALM", "Oshmar": "NONE",
        "okanisse sprngs": "OK", "x" * 5000: "NONE",
    }
    items = spark.createDataFrame([(i, name, "BW", T0, "", "") for i, name in enumerate(cases)], ISCHEMA)
    got = {r.place_name: r.place_code for r in canonical_codes(items, places).collect()}
    assert got == {k: v for k, v in cases.items() if v}


def test_versions_ties_hints_and_copies(spark, places):
    rows = [
        (1, "Nowhere", None, T0, "", ""), (1, "brenwick", None, T1, "", ""), (2, "ALDERMERE", " alm", T0, "", ""), (3, "ALDERMERE", None, T0, "", ""), (4, "ALDERMERE", "AM", T0, "", ""), (4, "ALDERMERE", "AM", T0, "", ""),
        (5, "b. renwick", None, None, "", ""), (5, "Nowhere", None, T0, "", ""), (None, "brenwick", "BW", T0, "", ""), (6, "brenwick", "AM", T0, "", ""),
    ]
    got = sorted((r.item_id, r.place_code) for r in canonical_codes(spark.createDataFrame(rows, ISCHEMA), places).collect())
    assert got == [(1, "BW"), (2, "ALM"), (3, "ALM"), (4, "AM"), (5, "NONE"), (6, "BW")]


def test_empty_tables(spark, places):
    items = spark.createDataFrame([(1, "brenwick", None, T0, "", "")], ISCHEMA)
    assert canonical_codes(items.limit(0), places).count() == 0
    assert [r.place_code for r in canonical_codes(items, places.limit(0)).collect()] == ["NONE"]


def test_blocks_of_a_long_list_give_the_same(spark, places):
    reference = places.selectExpr("place_code as code", "place_name as name", "other_names as others", "region_name as region")
    values = spark.createDataFrame([(v,) for v in ("Bernwick", "Prt Ellery", "aldermere", "zzz", None, "Oshmar", "old quay")], "value string")
    one, many, single = ({r.value: (r.distance, tuple(r.codes), tuple(map(tuple, r.within))) for r in match_values(values, reference, n).collect()} for n in (20_000, 2, 1))
    assert one == many == single and one["aldermere"] == (0, ("ALM", "AM"), ((0, "ALM"), (0, "AM")))


def test_all_entries_within_the_distance(spark):
    names = ["Wexcombe", "Wexcomb", "Wexcolme", "Westcombe Hill", "Vexcombe"]
    reference = spark.createDataFrame([(n[:2].upper() + str(i), n, None, None) for i, n in enumerate(names)], "code string, name string, others string, region string")
    values = spark.createDataFrame([("Wexcombe",), ("Wexcombes",), ("Qqq",)], "value string")
    for n in (1, 2, 20_000):
        got = {r.value: [tuple(x) for x in r.within] for r in match_values(values, reference, n).collect()}
        assert got == {"Wexcombe": [(0, "WE0"), (1, "VE4"), (1, "WE1")], "Wexcombes": [(1, "WE0")]}


def test_regions_of_other_blocks_are_no_names(spark, places):
    # Vessaly and Oshmar are regions of other entries and names of V and O
    more = spark.createDataFrame([("V", "Vessaly", None, None), ("O", "Oshmar", "Cundrath", None), ("C", "Cundrath Hill", "Nordvland", None)], PSCHEMA)
    reference = places.unionByName(more).selectExpr("place_code as code", "place_name as name", "other_names as others", "region_name as region")
    values = spark.createDataFrame([(v,) for v in ("Aldermare, Vessaly", "Bernwick / Oshmar", "Oshmar", "Vesaly", "Nowhere, Oshmar", "Oshmar, Vessaly", "Brenwick, ?", "?", "")], "value string")
    one = {r.value: (r.distance, tuple(r.codes)) for r in match_values(values, reference, 20_000).collect()}
    assert one["Aldermare, Vessaly"] == (1, ("ALM", "AM")) and one["Oshmar"] == (0, ("O",)) and "Nowhere, Oshmar" not in one
    for n in (1, 2, 5):
        assert {r.value: (r.distance, tuple(r.codes)) for r in match_values(values, reference, n).collect()} == one
