from __future__ import annotations

import pytest

from rostrum.llm.registry import ORACLE, QUERIES
from tests.oracle import check, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    check(spark, con, QUERIES[name], ORACLE.get(name), SF)


FOUND = {
    "p2_found": ["segment_id bigint", "cut_kind string"], "p3_found": ["transcript_id bigint", "first_seq bigint", "last_seq bigint", "speaker_code string"],
    "p4_found": ["item_id bigint", "place_code string"], "p5_found": ["segment_a bigint", "segment_b bigint"], "p9_found": ["doc_id bigint"],
}


@pytest.mark.parametrize("name", list(FOUND))
def test_columns(spark, name):
    assert [f"{c} {t}" for c, t in QUERIES[name](spark, SF).dtypes] == FOUND[name]


def test_a_stated_total_is_redistributed_to_siblings_first(spark):
    found = {r.source: r for r in QUERIES["p8_shares_stated"](spark, "/root/testdata/sf0.1").collect()}
    full = {s for s, r in found.items() if r.most_uses == r.max_repeats and r.actual_share < r.target_share}
    assert "field_notes" in full and found["field_notes"].used_tokens < 0.4 * found["field_notes"].target_share * sum(r.used_tokens for r in found.values())
    over = {s: r.actual_share / r.target_share for s, r in found.items() if s not in full}
    # study_notes is field_notes' sibling in the domain 'notes'
    assert max(over, key=over.get) == "study_notes" and min(over.values()) > 1
