from __future__ import annotations

import pytest

from rostrum.llm.turns import label_forms, speaker_turns

SPEAKERS = [("K", "Kellan Ostry", None), ("Q", "Questioner", "Question; Audience"), ("ANN", "Announcer", "Chairman"), ("TMV", "Teodra M. Vance", None), ("HB", "Hollis Brandt-Lowe", None), ("UNK", "Unknown", None)]
SCHEMA = "transcript_id bigint, id bigint, seq int, speaker_code string, raw_label string, attribution string, text string, block string, turn_key int"


@pytest.fixture(scope="module")
def speakers(spark):
    return spark.createDataFrame(SPEAKERS, "speaker_code string, display_name string, other_names string")


def run(spark, speakers, rows, block=512):
    data = [(1, i, i, code, label, how, text, "x", 0) for i, (code, label, how, text) in enumerate(rows, 1)]
    got = speaker_turns(spark.createDataFrame(data, SCHEMA), speakers, block=block).collect()
    return [(r.first_seq, r.last_seq, r.speaker_code, r.text) for r in sorted(got, key=lambda r: (r.first_seq, r.last_seq, r.text))]


def test_forms(speakers):
    forms = dict(label_forms(speakers))
    for form, code in {"k": "K", "k ostry": "K", "mr ostry": "K", "ostry": "K", "kellan ostry": "K", "t m v": "TMV", "teodra vance": "TMV", "teodra m vance": "TMV", "dr brandt-lowe": "HB", "audience": "Q", "chairman": "ANN"}.items():
        assert forms[form] == code
    assert "unk" not in forms


@pytest.mark.parametrize("block", [1, 2, 512])
def test_labels_codes_and_going_on(spark, speakers, block):
    rows = [
        ("K", None, "inherit", "Begin."), ("Q", "Q1:", "label", "What? [laughter]"), ("UNK", None, None, "Still asking."), ("Q", None, "inherit", "(pause) uh, 00:01:02.500"),
        ("Q", None, "inherit", ">> K. Ostry (cont'd): So it is. Mr. Osrty: Yes. First questioner: No?"), ("K", None, "assumed_k", "um, I think."), ("K", "It comes to this", "inherit", "It comes to this: be quiet."),
        ("TMV", None, None, "[T. M. V.] Of course."), ("K", "Dr. Brand-tLowe", "label", "Hm, you know, no."),
    ]
    assert run(spark, speakers, rows, block) == [
        (1, 1, "K", "Begin."), (2, 3, "Q", "What? Still asking."), (5, 5, "Q", "No?"), (5, 5, "K", "So it is. Yes."), (6, 7, "K", "I think. It comes to this: be quiet."),
        (8, 8, "TMV", "Of course."), (9, 9, "HB", "no."),
    ]


def test_time_stamps_right_after_a_label(spark, speakers):
    rows = [("UNK", None, "label", "Chairman:00:00:19 I see."), ("UNK", None, "label", "K:00:01:02"), ("UNK", None, None, "0:01:02:03 1:2 is a ratio")]
    # a row of a label and a time stamp only takes no part
    assert run(spark, speakers, rows) == [(1, 3, "ANN", "I see. 0:01:02:03 1:2 is a ratio")]


def test_nulls_noise_repeats_and_unknown(spark, speakers):
    rows = [(None, None, None, "Who speaks?"), (None, None, "label", "Still."), ("XX", "Nobody Else", "label", "And now."), (None, None, None, None), (None, "K", "label", ""), (None, "K", "label", "*coughs* {bell} <00:00:01.000>")]
    assert run(spark, speakers, rows) == [(1, 3, "UNK", "Who speaks? Still. And now.")]
    data = [(None, 1, 1, "K", None, None, "a", "", 0), (2, 2, None, "K", None, None, "b", "", 0), (3, 3, 5, "K", None, None, "c", "", 0), (3, 3, 5, "K", None, None, "c", "", 0), (3, 4, 5, "K", None, None, "d " * 30_000, "", 0)]
    got = speaker_turns(spark.createDataFrame(data, SCHEMA), speakers).collect()
    assert [(r.transcript_id, r.first_seq, r.speaker_code, len(r.text.split())) for r in got] == [(3, 5, "K", 30_001)]


def test_empty_tables(spark, speakers):
    empty = spark.createDataFrame([], SCHEMA)
    assert speaker_turns(empty, speakers).count() == 0
    one = spark.createDataFrame([(1, 1, 1, "K", "K", "label", "K: yes", "", 0)], SCHEMA)
    assert [r.speaker_code for r in speaker_turns(one, speakers.limit(0)).collect()] == ["UNK"]
