from __future__ import annotations

import pytest

from rostrum.operators.attribution import attributed_passages, ends_sentence, inherited_turns, passage_bounds, split_at_labels, transcript_quality
from rostrum.sources.subtitles import first_claims, last_timestamp, parse_cues, read_files, resolve_sources

SEEDS = {"k": "K", "q": "Q", "questioner": "Q", "question": "Q", "announcer": "ANN"}


def vtt(*cues: str) -> str:
    blocks = [f"00:{i // 6:02d}:{i % 6 * 10:02d}.000 --> 00:{i // 6:02d}:{i % 6 * 10 + 9:02d},500\n{text}" for i, text in enumerate(cues)]
    return "WEBVTT\nKind: captions\n\nNOTE one\n\n" + "\n\n".join(blocks) + "\n"


def passages(spark, text: str, event: str):
    files = spark.createDataFrame([("f", text)], "path string, text string")
    events = spark.createDataFrame([("f", event)], "path string, event_type string")
    return attributed_passages(parse_cues(files, tight_labels=list(SEEDS)), SEEDS, events).orderBy("passage_seq").collect()


def test_cues_with_crlf_tags_and_labels(spark):
    text = "﻿WEBVTT\r\n\r\n1\r\n00:00:01.500 --> 00:00:03.000 align:start\r\n<v Bob>K: Well,\r\nnow.\r\n\r\nbad --> line\r\nx\r\n\r\n00:01:00,000 --> 01:00:02.250\r\nYes:absolutely\r\n\r\n00:02:00.000 --> 00:02:01.000\r\nQ:No."
    files = spark.createDataFrame([("f", text)], "path string, text string")
    got = [tuple(r)[1:] for r in parse_cues(files, tight_labels=["q"]).orderBy("cue_seq").collect()]
    assert got == [(1, 1.5, 3.0, "K: Well, now.", "K", "Well, now."), (2, 60.0, 3602.25, "Yes:absolutely", None, "Yes:absolutely"), (3, 120.0, 121.0, "Q:No.", "Q", "No.")]
    assert last_timestamp(files).first().duration_secs == 121.0


def test_files_are_read_whole(spark, tmp_path):
    (tmp_path / "a.vtt").write_text("﻿" + vtt("One.", "Two."), encoding="utf-8")
    (tmp_path / "b.vtt").write_text("WEBVTT\n\nNOTE nothing\n")
    files = read_files(spark, str(tmp_path / "*.vtt"))
    assert parse_cues(files).count() == 2
    assert attributed_passages(parse_cues(files.filter("path like '%b.vtt'")), SEEDS, files.selectExpr("path", "'T' as event_type")).count() == 0


def test_no_space_labels(spark):
    got = passages(spark, vtt("K:Right?", "Q:No.", "K:We see.", "Q: And now?"), "Q")
    assert [(r.speaker_code, r.attribution) for r in got] == [("K", "label"), ("Q", "label"), ("K", "label"), ("Q", "label")]
    assert [r.answers_seq for r in got] == [None, None, 2, None]


def test_embedded_label_splits_and_shares_the_time(spark):
    got = passages(spark, vtt("So it is. K: one two three", "Q: why?"), "D")
    assert [(r.speaker_code, r.text, r.timestamps_synthetic) for r in got] == [("ANN", "So it is.", True), ("K", "one two three", True), ("Q", "why?", False)]
    assert got[0].t_end == got[1].t_start == pytest.approx(4.75)


def test_a_colon_in_prose_is_no_speaker(spark):
    got = passages(spark, vtt("We are asking: what is it?", "We are asking: who is it?"), "T")
    assert {r.speaker_code for r in got} == {"K"} and got[0].assumed_k


def test_unlabelled_talk_with_an_introduction(spark):
    got = passages(spark, vtt("Ladies and gentlemen, please welcome the speaker.", "Thank you.", "I begin."), "T")
    assert [(r.speaker_code, r.attribution) for r in got] == [("ANN", "inherit"), ("K", "assumed_k")]


def test_a_question_returns_to_the_speaker(spark):
    got = passages(spark, vtt("First things.", "Question: what of it?", "It is so.", "And so."), "T")
    assert [(r.speaker_code, r.attribution) for r in got] == [("K", "assumed_k"), ("Q", "label"), ("K", "q_boundary_heuristic")]
    got = passages(spark, vtt("K: First things.", "Question: what of it?", "It is so.", "And so."), "Q")
    assert [(r.speaker_code, r.attribution) for r in got] == [("K", "label"), ("Q", "label"), ("K", "q_boundary_heuristic")]


def test_a_labelled_turn_goes_on(spark):
    got = passages(spark, vtt("K: one", "two", "three", "four", "Q: five"), "D")
    assert [(r.speaker_code, r.text, r.attribution) for r in got] == [("K", "one two three four", "label"), ("Q", "five", "label")]


def test_long_turns_are_cut_and_lose_no_word(spark):
    sentence = "word " * 19 + "end. "
    got = passages(spark, vtt(*["K: " + sentence * 3, *[sentence * 3] * 9]), "T")
    assert len(got) > 1 and all(r.word_count >= 60 for r in got) and sum(r.word_count for r in got) == 600


def test_sentence_ends_and_bounds():
    assert [ends_sentence(w) for w in ("end.", "Mr.", "J.", "what?\"", "er...", "…", "?!", "(Dr.", "No.", "said.)")] == [True, False, False, True, False, False, False, False, False, True]
    assert passage_bounds([False] * 600) == [(0, 260), (260, 520), (520, 600)]
    assert passage_bounds([False] * 300) == [(0, 300)]
    assert passage_bounds([]) == []


def test_quality_rules(spark):
    found = spark.createDataFrame([("a", "K", 12), ("a", "Q", 3), ("b", "ANN", 5)], "item string, speaker_code string, word_count int")
    events = spark.createDataFrame([("a", "Q"), ("b", "FOF"), ("c", "T")], "item string, event_type string")
    got = {r.item: (r.rule, r.failure_codes, r.signals, r.status) for r in transcript_quality(found, events).collect()}
    assert got == {"a": ("dialogue", "trivial_k_speech", None, "warn"), "b": ("k_presence", "zero_k_passages", None, "warn"), "c": ("public_talk", "zero_k_passages", None, "warn")}


@pytest.mark.parametrize(("minutes", "want"), [(90, (None, "missing")), (62, ("x/BASE1.vtt", "sibling")), (None, (None, "missing"))])
def test_siblings_must_fit_the_duration(spark, minutes, want):
    items = spark.createDataFrame([("BASE1.2", minutes)], "code string, duration_minutes int")
    listing = spark.createDataFrame([("x/BASE1.vtt", "BASE1", 3600.0)], "path string, code string, duration_secs double")
    assert tuple(resolve_sources(items, listing).first())[1:] == want


def test_siblings_are_tried_in_order(spark):
    items = spark.createDataFrame([("B1.2", 60), ("B2.1", 60), ("B3", 60), ("B4", 60)], "code string, duration_minutes int")
    files = [
        ("x/B1.en-GB.vtt", "B1", 3600.0), ("x/B1.en.vtt", "B1", 3610.0), ("x/B1.3 - a.en.vtt", "B1.3", 3600.0), ("x/B2.en.vtt", "B2", 9.0), ("x/B2.en-GB.vtt", "B2", 3600.0), ("x/B2.2.en.vtt", "B2.2", 3600.0),
        ("x/B3x.en.vtt", "B3x", 3600.0), ("x/B3 old.en.vtt", "B3 old", None), ("x/B4.en.vtt", "B4", 1.0), ("x/B40.en.vtt", "B40", 3600.0), ("x/B.en.vtt", "B", 3600.0), ("x/.vtt", "", 3600.0),
    ]
    listing = spark.createDataFrame(files, "path string, code string, duration_secs double")
    got = {r.code: (r.path, r.resolved_via) for r in resolve_sources(items, listing).collect()}
    assert got == {"B1.2": ("x/B1.en.vtt", "sibling"), "B2.1": ("x/B2.en-GB.vtt", "sibling"), "B3": ("x/B3x.en.vtt", "sibling"), "B4": ("x/B4.en.vtt", "direct")}


def test_a_file_serves_its_first_claim(spark, rows):
    claims = spark.createDataFrame([("B", "f", 2), ("A", "f", 2), ("C", "g", None), ("D", None, 1)], "code string, path string, pdf_order int")
    assert [r[0] for r in rows(first_claims(claims, "pdf_order").select("code"))] == ["A", "C"]


def test_cues_are_cut_and_turns_inherited(spark):
    schema = "item string, id int, seq int, text string, label string, t_start double, t_end double"
    cues = [
        ("a", 1, 1, "Welcome all.", None, 0.0, 2.0), ("a", 2, 2, "K: One two. q: why? k: so it is", None, 10.0, 20.0), ("a", 3, 3, "going on", None, 20.0, 22.0), ("a", 4, 4, "Dr. X: no label here", "Q", 22.0, None),
        ("a", 5, 5, None, "K", 1.0, 2.0), ("a", 6, 6, "  ", "K", 1.0, 2.0), ("b", 7, 1, "K: not admitted there", "K", 0.0, 1.0), ("c", 8, 1, "A.B: odd (x): y", None, 0.0, 6.0),
    ]
    admitted = [("a", "K", "K", 2), ("a", "k", "K", 1), ("a", "q", "Q", 1), ("c", "A.B", "AB", 1), ("c", "(x)", "X", 1)]
    pieces = split_at_labels(spark.createDataFrame(cues, schema), spark.createDataFrame(admitted, "item string, raw_label string, speaker_code string, hits int"), "item")
    got = sorted((r.item, r.seq, r.piece, r.named, r.said, r.words, r.t_start, r.t_end, r.synthetic) for r in pieces.collect())
    assert got == [
        ("a", 1, 0, None, "Welcome all.", 2, 0.0, 2.0, False), ("a", 2, 0, "K", "One two.", 2, 10.0, 10.0 + 10 * 2 / 6, True), ("a", 2, 1, "Q", "why?", 1, 10.0 + 10 * 2 / 6, 15.0, True),
        ("a", 2, 2, "K", "so it is", 3, 15.0, 20.0, True), ("a", 3, 0, None, "going on", 2, 20.0, 22.0, False), ("a", 4, 0, "Q", "Dr. X: no label here", 5, None, None, False),
        ("b", 7 - 6, 0, None, "K: not admitted there", 4, 0.0, 1.0, False), ("c", 1, 0, "AB", "odd", 1, 0.0, 3.0, True), ("c", 1, 1, "X", "y", 1, 3.0, 6.0, True),
    ]
    turns = {(r.item, r.turn): (r.speaker_code, r.attribution, r.first_seq, r.last_seq, r.words) for r in inherited_turns(pieces, "item").collect()}
    assert turns == {("a", 1): ("ANN", "inherit", 1, 1, 2), ("a", 2): ("K", "label", 2, 2, 2), ("a", 3): ("Q", "label", 2, 2, 1), ("a", 4): ("K", "label", 2, 3, 5), ("a", 5): ("Q", "label", 4, 4, 5), ("b", 1): ("ANN", "inherit", 1, 1, 4), ("c", 1): ("AB", "label", 1, 1, 1), ("c", 2): ("X", "label", 1, 1, 1)}
