from __future__ import annotations

import random

import numpy as np
import pytest

from rostrum.llm.splitting import Owned, Stretches, cut, hand_over, oversized, plan_pieces, scan_range, sentence_end, split_files, split_texts

VOCABULARY = ["word", "x", "Dr.", "end.", "what?", "A.", "...", "er...", "etc.", "No.", "é.", "naïve", " ", "\n", "  ", " y", "said.”", "(Mr.", "long" * 30 + "."]


def reader(data):
    return lambda offset, length: data[offset : offset + length]


def texts(n, seed, longest=400):
    rng = random.Random(seed)
    return [" ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("token,ends", [("end.", True), ("what?", True), ("e.g.", False), ("A.", False), ("...", False), ("er...", False), ("Mrs.", False), ('said."', True), ("x.y", False), ("vol.", False), ("No.", None), ("1984.", True), ("…", False), ("Well!)", True)])
def test_sentence_ends(token, ends):
    assert sentence_end(token) is ends


def test_ranges_with_halos_see_the_same_words():
    for text in texts(60, 4):
        data = text.encode()
        whole = scan_range(reader(data), len(data), 0, len(data))
        assert [data[a:b].decode() for a, b in zip(whole.start, whole.end)] == text.split()
        for size in (7, 50, 333):
            parts = [scan_range(reader(data), len(data), lo, min(len(data), lo + size), halo=5) for lo in range(0, len(data), size)]
            for field in ("start", "end", "natural"):
                got = np.concatenate([getattr(p, field) for p in parts]) if parts else np.empty(0)
                assert (got == getattr(whole, field)).all()
            if len(data):
                found = sum((Stretches.of(p.natural) for p in parts), Stretches(0, 0, 0, 0, False))
                assert (found.words, found.most()) == (len(whole.start), Stretches.of(whole.natural).most())


def test_pieces_cover_overlap_and_prefer_boundaries():
    natural = np.array([i % 10 == 9 for i in range(100)])
    assert plan_pieces(natural, 25, 3) == [(0, 20, True), (17, 40, True), (37, 60, True), (57, 80, True), (77, 100, True)]
    assert plan_pieces(np.zeros(30, bool), 12, 2) == [(0, 12, False), (10, 22, False), (20, 30, True)]
    assert plan_pieces(np.zeros(0, bool), 12, 2) == []


def check_pieces(text, pieces, limit, overlap):
    words, covered = text.split(), 0
    for k, (first, n, part) in enumerate(pieces):
        assert n <= limit and part.split() == words[first : first + n]
        assert first == (max(0, covered - overlap) if k else 0)
        covered = first + n
    assert covered == len(words)


def planned(text, limit, overlap):
    """Plain rules over the words: the last boundary that fits, else the limit."""
    data = text.encode()
    natural = scan_range(reader(data), len(data), 0, len(data)).natural
    out, at = [], 0
    while at < len(natural):
        begin = max(0, at - overlap)
        reach = min(len(natural), begin + limit)
        fit = [i + 1 for i in range(reach) if natural[i] and i + 1 > max(at, overlap)]
        end = reach if reach == len(natural) or not fit else fit[-1]
        out.append((begin, end - begin, end == len(natural) or bool(fit)))
        at = end
    return out


@pytest.mark.parametrize("size", [64, 300, 5_000, 1 << 20])
def test_pieces_do_not_depend_on_ranges(size):
    for text in [*texts(25, 9), "word " * 500, "x" * 2_000, "one. " * 30 + "long" * 400 + " two " * 100]:
        data, out, entry, words, pieces = text.encode(), [], 0, 0, 0
        for low in range(0, len(data), size):
            owned = Owned.read(reader(data), len(data), low, min(len(data), low + size), 40)
            got = cut(reader(data), len(data), owned, low == 0, entry, 40, 5)
            exits, n = hand_over(owned, low == 0, 40, 5)
            assert n[entry] == len(got)
            out += [(words + s, k, natural, data[x:y].decode()) for s, k, x, y, natural in got]
            entry, words, pieces = int(exits[entry]), words + owned.own, pieces + len(got)
        assert [x[:3] for x in out] == planned(text, 40, 5)
        check_pieces(text, [(f, n, t) for f, n, _, t in out], 40, 5)


def test_table_texts_longer_than_a_range(spark):
    long = [(i, t, 0.0, 10.0) for i, t in enumerate([*texts(6, 31, 3_000), "word " * 900, "Yes. " * 300 + "x" * 30_000 + " no " * 400])]
    df = spark.createDataFrame(long, "id bigint, text string, s double, e double")
    whole = None
    for size in (64, 1_000, 1 << 20):
        got = sorted(tuple(r) for r in split_texts(df, "id", "text", "s", "e", 40, 5, size).collect())
        kinds = sorted(tuple(r) for r in oversized(df, "id", "text", 40, size).collect())
        assert whole is None or (got, kinds) == whole
        whole = got, kinds
    for i, text, *_ in long:
        mine = [r for r in whole[0] if r[0] == i]
        assert [(r[3], r[4], r[8] == "natural") for r in mine] == (planned(text, 40, 5) if len(text.split()) > 40 else [])


def test_table_rows(spark):
    prose, run = "one two three four five. " * 60, "word " * 300
    rows = [(1, prose, 0.0, 30.0), (2, run, 10.0, None), (3, "a " * 260, 0.0, 1.0), (4, None, 0.0, 1.0), (5, "", 0.0, 1.0), (None, run, 0.0, 1.0), (1, prose, 0.0, 30.0), (6, run, 9.0, 1.0), (7, run + "x" * 3_000_000, 0.0, 2.0)]
    df = spark.createDataFrame([(*r, 7, "c") for r in rows], "id bigint, text string, s double, e double, words int, cut_kind string")
    assert sorted((r.id, r.cut_kind, r.all_words) for r in oversized(df, "id", "text").collect()) == [(1, "natural", 300), (2, "forced", 300), (6, "forced", 300), (7, "forced", 301)]
    got = split_texts(df, "id", "text", "s", "e").orderBy("id", "piece").collect()
    for i, text in ((1, prose), (2, run), (7, rows[-1][1])):
        mine = [r for r in got if r.id == i]
        check_pieces(text, [(r.first_word, r.words, r.text) for r in mine], 260, 25)
        assert [r.piece for r in mine] == list(range(1, len(mine) + 1)) and {r.pieces for r in mine} == {len(mine)}
    assert [(r.start_s, round(r.end_s, 3)) for r in got if r.id == 1] == [(0.0, 26.0), (23.5, 30.0)]
    assert {(r.start_s, r.end_s) for r in got if r.id in (2, 6)} == {(None, None)}
    assert oversized(df.limit(0), "id", "text").count() == 0 and split_texts(df.limit(0), "id", "text", "s", "e").count() == 0
    with pytest.raises(ValueError):
        split_texts(df, "id", "text", "s", "e", limit=10, overlap=10)


def test_files_are_cut_in_ranges(spark, tmp_path):
    text = " ".join(texts(30, 12))
    (tmp_path / "a.txt").write_text(text, encoding="utf-8")
    (tmp_path / "b.txt").write_text("")
    (tmp_path / "c.txt").write_text("only this")
    got = split_files(spark, str(tmp_path / "*.txt"), limit=40, overlap=5, range_bytes=2_000).orderBy("path", "piece").collect()
    mine = [r for r in got if r.path.endswith("a.txt")]
    assert [r.piece for r in mine] == list(range(1, len(mine) + 1))
    check_pieces(text, [(r.first_word, r.words, r.text) for r in mine], 40, 5)
    assert [r.text for r in got if r.path.endswith("c.txt")] == ["only this"] and not any(r.path.endswith("b.txt") for r in got)
