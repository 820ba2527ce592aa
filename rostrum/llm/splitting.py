"""Splitting oversized items at natural boundaries.

A text is read in byte ranges, each with halos before and after it, so that no
worker needs a whole text. The steps are the same for texts of a table, which are
cut into slices of a range and its halos, and for files, which are read range by
range:

1. Scan: a worker owns the words that start in its range, finds where natural
   boundaries follow them, and gives a small boundary table: its number of words
   and the stretches between natural boundaries before, within and after. Where a
   halo proves too short for the words at an edge, the range is scanned again with
   a wider one.
2. Stitch: tables of neighbouring ranges are joined by an associative rule, which
   gives a text's words and its longest stretch.
3. Plan: where a piece ends depends only on where the piece before it ended. For
   every place at which the first cut within a range can lie (fewer than the limit)
   a range tells where the first cut in the next range is and how many pieces lie
   between. Read in order, these tables give each range its first cut, and prefix
   sums of words and pieces its place. So pieces don't depend on the ranges.
4. Emit: each range cuts the pieces that begin at cuts within it, by byte offset.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.session import materialize

LIMIT, OVERLAP = 260, 25
#: Bytes of a range: of a file, and of a table's text. Pieces don't depend on them.
RANGE_BYTES, TEXT_RANGE_BYTES = 1 << 20, 4 << 10
HALO = 256

# Abbreviations whose dot ends no sentence.
ABBREVIATIONS = """
mr mrs ms dr prof st mt ft sr jr rev fr hon gen col capt lt sgt maj messrs mme mlle
etc vs vol vols ed eds fig figs p pp no nos ch chap sec cf viz al ibid op cit ca approx dept est inc ltd co corp
e.g i.e a.m p.m u.s u.k b.c a.d jan feb mar apr jun jul aug sep sept oct nov dec mon tue wed thu fri sat sun
""".split()
#: Also whole words: abbreviations only before a number or a small letter.
WORDLIKE = {"no", "nos", "fig", "ed", "col", "sat", "sun", "mar", "mon", "wed", "fri", "co", "al", "ch", "est", "sec", "p", "hon"}

_CLOSERS = "\"'”’»)]}*_"
_OPENERS = "\"'“‘«([{*_-–—>"
_WIDE_BLANKS = [chr(x).encode() for x in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".?!")] = True

Reader = Callable[[int, int], bytes]


@lru_cache(100_000)
def sentence_end(token: str) -> bool | None:
    """Whether a word ends a sentence; None: only if no number or small letter follows."""
    core = token.rstrip(_CLOSERS)
    if not core or core[-1] not in ".?!":
        return False
    if core[-1] != ".":
        return True
    if core.endswith("..") or core.endswith("…."):
        return False
    word = core[:-1].lstrip(_OPENERS).lower()
    if re.fullmatch(r"[^\W\d_](\.[^\W\d_])*", word):
        return False
    if word in WORDLIKE:
        return None
    return word not in ABBREVIATIONS


@dataclass
class Words:
    """The words of a range: byte offsets in the whole text, and whether a natural boundary follows each."""

    start: np.ndarray
    end: np.ndarray
    natural: np.ndarray


def _blank_mask(raw: np.ndarray, data: bytes) -> np.ndarray:
    blank = _BLANK[raw]
    if len(raw) and raw.max() >= 0x80:
        for wide in _WIDE_BLANKS:
            at = data.find(wide)
            while at >= 0:
                blank[at : at + len(wide)] = True
                at = data.find(wide, at + 1)
    return blank


def scan_range(read: Reader, size: int, low: int, high: int, halo: int = HALO) -> Words:
    """The words that start in the bytes [low, high) of a text of `size` bytes."""
    first = max(0, low - 4)
    reach = halo
    while True:
        last = min(size, high + reach)
        data = read(first, last - first)
        if last < size:  # no character is cut in two
            data = data[: len(data) - next((i for i in range(min(4, len(data))) if data[-1 - i] < 0x80), 4)]
        raw = np.frombuffer(data, np.uint8)
        blank = _blank_mask(raw, data)
        before = np.r_[first == 0, blank[:-1]] if len(raw) else np.empty(0, bool)
        start = np.flatnonzero(~blank & before)
        after = np.r_[blank[1:], True] if len(raw) else np.empty(0, bool)
        end = np.flatnonzero(~blank & after) + 1
        if first > 0 and len(end) and (not len(start) or end[0] <= start[0]):
            end = end[1:]
        own, owned = (int(np.searchsorted(start, x - first)) for x in (low, high))
        if last == size or owned < len(start) or own == owned:
            break  # the last word of the range is whole, and what follows it is in sight; or none begins here
        reach *= 4
    kept = slice(own, owned)
    lines = np.append(0, np.cumsum((raw == 10) | (raw == 13)))
    following = np.append(start[1:], len(raw))
    natural = lines[following] > lines[end[: len(start)]]
    start, end_, natural, following = start[kept], end[: len(blank)][kept], natural[kept], following[kept]
    marks = np.zeros(len(start), bool)
    for back in range(1, 5):
        marks |= _MARK[raw[np.maximum(end_ - back, 0)]]
    for i in np.flatnonzero(marks & ~natural):
        ends = sentence_end(data[start[i] : end_[i]].decode(errors="replace"))
        if ends is None:
            head = data[following[i] : following[i] + 4].decode(errors="ignore")[:1]
            ends = not (head.isdigit() or head.islower())
        natural[i] = ends
    if len(natural) and last == size and owned == len(np.flatnonzero(~blank & before)):
        natural[-1] = True  # the end of the text
    return Words(start + first, end_ + first, natural)


# -- boundary tables -------------------------------------------------------------


@dataclass(frozen=True)
class Stretches:
    """Words before the first natural boundary, the longest stretch between two, and words after the last; tail = head where there is none."""

    words: int
    head: int
    longest: int
    tail: int
    closed: bool

    @classmethod
    def of(cls, natural: np.ndarray) -> Stretches:
        at = np.flatnonzero(natural) + 1
        n = len(natural)
        if not len(at):
            return cls(n, n, 0, n, False)
        inner = np.diff(at)
        return cls(n, int(at[0]), int(inner.max()) if len(inner) else 0, n - int(at[-1]), True)

    def __add__(self, other: Stretches) -> Stretches:
        joined = self.tail + other.head
        if self.closed and other.closed:
            return Stretches(self.words + other.words, self.head, max(self.longest, other.longest, joined), other.tail, True)
        if self.closed:
            return Stretches(self.words + other.words, self.head, self.longest, joined, True)
        if other.closed:
            return Stretches(self.words + other.words, joined, other.longest, other.tail, True)
        return Stretches(self.words + other.words, joined, 0, joined, False)

    def most(self) -> int:
        return max(self.head, self.longest, self.tail)


def next_cuts(natural: np.ndarray, first: int, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """For a cut before each word: the cut that ends the piece which goes on from there, and whether it is at a natural boundary.

    `natural` are the boundaries of consecutive words up to the end of the text, or
    as far as needed; `first` tells that the first of them begins the text.
    """
    n = len(natural)
    bounds = np.flatnonzero(natural) + 1
    at = np.arange(n + 1)
    start = at - overlap
    if first:
        start[0] = 0
    reach = np.minimum(start + limit, n)
    i = np.searchsorted(bounds, reach, side="right") - 1
    fit = bounds[np.maximum(i, 0)] if len(bounds) else np.zeros(n + 1, np.int64)
    # a first piece within the overlap would lie wholly in the second
    whole = (i >= 0) & (fit > (np.maximum(at, overlap) if first else at)) & (fit <= reach)
    return np.where(whole, fit, reach), whole | (reach == n)


def plan_pieces(natural: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int, bool]]:
    """(first word, end, cut at a natural boundary) of each piece of a text."""
    ends, whole = next_cuts(natural, True, limit, overlap)
    out: list[tuple[int, int, bool]] = []
    at = 0
    while at < len(natural):
        out.append((max(0, at - overlap) if at else 0, int(ends[at]), bool(whole[at])))
        at = int(ends[at])
    return out


class Short(Exception):
    """A slice ends before what is asked of it."""


def _words_after(read: Reader, size: int, offset: int, count: int) -> Words:
    """The first `count` words that start at or after an offset, or all there are."""
    reach = 16 * count
    while True:
        found = scan_range(read, size, offset, min(size, offset + reach))
        if len(found.start) >= count or offset + reach >= size:
            return Words(found.start[:count], found.end[:count], found.natural[:count])
        reach *= 4


def words_before(read: Reader, size: int, offset: int, count: int) -> np.ndarray:
    """Start offsets of the last `count` words that start before an offset."""
    reach = 16 * max(count, 1)
    while True:
        low = max(0, offset - reach)
        found = scan_range(read, size, low, offset).start
        if low == 0 or len(found) >= count:
            return found[-count:] if count else found[:0]
        reach *= 4


@dataclass
class Owned:
    """A range's words and as many after it as its last pieces may reach."""

    own: int
    words: Words

    @classmethod
    def read(cls, read: Reader, size: int, low: int, high: int, limit: int) -> Owned:
        own = scan_range(read, size, low, high)
        if not len(own.start):
            return cls(0, own)  # within one word or blanks: no piece begins here
        more = _words_after(read, size, high, limit) if high < size else Words(own.start[:0], own.end[:0], own.natural[:0])
        return cls(len(own.start), Words(*(np.concatenate([getattr(w, x) for w in (own, more)]) for x in ("start", "end", "natural"))))


def hand_over(owned: Owned, first: bool, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """For the first cut at each of the range's first words (0 only, in a text's first range): the first cut in the next range, and the pieces up to it."""
    entries = np.arange(1 if first else limit)
    ends, _ = next_cuts(owned.words.natural, first, limit, overlap)
    pieces = np.zeros(len(entries), np.int64)
    at = entries.copy()
    while (going := at < owned.own).any():
        at[going] = ends[at[going]]
        pieces[going] += 1
    return at - owned.own, pieces


def cut(read: Reader, size: int, owned: Owned, first: bool, entry: int, limit: int, overlap: int) -> list[tuple[int, int, int, int, bool]]:
    """The pieces that begin at cuts within the range: first word (relative to the range), words, byte start, byte end, natural."""
    words = owned.words
    if entry >= owned.own:
        return []
    back = words_before(read, size, int(words.start[0]), overlap) if not first and entry < overlap else words.start[:0]
    ends, whole = next_cuts(words.natural, first, limit, overlap)
    out, at = [], entry
    while at < owned.own:
        begin = 0 if first and at == 0 else max(at - overlap, -len(back))
        byte = int(words.start[begin]) if begin >= 0 else int(back[begin])
        end = int(ends[at])
        out.append((begin, end - begin, byte, int(words.end[end - 1]), bool(whole[at])))
        at = end
    return out


# -- steps that texts and files share ------------------------------------------------

#: What identifies a text, a range of it, and its boundary table.
TABLES = pa.schema([
    ("id", pa.int64()), ("version", pa.int64()), ("low", pa.int64()), ("size", pa.int64()), ("words", pa.int64()), ("head", pa.int64()), ("longest", pa.int64()),
    ("tail", pa.int64()), ("closed", pa.bool_()), ("exits", pa.list_(pa.int32())), ("pieces", pa.list_(pa.int32())), ("short", pa.bool_()),
])
TABLES_SQL = "id bigint, version bigint, low bigint, size bigint, words bigint, head bigint, longest bigint, tail bigint, closed boolean, exits array<int>, pieces array<int>, short boolean"
PLACES = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("low", pa.int64()), ("entry", pa.int32()), ("word_base", pa.int64()), ("piece_base", pa.int64())])
PLACES_SQL = "id bigint, version bigint, low bigint, entry int, word_base bigint, piece_base bigint"
TOTALS = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("words", pa.int64()), ("most", pa.int64()), ("pieces", pa.int64())])
TOTALS_SQL = "id bigint, version bigint, words bigint, most bigint, pieces bigint"


def _table_row(read: Reader, size: int, low: int, range_bytes: int, limit: int, overlap: int | None) -> dict:
    """The boundary table of a range; with an overlap, also where its pieces lead."""
    high = min(size, low + range_bytes)
    if overlap is None:
        found = Stretches.of(scan_range(read, size, low, high).natural)
        exits = pieces = None
    else:
        owned = Owned.read(read, size, low, high, limit)
        found = Stretches.of(owned.words.natural[: owned.own])
        exits, pieces = (x.tolist() for x in hand_over(owned, low == 0, limit, overlap))
    return {"words": found.words, "head": found.head, "longest": found.longest, "tail": found.tail, "closed": found.closed, "exits": exits, "pieces": pieces, "short": False}


def _stitch(limit: int, places: bool):
    """Runs over boundary tables in order of text and range: a row per text of more than `limit` words, or the place of each of its ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = before = None
        total, entry, pieces = Stretches(0, 0, 0, 0, False), 0, 0
        for b in batches:
            out: list[dict] = []
            for r in b.to_pylist():
                if (r["id"], r["version"]) != text:
                    if not places and text is not None and total.words > limit:
                        out.append({"id": text[0], "version": text[1], "words": total.words, "most": total.most(), "pieces": pieces})
                    text, before = (r["id"], r["version"]), None
                    total, entry, pieces = Stretches(0, 0, 0, 0, False), 0, 0
                if r["low"] == before:
                    continue  # a copy of the row
                before = r["low"]
                if places:
                    out.append({"id": r["id"], "version": r["version"], "low": r["low"], "entry": entry, "word_base": total.words, "piece_base": pieces})
                total = total + Stretches(r["words"], r["head"], r["longest"], r["tail"], r["closed"])
                if r["exits"] is not None:
                    entry, pieces = r["exits"][entry], pieces + r["pieces"][entry]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=PLACES if places else TOTALS)
        if not places and text is not None and total.words > limit:
            yield pa.RecordBatch.from_pylist([{"id": text[0], "version": text[1], "words": total.words, "most": total.most(), "pieces": pieces}], schema=TOTALS)

    return run


def _in_order(tables: DataFrame) -> DataFrame:
    """Boundary tables of a text one after the other: small rows, streamed."""
    return tables.repartition("id", "version").sortWithinPartitions("id", "version", "low")


def totals(tables: DataFrame, limit: int) -> DataFrame:
    return _in_order(tables).mapInArrow(_stitch(limit, False), TOTALS_SQL)


def places(tables: DataFrame, limit: int) -> DataFrame:
    return _in_order(tables).mapInArrow(_stitch(limit, True), PLACES_SQL)


def _kind(most: Column | str, limit: int) -> Column:
    return F.when(F.col(most) <= limit, "natural").otherwise("forced")


# -- texts of a table ---------------------------------------------------------------

PIECES = "id bigint, piece int, pieces int, first_word bigint, words int, all_words bigint, start_s double, end_s double, cut_kind string, text_kind string, text string"


RANGE_KEYS = ["id", "version", "low"]


def _slices(rows: DataFrame, range_bytes: int, halo: int, *more: str, only: DataFrame | None = None) -> DataFrame:
    """id, version, size, low, from, data: the ranges of each text with their halos, or those that `only` names. A text of one range is one slice."""
    texts = rows.select("id", F.xxhash64("text").alias("version"), *more, F.encode("text", "utf-8").alias("whole"))
    size = F.octet_length("whole").cast("bigint")
    texts = texts.select("id", "version", *more, "whole", size.alias("size"), F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1, F.lit(range_bytes).cast("bigint"))).alias("low"))
    if only is not None:
        texts = texts.join(only, RANGE_KEYS)
        more = (*more, *(c for c in only.columns if c not in RANGE_KEYS))
    begin = F.greatest(F.col("low") - halo, F.lit(0))
    data = F.expr(f"substring(whole, cast(greatest(low - {halo}, 0) + 1 as int), cast({range_bytes} + {halo} + least(low, {halo}) as int))")
    return texts.select("id", "version", "size", "low", begin.alias("from"), data.alias("data"), *more)


def _slice_reader(data: bytes, begin: int, size: int) -> Reader:
    def read(offset: int, length: int) -> bytes:
        if offset < begin or min(size, offset + length) > begin + len(data):
            raise Short
        return data[offset - begin : offset - begin + length]

    return read


def _scan(limit: int, range_bytes: int, overlap: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            ids, versions, sizes, lows, begins = (b.column(c).to_pylist() for c in ("id", "version", "size", "low", "from"))
            for i, version, size, low, begin, data in zip(ids, versions, sizes, lows, begins, b.column("data"), strict=True):
                read = _slice_reader(data.as_buffer().to_pybytes(), begin, size)
                key = {"id": i, "version": version, "low": low, "size": size}
                try:
                    row = _table_row(read, size, low, range_bytes, limit, overlap)
                except Short:
                    out.append(key | {"words": 0, "short": True})
                    continue
                if size > range_bytes or row["words"] > limit:
                    out.append(key | row)
            yield pa.RecordBatch.from_pylist(out, schema=TABLES)

    return run


def _scanned(rows: DataFrame, limit: int, range_bytes: int, overlap: int | None, name: str) -> tuple[DataFrame, list[int]]:
    """The boundary tables of all ranges, each with the halo that was wide enough for it, and the halos that were used."""
    halo, only, found, used = HALO if overlap is None else 32 * limit + 4 * HALO, None, None, []
    while True:
        slices = _slices(rows, range_bytes, halo, only=only)
        tables = materialize(slices.mapInArrow(_scan(limit, range_bytes, overlap), TABLES_SQL), name)
        whole = tables.filter("not short").withColumn("halo", F.lit(halo))
        found, used = whole if found is None else found.unionByName(whole), [*used, halo]
        only = tables.filter("short").select(*RANGE_KEYS).distinct()
        if only.isEmpty():
            return found, used
        halo *= 16  # these ranges have words or blanks longer than the halo


def _long_rows(df: DataFrame, id_col: str, text_col: str, limit: int, *more: Column) -> DataFrame:
    """Rows that can have more than `limit` words: each needs a character and a blank."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), *more)
    return rows.filter(f"id is not null and length(text) > {2 * limit}")


def oversized(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, range_bytes: int = TEXT_RANGE_BYTES) -> DataFrame:
    """id, cut_kind ('natural' if no stretch between natural boundaries exceeds the limit, else 'forced') and all_words of every text of more than `limit` words.

    Defined cases: null and empty texts and rows without an id are no items.
    Repeated rows count once. Other columns are ignored.
    """
    tables, _ = _scanned(_long_rows(df, id_col, text_col, limit), limit, range_bytes, None, "boundaries")
    return totals(tables, limit).select("id", _kind("most", limit).alias("cut_kind"), F.col("words").alias("all_words")).distinct()


def _emit(limit: int, overlap: int, range_bytes: int):
    types = [("id", pa.int64()), ("piece", pa.int32()), ("pieces", pa.int32()), ("first_word", pa.int64()), ("words", pa.int32()), ("all_words", pa.int64()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("cut_kind", pa.string()), ("text_kind", pa.string()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                size, low = r["size"], r["low"]
                read = _slice_reader(r["data"], r["from"], size)
                owned = Owned.read(read, size, low, min(size, low + range_bytes), limit)
                t0, t1, total = r["t_start"], r["t_end"], r["all_words"]
                timed = t0 is not None and t1 is not None and t1 >= t0
                at = lambda word: t0 + (t1 - t0) * word / total if timed else None  # noqa: B023, E731
                for k, (begin, words, x, y, natural) in enumerate(cut(read, size, owned, low == 0, r["entry"], limit, overlap)):
                    first = r["word_base"] + begin
                    rows.append({"id": r["id"], "piece": r["piece_base"] + k + 1, "pieces": r["all_pieces"], "first_word": first, "words": words, "all_words": total, "start_s": at(first), "end_s": at(first + words), "cut_kind": "natural" if natural else "forced", "text_kind": r["text_kind"], "text": read(x, y - x).decode()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(types))

    return run


def split_texts(df: DataFrame, id_col: str, text_col: str, start_col: str, end_col: str, limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = TEXT_RANGE_BYTES) -> DataFrame:
    """Ordered pieces of at most `limit` words of every text of more, neighbours sharing `overlap` words.

    A piece ends at the last natural boundary that fits, else at the limit. Its
    times lie between the text's by its place among the words; they are null if
    one of the text's is null or they run backwards. Copies of a row count once;
    of rows with one id and different times or texts, each id's first in order of
    text and times is taken. Other columns are ignored.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    rows = _long_rows(df, id_col, text_col, limit, F.col(start_col).cast("double").alias("t_start"), F.col(end_col).cast("double").alias("t_end"))
    rows = rows.groupBy("id").agg(F.min(F.struct("text", "t_start", "t_end")).alias("x")).select("id", "x.*")
    rows = materialize(rows, "long-texts")
    tables, halos = _scanned(rows, limit, range_bytes, overlap, "boundaries")
    sums = totals(tables, limit).select("id", "version", F.col("words").alias("all_words"), F.col("pieces").cast("int").alias("all_pieces"), _kind("most", limit).alias("text_kind"))
    placed = places(tables, limit).join(sums, ["id", "version"]).join(tables.select(*RANGE_KEYS, "halo").distinct(), RANGE_KEYS)
    placed = materialize(placed, "places") if len(halos) > 1 else placed
    slices = [_slices(rows, range_bytes, halo, "t_start", "t_end", only=placed.filter(F.col("halo") == halo).drop("halo")) for halo in halos]
    return reduce(DataFrame.unionByName, slices).mapInArrow(_emit(limit, overlap, range_bytes), PIECES)


# -- giant files -------------------------------------------------------------------------


def _file_reader(path: str) -> Reader:
    """Reads parts of a file: by Arrow's file systems where the path names one (file, hdfs, s3, gs), else from the local tree."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")
    file = system.open_input_file(name)

    def read(offset: int, length: int) -> bytes:
        file.seek(offset)
        return file.read(length)

    return read


def split_files(spark: SparkSession, glob: str, limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, piece, first_word, words, cut_kind and text of the pieces of large text files, read in byte ranges.

    The files may lie on any file system that Spark and Arrow both read. Pass one
    makes the boundary tables, pass two cuts the pieces; between them only one small
    row per range is moved. Empty files have no pieces.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    files = spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("size"), F.xxhash64("path").alias("id"), F.xxhash64(F.reverse("path")).alias("version"))
    ranges = files.filter("size > 0").select("id", "version", "path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(range_bytes).cast("bigint"))).alias("low"))
    ranges = ranges.repartition("path", "low")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{k: r[k] for k in ("id", "version", "low", "size")} | _table_row(_file_reader(r["path"]), r["size"], r["low"], range_bytes, limit, overlap) for r in b.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=TABLES)

    tables = materialize(ranges.mapInArrow(scan, TABLES_SQL), "file-boundaries")
    placed = ranges.join(places(tables, limit), ["id", "version", "low"]).repartition("path", "low")
    types = pa.schema([("path", pa.string()), ("piece", pa.int64()), ("first_word", pa.int64()), ("words", pa.int32()), ("cut_kind", pa.string()), ("text", pa.string())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                read, size, low = _file_reader(r["path"]), r["size"], r["low"]
                owned = Owned.read(read, size, low, min(size, low + range_bytes), limit)
                rows = [
                    {"path": r["path"], "piece": r["piece_base"] + k + 1, "first_word": r["word_base"] + begin, "words": words, "cut_kind": "natural" if natural else "forced", "text": read(x, y - x).decode(errors="replace")}
                    for k, (begin, words, x, y, natural) in enumerate(cut(read, size, owned, low == 0, r["entry"], limit, overlap))
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=types)

    return placed.mapInArrow(emit, "path string, piece bigint, first_word bigint, words int, cut_kind string, text string")
