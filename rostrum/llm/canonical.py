"""Mapping free-entered values to a canonical list.

The entries' names, other names and the short forms of their first words are
paths of tries, one for each number of edits that is allowed; that number grows
with a path's length. A value is cut into its parts, and each part is folded to
bare letters, its words. A Levenshtein automaton for that number of edits walks a
word down the trie, cut off where no path can stay within the distance. The
automaton's states are relative to the place in the word, and a step depends only
on where the letter stands in the next few of the word; states and steps are
made once and serve all words and entries. All entries within the distance are
returned, and the nearest are named.

Words are searched once each, however many values share them. The list's paths
are cut into blocks by length, long ones of these by hash; a word meets the
blocks that hold lengths near its own. There is one way for lists of all sizes,
and only the number of paths of each length goes to the driver.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.session import materialize

#: Most paths of a block, and about how many words meet it in one task.
BLOCK_ENTRIES, TASK_WORDS = 20_000, 2_000
MOST_EDITS = 2
NONE = "NONE"

# Letters that decompose to no base letter, digits that stand for letters, short forms of first words.
LIGATURES = {"æ": "ae", "œ": "oe", "ß": "ss"}
LETTERS = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "t", "ı": "i", "0": "o", "1": "l"}
SHORT = {"saint": ["st"], "mount": ["mt"], "fort": ["ft"], "port": ["pt"], "santa": ["sta"], "north": ["n"], "south": ["s"], "east": ["e"], "west": ["w"]}
BEFORE_NAMES = ("near", "nr", "at", "in", "outside", "off", "by")


def fold(text: str) -> str:
    """Bare small letters, without marks, blanks and punctuation."""
    out = []
    for c in unicodedata.normalize("NFKD", text.casefold()):
        c = LETTERS.get(c, c)
        out.append("".join(x for x in c if x.isalpha()))
    return "".join(out)


def unligated(form: str) -> str:
    return "".join(LIGATURES.get(c, c) for c in form)


def allowed(length: int) -> int:
    """Edits allowed for an entry of so many letters."""
    return 0 if length < 5 else 1 if length < 9 else 2


def parts_of(value: str) -> list[str]:
    """The value's parts: what commas, slashes, brackets and spaced dashes set off."""
    found = []
    for part in re.split(r"[,/;()\[\]?|]|\s[-–—]+\s", value):
        words = part.split()
        while words and words[0].lower().strip(".") in BEFORE_NAMES:
            words = words[1:]
        if words:
            found.append(" ".join(words))
    return found


# -- trie and automaton ---------------------------------------------------------------

#: A state's positions: letters of the word passed, edits made, and letters of the word that a begun swap has still to see (see _moves).
Position = tuple[int, int, int]
PLAIN, SWAP, SWAP_OVER, SWAP_WITHIN = range(4)


class LevenshteinAutomaton:
    """The words within `edits` edits of any word; a swap of neighbours is one edit, also where another edit put a letter between them or took one out.

    A state is a set of positions relative to its first. A step takes the places of
    the letter among the next letters of the word (a bit mask) and how many letters
    are left, so that it is the same for all words; steps are kept once made.
    """

    def __init__(self, edits: int):
        self.edits, self.reach = edits, 2 * edits + 3
        self.states: dict[frozenset[Position], int] = {}
        self.positions: list[frozenset[Position]] = []
        self.steps: dict[tuple[int, int, int], tuple[int, int]] = {}
        self.start = self._number(frozenset({(0, 0, PLAIN)}))

    def _number(self, state: frozenset[Position]) -> int:
        if state not in self.states:
            self.states[state] = len(self.positions)
            self.positions.append(state)
        return self.states[state]

    def _moves(self, position: Position, mask: int, left: int) -> Iterator[Position]:
        """Where a letter leads. The letter stands in the word at i if bit i of the mask is set."""
        at, made, kind = position
        has = lambda i: mask >> i & 1
        if kind == PLAIN:
            yield at, made + 1, PLAIN  # a letter more
            yield at + 1, made + 1, PLAIN  # another letter
            for skipped in range(self.edits - made + 1):  # letters left out, then the letter
                if has(at + skipped):
                    yield at + skipped + 1, made + skipped, PLAIN
            if has(at + 1):
                yield at, made + 1, SWAP
            if has(at + 2):
                yield at, made + 2, SWAP_OVER
        elif kind == SWAP:
            if has(at):
                yield at + 2, made, PLAIN
            yield at, made + 1, SWAP_WITHIN  # a letter between the two
        elif kind == SWAP_OVER and has(at):  # the letter between the two is left out
            yield at + 3, made, PLAIN
        elif kind == SWAP_WITHIN and has(at):
            yield at + 2, made, PLAIN

    def step(self, state: int, mask: int, left: int) -> tuple[int, int]:
        """The next state, -1 for none, and by how much its first position moved on."""
        key = state, mask, left
        if (known := self.steps.get(key)) is None:
            found = {q for p in self.positions[state] for q in self._moves(p, mask, left) if q[1] <= self.edits and q[0] <= left}
            # a position that another reaches with its own edits says nothing new
            kept = {q for q in found if not any(p[2] == PLAIN and p[1] < q[1] and q[1] - p[1] >= abs(q[0] - p[0]) and q[2] == PLAIN for p in found)}
            first = min((p[0] for p in kept), default=0)
            known = (self._number(frozenset((i - first, e, k) for i, e, k in kept)), first) if kept else (-1, 0)
            self.steps[key] = known
        return known

    def distance(self, state: int, left: int) -> int:
        """Edits if the entry ends here and so many letters of the word are left; more than allowed if none will do."""
        return min((e + left - i for i, e, kind in self.positions[state] if kind == PLAIN), default=self.edits + 1)


@dataclass
class Node:
    next: dict[str, Node] = field(default_factory=dict)
    codes: set[str] = field(default_factory=set)


#: One for each number of edits, shared by all words of a process.
_AUTOMATA = {edits: LevenshteinAutomaton(edits) for edits in range(MOST_EDITS + 1)}


class Trie:
    def __init__(self, paths: Iterable[tuple[str, str]]):
        """paths: (folded form, code)."""
        self.roots: dict[int, Node] = {}
        for form, code in paths:
            node = self.roots.setdefault(allowed(len(form)), Node())
            for c in form:
                node = node.next.setdefault(c, Node())
            node.codes.add(code)

    def search(self, word: str) -> dict[str, int]:
        """The codes of all paths within their allowed distance of the word, each with its least distance."""
        found: dict[str, int] = {}
        if not word:
            return found
        places: dict[str, int] = {}
        for i, c in enumerate(word):
            places[c] = places.get(c, 0) | 1 << i
        for edits, root in self.roots.items():
            machine = _AUTOMATA[edits]
            window = (1 << machine.reach) - 1
            stack = [(root, machine.start, 0)]
            while stack:
                node, state, at = stack.pop()
                left = len(word) - at
                if node.codes and (d := machine.distance(state, left)) <= edits:
                    for code in node.codes:
                        found[code] = min(d, found.get(code, d))
                near = min(left, machine.reach)
                for c, below in node.next.items():
                    then, moved = machine.step(state, places.get(c, 0) >> at & window, near)
                    if then >= 0:
                        stack.append((below, then, at + moved))
        return found


def alias_paths(name: str) -> set[str]:
    """A name's folded forms: itself, with its first word shortened, and with ligatures as two letters."""
    words = name.split()
    forms = {fold(name)}
    if len(words) > 1:
        for short in SHORT.get(words[0].lower(), []):
            forms.add(fold(short + " " + " ".join(words[1:])))
    return {spelt for f in forms if f for spelt in (f, unligated(f))}


def reference_paths(entries: Iterable[tuple[str, str, str | None]]) -> list[tuple[str, str]]:
    """(path, code) of a reference list of code, name and other names (parted by ;)."""
    out = set()
    for code, name, others in entries:
        for one in [name, *(others or "").split(";")]:
            out |= {(form, code) for form in alias_paths(one or "")}
    return sorted(out)


# -- matching ---------------------------------------------------------------------------------

MATCHED = "value string, distance int, codes array<string>, within array<struct<distance: int, code: string>>"


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _words(values: DataFrame, reference: DataFrame) -> DataFrame:
    """value, word: what of each value is searched: its parts but those that are a region's name, or all if all are, and a value of one part as a whole; folded."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for v in b.column(0).to_pylist():
                parts = parts_of(v)
                rows += [(v, fold(p), False) for p in parts]
                if len(parts) == 1:
                    rows.append((v, fold(v), True))
            yield _batch(rows, value=pa.string(), word=pa.string(), whole=pa.bool_())

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(fold(r),) for r in b.column(0).to_pylist()], word=pa.string())

    regions = reference.select("region").filter("region <> ''").distinct().mapInArrow(folded, "word string").distinct().withColumn("is_region", F.lit(True))
    parts = values.mapInArrow(cut, "value string, word string, whole boolean").join(regions, "word", "left")
    some = lambda c: F.collect_set(F.when(c, F.col("word")))
    sets = parts.groupBy("value").agg(some(~F.col("whole") & F.col("is_region").isNull()).alias("named"), some(~F.col("whole")).alias("parts"), some(F.col("whole")).alias("all"))
    words = F.array_union(F.when(F.size("named") > 0, F.col("named")).otherwise(F.col("parts")), "all")
    return sets.select("value", F.explode(words).alias("word")).filter("word <> ''")


def _paths(reference: DataFrame) -> DataFrame:
    """path, code, length of every form of every entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = reference_paths(zip(*(c.to_pylist() for c in b.columns), strict=True))
            yield _batch([(p, c, len(p)) for p, c in rows], path=pa.string(), code=pa.string(), length=pa.int32())

    return reference.select("code", "name", "others").mapInArrow(run, "path string, code string, length int").distinct()


def _blocks(histogram: list[tuple[int, int]], most: int) -> list[tuple[int, int, int, int]]:
    """(first block, blocks, shortest, longest): neighbouring lengths share a block up to `most` paths, a length with more has several."""
    out: list[list[int]] = []
    held = number = 0
    for length, n in histogram:
        if out and held + n <= most:
            out[-1][3] = length
        else:
            out.append([number, -(-n // most), length, length])
            number, held = number + out[-1][1], 0
        held += n
    return [tuple(x) for x in out]


def match_values(values: DataFrame, reference: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """value, distance, codes, within: the entries of each value that has any within the allowed distance: the least distance, the codes at it, and all with theirs.

    `values` has one column, value; `reference` has code, name, others and region.
    """
    spark = values.sparkSession
    forms = reference.filter("code is not null and name is not null")
    words = materialize(_words(values.filter("value is not null").distinct(), forms), "value-words")
    paths = materialize(_paths(forms), "paths")
    # a row per length: names are no longer than their longest, a few hundred letters
    histogram = sorted(map(tuple, paths.groupBy("length").count().collect()))
    blocks = spark.createDataFrame(_blocks(histogram, block_entries), "first int, parts int, shortest int, longest int")
    distinct = materialize(words.select("word", F.length("word").alias("length")).distinct(), "distinct-words")
    salts = max(1, -(-distinct.count() // TASK_WORDS))
    spot = lambda parts: (F.col("first") + F.pmod(F.xxhash64("path"), parts)).cast("int").alias("block")
    near = F.col("length").between(F.col("shortest") - MOST_EDITS, F.col("longest") + MOST_EDITS)
    left = distinct.join(F.broadcast(blocks), near).select("word", F.pmod(F.xxhash64("word"), F.lit(salts)).alias("salt"), F.explode(F.expr("sequence(first, first + parts - 1)")).alias("block"))
    right = paths.join(F.broadcast(blocks), F.col("length").between(F.col("shortest"), F.col("longest"))).select("path", "code", spot(F.col("parts")), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).alias("salt"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if len(a):
            trie = Trie(zip(b.column("path").to_pylist(), b.column("code").to_pylist(), strict=True))
            rows = [(w, d, c) for w in a.column("word").to_pylist() for c, d in trie.search(w).items()]
        return pa.Table.from_batches([_batch(rows, word=pa.string(), distance=pa.int32(), code=pa.string())])

    found = left.groupBy("block", "salt").cogroup(right.groupBy("block", "salt")).applyInArrow(meet, "word string, distance int, code string")
    hits = words.join(found, "word").groupBy("value", "code").agg(F.min("distance").alias("distance"))
    by_value = hits.groupBy("value").agg(F.min("distance").alias("distance"), F.array_sort(F.collect_list(F.struct("distance", "code"))).alias("within"))
    codes = F.transform(F.filter("within", lambda x: x["distance"] == F.col("distance")), lambda x: x["code"])
    return by_value.select("value", "distance", codes.alias("codes"), "within")


def canonical_codes(items: DataFrame, places: DataFrame, none: str = NONE) -> DataFrame:
    """item_id, place_name, place_code, distance for every item whose place_name has a letter and is no exact entry name.

    `items` has id, place_name, place_code and updated_at: of several rows of an
    id the one with the latest updated_at holds (without one it comes last; of
    ties, the last by name and code). `places` has place_code, place_name,
    region_name and other_names. The name decides: a value that is a code stands
    for its entry, else the nearest path of the trie does. Entries of one name are
    told apart by the region written in the value, then by the item's place_code,
    else the first code is taken. Values that stand for no entry get `none`. Empty
    items give no rows; without places every value is `none`. Other columns are
    ignored.
    """
    latest = items.filter("id is not null").groupBy("id").agg(
        F.max_by(F.struct("place_name", "place_code"), F.struct(F.coalesce("updated_at", F.to_timestamp(F.lit("0001-01-01"))), F.coalesce("place_name", F.lit("")), F.coalesce("place_code", F.lit("")))).alias("x")
    ).select(F.col("id").cast("bigint").alias("item_id"), "x.*")
    names = places.select(F.col("place_name").alias("exact")).filter("exact is not null").distinct()
    rows = latest.filter(F.col("place_name").rlike(r"\p{L}")).join(F.broadcast(names) if _small(names) else names, F.col("place_name") == F.col("exact"), "left_anti")
    reference = places.select(F.trim("place_code").alias("code"), F.col("place_name").alias("name"), F.col("other_names").alias("others"), F.col("region_name").alias("region"))
    # the distinct values, each searched once
    found = match_values(rows.select(F.col("place_name").alias("value")), reference).drop("within")
    bare = F.upper(F.regexp_replace("place_name", r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    by_code = reference.filter("code is not null").select(F.upper("code").alias("bare"), F.col("code").alias("as_code")).groupBy("bare").agg(F.min("as_code").alias("as_code"))
    rows = rows.withColumn("bare", bare).join(by_code, "bare", "left").join(found, F.col("place_name") == F.col("value"), "left")
    regions = reference.filter("code is not null and region is not null").groupBy(F.lower("region").alias("region_key")).agg(F.collect_set("code").alias("there"))
    tail = F.lower(F.trim(F.regexp_replace(F.regexp_extract("place_name", r"[,/(]\s*([^,/()]+?)\s*\)?\s*$", 1), r"[^\p{L}]+$", "")))
    rows = rows.withColumn("region_key", tail).join(regions, "region_key", "left")
    inside = F.filter("codes", lambda c: F.array_contains(F.col("there"), c))
    choices = F.when(F.size(inside) > 0, inside).otherwise(F.col("codes"))
    own = F.upper(F.trim("place_code"))
    hinted = F.filter(choices, lambda c: F.upper(c) == own)
    chosen = F.when(F.size(hinted) > 0, F.try_element_at(hinted, F.lit(1))).otherwise(F.try_element_at(choices, F.lit(1)))
    return rows.select("item_id", "place_name", F.coalesce("as_code", chosen, F.lit(none)).alias("place_code"), F.when(F.col("as_code").isNotNull(), 0).otherwise(F.col("distance")).alias("distance"))


def _small(df: DataFrame, limit: int = 10_000) -> bool:
    return df.limit(limit + 1).count() <= limit
