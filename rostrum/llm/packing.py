"""Filling fixed-capacity containers with items.

Only the histogram of lengths goes to the driver: at most as many numbers as the
capacity. Over it the configuration linear program (how many containers of each
content to use, so that every length is covered) is solved by multiplicative
weights. A length's price is its size, times a factor that falls exponentially
with the share of its items that are covered. A knapsack by dynamic programming
finds the content that is worth most at these prices; contents worth nearly as
much are taken from the same table, each by a step that covers no length by more
than a small share, and the prices of what it covers fall at once. The knapsack's
value also gives a lower bound on the number of containers (dual); steps are made
smaller until the program's value is within a stated gap of it.

Rounding: the program's amounts are rounded down. What is left is priced and
filled by the same knapsack in whole containers, as long as contents are found
that are worth it at the prices of the bound. The remainder is packed by best
fit, longest first.

The plan says, for each length, which of its items go to which containers. Items
are ranked within their length in two steps (counts per bucket, then ranks within
a bucket), so a length with a third of all items is no single task, and each
finds its container by its rank.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import materialize

#: How far the program's value may lie above its lower bound.
GAP = 0.005
#: Largest share of a length that a step covers, at first; halved until the gap is met, or so many knapsack cells were computed.
STEP, CELLS = 1.0, 600_000_000
#: Price lists in whole parts that are tried for the lower bound.
PARTS = 8
#: How much the price of a length falls, in powers of e, while it is covered.
RATE = 1.0
#: How far below the best a content may be worth, to be taken.
SLACK = 0.01
#: Items that are ranked by one window, about.
BUCKET_ITEMS = 200_000
#: Most runs of a plan that are sent to every task, at 40 bytes.
MAX_RUNS = 2_000_000

Content = tuple[tuple[int, int], ...]


class Knapsack:
    """The greatest price of items that fit into each size, at most `most` of a length, and the items."""

    def __init__(self, lengths: np.ndarray, most: np.ndarray, prices: np.ndarray, capacity: int, order: np.ndarray):
        parts: list[tuple[int, int]] = []  # a length's copies in powers of two
        for i in order:
            if prices[i] <= 0:
                continue
            rest, n = min(int(most[i]), capacity // int(lengths[i])), 1
            while rest > 0:
                parts.append((int(i), min(n, rest)))
                rest, n = rest - n, 2 * n
        self.parts, self.lengths, self.capacity = parts, lengths, capacity
        self.best = np.zeros(capacity + 1)
        self.last = np.empty((len(parts), capacity + 1), np.int32)
        last = np.full(capacity + 1, -1, np.int32)
        for k, (i, n) in enumerate(parts):
            size = n * int(lengths[i])
            value = self.best[:-size] + n * prices[i]
            better = value > self.best[size:]
            np.copyto(self.best[size:], value, where=better)
            last[size:][better] = k
            self.last[k] = last

    def content(self, size: int) -> dict[int, int]:
        """Items worth best[size]."""
        out: dict[int, int] = {}
        k = len(self.parts) - 1
        while k >= 0 and (k := int(self.last[k, size])) >= 0:
            i, n = self.parts[k]
            out[i] = out.get(i, 0) + n
            size -= n * int(self.lengths[i])
            k -= 1
        return out

    def contents(self, longest_first: np.ndarray, most: np.ndarray) -> Iterator[dict[int, int]]:
        """The best content, then for each length the best beside one item of it."""
        yield self.content(self.capacity)
        for i in longest_first:
            found = self.content(self.capacity - int(self.lengths[i]))
            found[int(i)] = found.get(int(i), 0) + 1
            if found[int(i)] <= most[i]:
                yield found


@dataclass
class Program:
    """Contents with the fractional number of containers of each, their sum, a lower bound of it, and the prices that prove the bound (no content is worth more than 1)."""

    amounts: dict[Content, float]
    value: float
    bound: float
    prices: np.ndarray
    cells: int = 0
    #: The amounts of each step size that was tried; some round better than those of the least value.
    tried: tuple[dict[Content, float], ...] = ()


def _first_prices(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best lower bound among a few price lists, and the list: sizes in proportion, and in whole parts of k + 1 (a length above half a container costs a whole one at k = 1)."""
    found = (0.0, np.zeros(len(lengths)))
    for k in range(PARTS + 1):
        parts = lengths * (k + 1) / capacity
        prices = parts if k == 0 else np.where(lengths * (k + 1) % capacity == 0, parts / (k + 1), np.floor(parts) / k)
        top = Knapsack(lengths, counts, prices, capacity, np.arange(len(lengths))).best[capacity]
        if top > 0 and (bound := float((counts * prices).sum() / top)) > found[0] * (1 + 1e-9):
            found = (bound, prices / top)
    return found


def _prices(first: np.ndarray, share: np.ndarray, rate: float) -> np.ndarray:
    """Prices of lengths of which these shares are still to be covered; 0 for those that are covered."""
    return np.where(share > 1e-9, first * np.exp(rate * (share - 1)), 0.0)


def _solve(lengths: np.ndarray, counts: np.ndarray, capacity: int, first: np.ndarray, step: float, rate: float, seed: int, slack: float = SLACK) -> Program:
    rng = np.random.default_rng(seed)
    rest = counts.astype(float)
    amounts: dict[Content, float] = defaultdict(float)
    bound, proof, cells = 0.0, np.zeros(len(lengths)), 0
    longest_first = np.argsort(-lengths, kind="stable")
    while (rest > 1e-9 * counts).any():
        prices = _prices(first, rest / counts, rate)
        table = Knapsack(lengths, counts, prices, capacity, rng.permutation(len(lengths)))
        top = table.best[capacity]
        cells += table.last.size
        if (dual := float((counts * prices).sum() / top)) > bound:
            bound, proof = dual, prices / top
        for content in table.contents(longest_first[prices[longest_first] > 0], counts):
            at, n = np.array(list(content)), np.array(list(content.values()))
            if float(prices[at] @ n) < (1 - slack) * top:
                continue  # what it covers has been covered meanwhile
            amount = float(np.minimum(rest[at] / n, step * counts[at] / n).min())
            if amount <= 0:
                continue
            amounts[tuple(sorted(content.items()))] += amount
            rest[at] = np.maximum(rest[at] - amount * n, 0.0)
            prices[at] = _prices(first[at], rest[at] / counts[at], rate)
    return Program(amounts, sum(amounts.values()), bound, proof, cells)


def configuration_program(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = GAP, step: float = STEP, rate: float = RATE) -> Program:
    """The configuration program to within `gap` of its lower bound, or as near as the smallest step comes."""
    bound, proof = _first_prices(lengths, counts, capacity)
    best: Program | None = None
    tried: list[dict[Content, float]] = []
    cells = k = 0
    while best is None or (best.value > (1 + gap) * bound and cells < CELLS and k < 9):
        # the prices of the bound, so far as they leave none without any
        found = _solve(lengths, counts, capacity, 0.9 * proof + 0.1 * lengths / capacity, step / 2**k, min(rate * 2**k, 50.0), k, SLACK / 2**k)
        cells, k = cells + found.cells, k + 1
        tried.append(found.amounts)
        if found.bound > bound:
            bound, proof = found.bound, found.prices
        best = min(found, best or found, key=lambda p: p.value)
    return Program(best.amounts, best.value, bound, proof, cells, tuple(tried))


def best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Contents and numbers of containers for what is left, longest first, each into the fullest container that takes it."""
    groups: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    free: list[int] = []

    def put(room: int, content: dict[int, int], number: int) -> None:
        if not groups[room]:
            bisect.insort(free, room)
        groups[room].append((content, number))

    for i in np.argsort(-lengths, kind="stable"):
        length, rest = int(lengths[i]), int(left[i])
        while rest:
            at = bisect.bisect_left(free, length)
            if at == len(free):
                each = min(capacity // length, rest)
                number = rest // each
                put(capacity - each * length, {int(i): each}, number)
                rest -= number * each
                continue
            room = free[at]
            content, number = groups[room].pop()
            if not groups[room]:
                free.pop(at)
            each = min(room // length, rest)
            take = min(number, rest // each)
            if take < number:
                put(room, content, number - take)
            filled = dict(content)
            filled[int(i)] = filled.get(int(i), 0) + each
            put(room - each * length, filled, take)
            rest -= take * each
    return [x for xs in groups.values() for x in xs]


@dataclass(frozen=True)
class Plan:
    """Per length: sorted first ranks of its runs, and for each run the first container, the items of that length per container and the tokens in each container."""

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    containers: int
    used: int
    #: The program's value and lower bound, and containers by origin: rounded down, priced in whole, best fit.
    value: float = 0.0
    bound: float = 0.0
    origins: tuple[int, int, int] = (0, 0, 0)


def _rounded_down(amounts: dict[Content, float], left: np.ndarray) -> list[tuple[dict[int, int], int]]:
    chosen = []
    for content in sorted(amounts, key=lambda c: (-amounts[c], c)):
        copies = min(int(amounts[content] + 1e-6), *(int(left[i]) // n for i, n in content))
        if copies > 0:
            for i, n in content:
                left[i] -= n * copies
            chosen.append((dict(content), copies))
    return chosen


def _whole_containers(program: Program, lengths: np.ndarray, left: np.ndarray, capacity: int, rate: float = RATE) -> list[tuple[dict[int, int], int]]:
    """Whole containers for what is left, by the same pricing, as long as some are worth nearly 1 at the prices of the bound."""
    rng = np.random.default_rng(1)
    counts = left.astype(float)
    chosen = []
    longest_first = np.argsort(-lengths, kind="stable")
    while left.any():
        share = np.divide(left, counts, out=np.zeros(len(left)), where=counts > 0)
        # at equal shares these are the prices of the bound
        prices = np.where(left > 0, program.prices * np.exp(rate * (share - share.max())), 0.0)
        table = Knapsack(lengths, left, prices, capacity, rng.permutation(len(lengths)))
        before = len(chosen)
        for content in table.contents(longest_first[left[longest_first] > 0], left):
            at, n = np.array(list(content), np.int64), np.array(list(content.values()), np.int64)
            if not len(at) or float(program.prices[at] @ n) < 1 - SLACK:
                continue
            if (copies := int((left[at] // n).min())) > 0:
                copies = max(1, copies // 4)
                left[at] -= copies * n
                chosen.append((content, copies))
        if len(chosen) == before:
            break
    return chosen


def _number(plan: list[tuple[dict[int, int], int]]) -> int:
    return sum(n for _, n in plan)


def make_plan(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = GAP) -> Plan:
    """Containers for `counts` items of each length; every length is at least 1 and at most the capacity. Of the roundings for each step size the one with the fewest containers is taken."""
    program, steps = Program({}, 0.0, 0.0, np.zeros(0)), []
    if len(lengths):
        program = configuration_program(lengths, counts, capacity, gap)
        roundings = []
        for amounts in program.tried:
            left = counts.astype(np.int64).copy()
            roundings.append([_rounded_down(amounts, left), _whole_containers(program, lengths, left, capacity), best_fit(lengths, left, capacity)])
        steps = min(roundings, key=lambda r: sum(map(_number, r)))
    parts: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    placed: dict[int, int] = defaultdict(int)
    base = 0
    for content, copies in (x for xs in steps for x in xs):
        tokens = sum(int(lengths[i]) * n for i, n in content.items())
        for i, n in content.items():
            length = int(lengths[i])
            parts[length].append((placed[length], base, n, tokens))
            placed[length] += n * copies
        base += copies
    runs = {length: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for length, rows in parts.items()}
    if sum(len(x[0]) for x in runs.values()) > MAX_RUNS:
        raise ValueError(f"a plan of more than {MAX_RUNS} runs")
    return Plan(runs, base, int((lengths * counts).sum()), program.value, program.bound, tuple(_number(x) for x in steps) or (0, 0, 0))


def _assign(plan_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan_of.value
        for b in batches:
            length, rank = b.column("tokens").to_numpy(), b.column("rank").to_numpy()
            container, filled = np.full(len(b), -1), np.zeros(len(b), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for at in np.split(order, cuts) if len(order) else []:
                first, base, each, tokens = runs[int(length[at[0]])]
                k = np.searchsorted(first, rank[at], side="right") - 1
                container[at] = base[k] + (rank[at] - first[k]) // each[k]
                filled[at] = tokens[k]
            keep = [b.column(n) for n in ("id", "piece", "token_start", "tokens")]
            yield pa.RecordBatch.from_arrays([pa.array(container), *keep, pa.array(filled)], names=["container_id", "id", "piece", "token_start", "tokens", "container_tokens"])

    return run


@dataclass(frozen=True)
class Packing:
    """What lies in each container (`rows`), and the plan it follows."""

    rows: DataFrame
    plan: Plan


def pack(sizes: DataFrame, id_col: str, size_col: str, capacity: int = 2048, gap: float = GAP) -> Packing:
    """Rows of container_id, id, piece, token_start, tokens, container_tokens, unused, and the plan.

    Items longer than the capacity are cut into full containers and a rest, which
    is packed like an item (piece counts from 1); others stay whole. Items of size
    0, or of unknown size, need no room: their container_id, container_tokens and
    unused are null. Rows without an id take no part; repeated rows of one id
    count once, at their greatest size. An empty table gives no rows.
    """
    spark = sizes.sparkSession
    items = sizes.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)).alias("size")).filter("id is not null and size >= 0")
    items = materialize(items.groupBy("id").agg(F.max("size").alias("size")), "item-sizes")
    pieces = items.filter("size > 0").select("id", "size", F.posexplode(F.sequence(F.lit(0), F.col("size") - 1, F.lit(capacity))).alias("k", "token_start"))
    pieces = pieces.select("id", (F.col("k") + 1).alias("piece"), F.col("token_start").cast("bigint"), F.least(F.lit(capacity), F.col("size") - F.col("token_start")).cast("bigint").alias("tokens"))
    buckets = max(1, -(-items.count() // BUCKET_ITEMS))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    by_bucket = pieces.groupBy("tokens", "bucket").agg(F.count("*").alias("n"))
    histogram = sorted(map(tuple, by_bucket.groupBy("tokens").agg(F.sum("n").alias("n")).collect()))  # at most `capacity` rows
    lengths, counts = (np.array([r[i] for r in histogram], np.int64) for i in (0, 1))
    plan = make_plan(lengths, counts, capacity, gap)
    before = F.sum("n").over(Window.partitionBy("tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_bucket.select("tokens", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("tokens", "bucket").orderBy("id", "piece"))
    ranked = pieces.select("*", within.alias("k")).join(offsets, ["tokens", "bucket"])
    ranked = ranked.select("id", "piece", "token_start", "tokens", (F.col("offset") + F.col("k") - 1).alias("rank"))
    shared = spark.sparkContext.broadcast(plan.runs)  # of at most MAX_RUNS
    packed = ranked.mapInArrow(_assign(shared), "container_id bigint, id bigint, piece int, token_start bigint, tokens bigint, container_tokens bigint")
    packed = packed.withColumn("unused", capacity - F.col("container_tokens"))
    none = F.lit(None).cast("bigint")
    empty = items.filter("size = 0").select(none.alias("container_id"), "id", F.lit(1).alias("piece"), F.lit(0).cast("bigint").alias("token_start"), F.lit(0).cast("bigint").alias("tokens"), none.alias("container_tokens"), none.alias("unused"))
    return Packing(packed.unionByName(empty), plan)


def containers(packed: DataFrame) -> DataFrame:
    """One row per container: items, tokens and unused space."""
    rows = packed.filter("container_id is not null")
    return rows.groupBy("container_id").agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens"), F.min("unused").alias("unused"))
