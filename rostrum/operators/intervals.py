"""Overlapping and gapped time intervals.

The aggregate is a sorted list of disjoint intervals. It is mergeable: partial
lists combine by one linear pass, in any order and any number of times, so
repeated rows change nothing. The reduction is a tree:

1. Each map task turns its rows into partial lists, one per owner and time cell.
2. Where there are many map tasks, lists of a cell are first merged for groups of
   `FAN` tasks, and those again, until at most so many are left for a cell.
3. After the last shuffle, by (owner, cell), the partial lists of a cell are
   merged as they stream in. A cell list is bounded by the cell's length over the
   tolerance, however many rows it came from, so an owner with a third of all rows
   is spread over its cells and never gathered into one task.
4. Windows over one small summary row per cell carry the latest end and the
   latest start of a period from cell to cell.
5. Each cell then emits its periods and the complement gaps before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import materialize, size_in_bytes

#: Half an hour: at the default tolerance a cell list has at most 1,200 intervals.
CELL_MS = 1_800_000
TOLERANCE_MS = 1_500
#: Partial lists that are merged at a node of the tree, and rows that a map task merges at once.
FAN, TASK_ROWS = 64, 200_000
#: Bytes that a map task reads, about.
TASK_BYTES = 16 << 20

LISTS = "owner bigint, cell bigint, starts array<bigint>, ends array<bigint>, syn_starts array<bigint>, syn_ends array<bigint>"
OPENINGS = "owner bigint, cell bigint, opens array<bigint>, before array<bigint>, synthetic array<boolean>"


def merge_intervals(key: np.ndarray, start: np.ndarray, end: np.ndarray, tolerance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint intervals by key, ordered by key and start.

    Intervals join while the next start is at most `tolerance` after the latest
    end so far.
    """
    if not len(key):
        return key, start, end
    order = _merge_order(key, start)
    key, start, end = key[order], start[order], end[order]
    first = np.r_[True, key[1:] != key[:-1]]
    latest = running_max(first, end)
    opens = first | np.r_[True, start[1:] > latest[:-1] + tolerance]
    at = np.flatnonzero(opens)
    return key[at], start[at], np.maximum.reduceat(end, at)


def _merge_order(key: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The order by key and start. Partial lists are sorted runs, which the stable sort finds and merges in linear passes."""
    low, high = int(start.min()), int(start.max())
    first = int(key.min())
    if (int(key.max()) - first + 1) * (high - low + 1) < 2**62:
        return np.argsort((key - first) * (high - low + 1) + (start - low), kind="stable")
    return np.lexsort((start, key))


def running_max(first: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Running maximum that begins anew where `first` is true."""
    low, high = int(value.min()), int(value.max())
    group = np.cumsum(first) - 1
    if (high - low + 1) * int(group[-1] + 1) < 2**62:
        lift = group.astype(np.int64) * (high - low + 1)
        return np.maximum.accumulate(value - low + lift) - lift + low
    return np.concatenate([np.maximum.accumulate(x) for x in np.split(value, np.flatnonzero(first)[1:])])


def _list_batch(owner: np.ndarray, cell: np.ndarray, kind: np.ndarray, start: np.ndarray, end: np.ndarray, tolerance: int) -> pa.RecordBatch | None:
    """One row per (owner, cell) with the merged lists of both kinds."""
    if not len(owner):
        return None
    order = np.lexsort((cell, owner))
    owner, cell, kind, start, end = (x[order] for x in (owner, cell, kind, start, end))
    first = np.r_[True, (owner[1:] != owner[:-1]) | (cell[1:] != cell[:-1])]
    group = np.cumsum(first) - 1
    columns: list[pa.Array] = [pa.array(owner[first]), pa.array(cell[first])]
    for which, gap in ((0, tolerance), (1, 0)):
        at = kind == which
        k, s, e = merge_intervals(group[at], start[at], end[at], gap)
        offsets = pa.array(np.searchsorted(k, np.arange(group[-1] + 2)).astype(np.int32))
        columns += [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (s, e)]
    return pa.RecordBatch.from_arrays(columns, names=["owner", "cell", "starts", "ends", "syn_starts", "syn_ends"])


def _partial(tolerance: int, cell_ms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            owner, kind, start, end = (np.concatenate(x) for x in zip(*held, strict=True))
            out = _list_batch(owner, start // cell_ms, kind, start, end, tolerance)
            if out is not None:
                yield out

        for b in batches:
            held.append(tuple(b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)))
            count += len(b)
            if count >= TASK_ROWS:
                yield from flush()
                held, count = [], 0
        if held:
            yield from flush()

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    owner, cell = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1))
    parts = []
    for which, (s, e) in enumerate(((2, 3), (4, 5))):
        starts, ends = batch.column(s), batch.column(e)
        row = np.repeat(np.arange(len(batch)), np.diff(starts.offsets.to_numpy()))  # of a slice: its own offsets
        parts.append((owner[row], cell[row], np.full(len(row), which), starts.flatten().to_numpy(), ends.flatten().to_numpy()))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))


def _combine(tolerance: int):
    """Merges the partial lists of rows sorted by (owner, cell). A key may cross batches; its list so far is kept merged, so it never outgrows a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        for b in batches:
            if not len(b):
                continue
            rows = _flat(b)
            if held is not None:
                rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
            merged = _list_batch(*rows, tolerance)
            if merged is not None:
                yield merged.slice(0, len(merged) - 1)
                held = _flat(merged.slice(len(merged) - 1))
        if held is not None:
            done = _list_batch(*held, tolerance)
            if done is not None:
                yield done

    return run


def _openings(tolerance: int):
    """For each cell: the starts that open a period, the latest end before each, and whether a synthetic interval reaches into that gap."""
    floor = np.iinfo(np.int64).min // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                s, e = np.array(r["starts"], np.int64), np.array(r["ends"], np.int64)
                carried = floor if r["latest"] is None else r["latest"]
                before = np.maximum.accumulate(np.r_[carried, e])[: len(s)]
                opens = s > before + tolerance
                opens[:1] |= carried == floor
                at, prior = s[opens], before[opens]
                ss, se = np.array(r["syn_starts"], np.int64), np.array(r["syn_ends"], np.int64)
                reach = np.maximum.accumulate(np.r_[floor if r["syn_latest"] is None else r["syn_latest"], se])
                synthetic = reach[np.searchsorted(ss, at, side="left")] > prior
                rows.append({"owner": r["owner"], "cell": r["cell"], "opens": at.tolist(), "before": [None if x == floor else int(x) for x in prior], "synthetic": synthetic.tolist()})
            schema = pa.schema([("owner", pa.int64()), ("cell", pa.int64()), ("opens", pa.list_(pa.int64())), ("before", pa.list_(pa.int64())), ("synthetic", pa.list_(pa.bool_()))])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def interval_lists(df: DataFrame, owner: str, start: str, end: str, synthetic: str, tolerance_ms: int = TOLERANCE_MS, cell_ms: int = CELL_MS) -> DataFrame:
    """One row per owner and time cell with its sorted disjoint intervals of both kinds."""
    ms = lambda c: F.round(F.col(c).cast("double") * 1000.0).try_cast("bigint")
    rows = df.select(F.col(owner).cast("bigint").alias("owner"), F.col(synthetic).cast("int").alias("kind"), ms(start).alias("s"), ms(end).alias("e"))
    rows = rows.filter("owner is not null and kind in (0, 1) and s is not null and e is not null and e > s")
    lists = rows.mapInArrow(_partial(tolerance_ms, cell_ms), LISTS)
    combine = lambda dealt: dealt.sortWithinPartitions("owner", "cell").mapInArrow(_combine(tolerance_ms), LISTS)
    branches = size_in_bytes(rows) // TASK_BYTES // FAN  # about as many map tasks
    while branches > 1:
        lists = combine(lists.withColumn("branch", F.spark_partition_id() % branches).repartition("owner", "cell", "branch").drop("branch"))
        branches //= FAN
    return combine(lists.repartition("owner", "cell"))


def periods_and_gaps(df: DataFrame, owner: str, start: str, end: str, synthetic: str, tolerance_ms: int = TOLERANCE_MS, cell_ms: int = CELL_MS) -> DataFrame:
    """Continuous periods of each owner, and the gaps between them.

    Returns owner, period_kind ('period', 'gap' or 'gap_synthetic'), start_ms,
    end_ms. Times are seconds, rounded to whole milliseconds. A period is a
    maximal union of intervals with synthetic = 0 in which each begins at most
    `tolerance_ms` after the latest end so far. A gap is synthetic if an interval
    with synthetic = 1 shares more than a point with it.

    Defined cases: rows with a null owner, start, end or flag, NaN and infinite times, and
    rows whose end is not after their start are left out. Repeated rows count
    once. An owner with synthetic intervals only has no row. An empty table gives
    an empty result. Other columns of df are ignored, whatever their names.
    """
    lists = materialize(interval_lists(df, owner, start, end, synthetic, tolerance_ms, cell_ms), "interval-lists")
    order = Window.partitionBy("owner").orderBy("cell")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = lists.select("owner", "cell", F.array_max("ends").alias("end"), F.array_max("syn_ends").alias("syn_end"))
    carried = ends.select(
        "owner", "cell", F.max("end").over(earlier).alias("latest"), F.max("syn_end").over(earlier).alias("syn_latest"),
        F.max("end").over(Window.partitionBy("owner")).alias("final"),
    )
    carried = materialize(carried, "carried")
    opened = materialize(lists.join(carried, ["owner", "cell"]).mapInArrow(_openings(tolerance_ms), OPENINGS), "openings")
    heads = opened.select("owner", "cell", F.try_element_at("opens", F.lit(-1)).alias("last_open")).filter("last_open is not null")
    finals = carried.select("owner", "final").distinct().filter("final is not null")
    linked = heads.select("owner", "cell", F.last("last_open").over(earlier).alias("prior"))
    steps = opened.join(linked, ["owner", "cell"]).select(
        "owner", F.posexplode(F.arrays_zip("opens", "before", "synthetic")).alias("i", "x"), "opens", "prior",
    )
    steps = steps.select(
        "owner", F.col("x.opens").alias("opens_at"), F.col("x.before").alias("before"), F.col("x.synthetic").alias("synthetic"),
        F.when(F.col("i") == 0, F.col("prior")).otherwise(F.expr("opens[i - 1]")).alias("period_start"),
    ).filter("before is not null")
    pair = F.explode(
        F.array(
            F.struct(F.lit("period").alias("period_kind"), F.col("period_start").alias("start_ms"), F.col("before").alias("end_ms")),
            F.struct(F.when(F.col("synthetic"), "gap_synthetic").otherwise("gap").alias("period_kind"), F.col("before").alias("start_ms"), F.col("opens_at").alias("end_ms")),
        )
    )
    inner = steps.select("owner", pair.alias("x")).select("owner", "x.*")
    closing = heads.groupBy("owner").agg(F.max("last_open").alias("start_ms")).join(finals, "owner")
    closing = closing.select("owner", F.lit("period").alias("period_kind"), "start_ms", F.col("final").alias("end_ms"))
    return inner.unionByName(closing)
