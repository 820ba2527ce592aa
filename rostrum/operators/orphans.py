"""References to records that do not exist, were deleted, or came later.

Keys are cut into ranges. Within a range the keys of both sides are encoded as
dense integers, and each (table, period) becomes one compressed bitmap of the
codes it refers to. Reference AND-NOT parent leaves the missing codes, reference
AND deleted the deleted ones, and reference AND-NOT available-before-the-period
the codes that may have come late. The surviving bits are decoded to keys and
joined back to the rows; lateness is then decided row by row.

References are reduced to distinct (table, period, key) before the shuffle, so a
key that a third of all rows refer to counts once per map task. The join back
to the rows has one row per surviving key and period on its side; adaptive
execution splits a hot key's rows over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.bitmap import Bitmap
from rostrum.session import partitions, size_in_bytes

SCHEMA = pa.schema([("ref_table", pa.string()), ("domain", pa.string()), ("period", pa.int32()), ("key", pa.string()), ("state", pa.string()), ("since", pa.timestamp("us", "UTC"))])
SURVIVORS = "ref_table string, domain string, period int, key string, state string, since timestamp"
#: Bytes of the referring and parent columns whose keys make a range.
RANGE_BYTES = 16 << 20
#: No time given: such a reference can't be late.
NO_PERIOD = -1


@dataclass(frozen=True)
class Reference:
    """A referring column. `at` is the time that counts for lateness and for the period."""

    table: str
    rows: DataFrame
    row_id: str
    key: str
    at: str
    domain: str
    #: Of several copies of a row the earliest time counts.
    repeats: bool = True


@dataclass(frozen=True)
class Parent:
    domain: str
    rows: DataFrame
    key: str
    since: str | None = None
    deleted_at: str | None = None
    #: For keys that come in several versions: the column that says which holds.
    version: str | None = None
    identity: str | None = None


def normal_key(column: str, df: DataFrame) -> Column:
    """Text keys are equal without regard to case and outer blanks; a blank key is none."""
    text = F.upper(F.regexp_replace(F.col(column).cast("string"), r"^\s+|\s+$", ""))
    return F.when(text != "", text)


def _period(column: str) -> Column:
    return F.coalesce(F.year(column) * 12 + F.month(column) - 1, F.lit(NO_PERIOD)).cast("int")


def _reference_rows(ref: Reference) -> DataFrame:
    rows = ref.rows.select(F.col(ref.row_id).cast("bigint").alias("row_id"), normal_key(ref.key, ref.rows).alias("key"), F.col(ref.at).cast("timestamp").alias("at"))
    rows = rows.filter("row_id is not null and key is not null")
    if ref.repeats:
        rows = rows.groupBy("row_id", "key").agg(F.min("at").alias("at"))
    return rows.select(F.lit(ref.table).alias("ref_table"), F.lit(ref.domain).alias("domain"), "row_id", "key", "at", _period("at").alias("period"))


def _parent_rows(parent: Parent) -> DataFrame:
    none = F.lit(None).cast("timestamp")
    col = lambda c: F.col(c).cast("timestamp") if c else none
    rows = parent.rows.select(
        normal_key(parent.key, parent.rows).alias("key"), col(parent.since).alias("since"), col(parent.deleted_at).alias("deleted_at"),
        *([F.col(parent.version).alias("version"), F.col(parent.identity).alias("identity")] if parent.version and parent.identity else []),
    )
    if parent.version and parent.identity:
        state = F.struct("key", "since", "deleted_at")
        rank = F.struct(F.col("version").isNotNull(), "version", F.col("deleted_at").isNotNull(), "deleted_at", "key")
        rows = rows.groupBy("identity").agg(F.max_by(state, rank).alias("x")).select("x.*")
    rows = rows.filter("key is not null")
    # several records under one key: it is deleted if all are, and there since the first that lives
    live = F.col("deleted_at").isNull()
    rows = rows.groupBy("key").agg((~F.bool_or(live)).alias("deleted"), F.min(F.when(live, F.col("since"))).alias("since"))
    return rows.select(F.lit(parent.domain).alias("domain"), "key", "deleted", "since", _period("since").alias("since_period"))


def _survivors(refs: pa.Table, parents: pa.Table) -> pa.Table:
    """AND-NOT within one key range."""
    if not len(refs):
        return SCHEMA.empty_table()
    both = pa.chunked_array([*refs.column("key").chunks, *parents.column("key").chunks], pa.string()).combine_chunks()
    encoded = (both.chunk(0) if isinstance(both, pa.ChunkedArray) else both).dictionary_encode()
    codes = encoded.indices.to_numpy().astype(np.int64)
    child, parent = codes[: len(refs)], codes[len(refs) :]
    numbers = lambda t, c: t.column(c).to_numpy()
    exists = Bitmap.of(parent)
    deleted = Bitmap.of(parent[numbers(parents, "deleted").astype(bool)])
    since = np.full(len(encoded.dictionary), np.datetime64("NaT", "us"))
    since[parent] = numbers(parents, "since").astype("datetime64[us]")
    since_period = numbers(parents, "since_period")
    by_age = np.argsort(since_period, kind="stable")
    parent, since_period = parent[by_age], since_period[by_age]
    # rows of a table and period together, periods in order: what was there before a period is filled once
    tables = refs.column("ref_table").combine_chunks().dictionary_encode()
    tables = tables.chunk(0) if isinstance(tables, pa.ChunkedArray) else tables
    table, period = tables.indices.to_numpy(), numbers(refs, "period")
    order = np.lexsort((table, period))
    cuts = np.flatnonzero((np.diff(table[order]) != 0) | (np.diff(period[order]) != 0)) + 1
    before, filled = Bitmap({}), 0
    out: list[tuple[int, int, str, np.ndarray]] = []
    for rows in np.split(order, cuts):
        at = int(period[rows[0]])
        referred = Bitmap.of(child[rows])
        live = (referred & exists).andnot(deleted)
        if (upto := int(np.searchsorted(since_period, at))) > filled:
            before, filled = before | Bitmap.of(parent[filled:upto]), upto
        late = live.andnot(before) if at != NO_PERIOD else Bitmap({})
        for state, bits in (("missing", referred.andnot(exists)), ("deleted", referred & deleted), ("late", late)):
            if len(found := bits.codes()):
                out.append((int(table[rows[0]]), at, state, found))
    if not out:
        return SCHEMA.empty_table()
    sizes = [len(x[3]) for x in out]
    at = np.concatenate([x[3] for x in out])
    repeat = lambda values, kind: pa.array(np.repeat(np.array(values, kind), sizes))
    domain = pa.array([refs.column("domain")[0].as_py()] * len(at))
    columns = [tables.dictionary.take(repeat([x[0] for x in out], np.int64)), domain, repeat([x[1] for x in out], np.int32), encoded.dictionary.take(pa.array(at)), repeat([x[2] for x in out], object), pa.array(since[at], pa.timestamp("us", "UTC"))]
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


def orphans(references: list[Reference], parents: list[Parent]) -> DataFrame:
    """Each orphan row: ref_table, row_id, orphan_state ('missing', 'deleted', 'late'), period (its month, null without a time).

    Defined cases: a null or blank reference is none, and so is a row without an
    id. Repeated rows count once, at their earliest time. A row without a time
    can be missing or deleted but not late. Of several versions of a parent the
    latest holds, a version without a time before all others, and of versions of
    the same time a deleted one. Empty tables on either side are allowed; without
    parents every reference is missing. Further columns are ignored.
    """
    rows = [_reference_rows(r) for r in references]
    spark = rows[0].sparkSession
    ranges = max(partitions(spark), -(-sum(size_in_bytes(t) for t in [*rows, *(p.rows.select(p.key) for p in parents)]) // RANGE_BYTES))
    refs = rows[0]
    for r in rows[1:]:
        refs = refs.unionByName(r)
    known = _parent_rows(parents[0])
    for p in parents[1:]:
        known = known.unionByName(_parent_rows(p))
    key_range = F.pmod(F.xxhash64("domain", "key"), F.lit(ranges)).cast("int")
    distinct = refs.select("ref_table", "domain", "period", "key").distinct().withColumn("key_range", key_range)
    known = known.withColumn("key_range", key_range)
    found = distinct.groupBy("domain", "key_range").cogroup(known.groupBy("domain", "key_range"))
    found = found.applyInArrow(_survivors, SURVIVORS)
    joined = refs.join(found, ["ref_table", "domain", "period", "key"])
    joined = joined.filter("state <> 'late' or since > at")
    month = F.when(F.col("period") != NO_PERIOD, F.make_date(F.floor(F.col("period") / 12).cast("int"), F.col("period") % 12 + 1, F.lit(1)))
    return joined.select("ref_table", "row_id", F.col("state").alias("orphan_state"), month.alias("period"))


def orphan_counts(found: DataFrame) -> DataFrame:
    """Orphans per table, month and state."""
    return found.groupBy("ref_table", "period", "orphan_state").agg(F.count("*").alias("orphans"))
