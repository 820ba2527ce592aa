"""Near-duplicate records with small edits: an exact set-similarity join by grouped prefixes.

A text is the set of its distinct word sequences (shingles). All pairs whose
Jaccard similarity is at least a threshold are found; nothing is sampled, capped
or left to chance but hash collisions.

Order. Shingles are ordered by how often they occur, from a counting sketch of
fixed size over all texts. Any order is right; this one puts boilerplate last.

Prefix. Sets of sizes n and m that are alike enough share a = t/(1+t) (n+m)
shingles or more, so k of them lie in the first n - a + k of either. Shingles
fall into g classes by hash; with k = g + 1, two shared ones of the prefix fall
into one class. A text is therefore announced under every two prefix shingles of
one class. Two shingles together are rare where one alone is not, so nearly all
texts that meet are alike. Sizes are cut into bands, each with its own g.

Groups. Texts with the same prefix and size are announced as one group, whose name
of six bytes is a hash of both and the size in steps of a twentieth; exact copies
are such a group. Should two groups get one name, their members are verified like
those of one. Announcements are dealt to buckets
by signature, as many as the sets' size asks for, so that a bucket is as large
for any number of texts; groups under a signature that very many share meet in a
join that is cut into blocks. Groups that meet are filtered by size, then
expanded to their distinct sets, and these are verified on the whole sets. Copies never make pairs among themselves before the very end, and only in
`similar_pairs`, whose result is the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.shingles import mix, shingle_hashes, text_buffer, word_hashes
from rostrum.operators.graph import connected
from rostrum.session import materialize, partitions, parts_for

#: Cells of the counting sketch, a power of two.
SKETCH_BITS = 19
SKETCH_BLOCKS = 16
#: Bits of the filter over the texts to be verified.
FILTER_BITS = 24
#: Texts that are announced together; their index must fit 16 bits.
CHUNK_TEXTS = 20_000
CHUNK_SHINGLES = 2_000_000
#: Bytes of sets whose announcements make a bucket; these take about twice as many.
BUCKET_BYTES = 2 << 20
#: Groups under one signature that are paired within a task; those of longer lists meet in a join.
HOT = 2_000
#: Smallest set that is announced under two shingles; smaller ones go under one.
LEAST_PAIRED = 32
#: Sizes are told apart by this factor in a group's name.
SIZE_STEP = 1.05
BAND_FACTOR = 8

SETS = pa.schema([("id", pa.int64()), ("set_hash", pa.int64()), ("n", pa.int32()), ("shingles", pa.binary())])
MEETINGS = pa.schema([("kind", pa.int8()), ("a", pa.int64()), ("b", pa.int64()), ("id", pa.int64())])


@dataclass(frozen=True)
class Band:
    """Pairs whose smaller set has low <= n < high; classes = 0 announces single shingles."""

    number: int
    low: int
    high: int
    classes: int

    def prefix(self, n: np.ndarray, t: Fraction) -> np.ndarray:
        """Length of the prefix that sets of size n announce in this band, 0 for those that take no part."""
        smaller = np.maximum(self.low, -((-n * t.numerator) // t.denominator))
        part, whole = t.numerator, t.numerator + t.denominator
        shared = -((-(n + smaller) * part) // whole)
        length = n - shared + self.classes + 1
        return np.where((n >= self.low) & (smaller < self.high), np.minimum(length, n), 0)


def bands(t: Fraction, smallest: int, largest: int) -> list[Band]:
    out = []
    low = 1 if smallest < LEAST_PAIRED else LEAST_PAIRED
    while low <= largest:
        paired = low >= LEAST_PAIRED
        high = low * BAND_FACTOR if paired else LEAST_PAIRED
        classes = ceil(Fraction(2 * low) * t / (1 + t)) - 1 if paired else 0
        out.append(Band(len(out), low, high, classes))
        low = high
    return out


# -- sets of shingles ---------------------------------------------------------


def _sets(k: int, least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            text, words = word_hashes(data, offsets)
            long = np.bincount(text, minlength=len(b)) >= max(least_words, k)
            kept = long[text]
            text, full = shingle_hashes(text[kept], words[kept], k)
            if not len(text):
                continue
            # 32 bits of the hash stand for the shingle within a set
            keys = np.unique((text.astype(np.uint64) << np.uint64(32)) | (full >> np.uint64(32)))
            text, short = (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)
            first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            bounds = np.append(first, len(text)).astype(np.int64)
            n = np.diff(bounds)
            whole = mix(np.add.reduceat(mix(short.astype(np.uint64) + np.uint64(1)), first) + n.astype(np.uint64))
            blobs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(short)])
            ids = b.column(0).take(pa.array(text[first]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(whole.view(np.int64)), pa.array(n.astype(np.int32)), blobs], schema=SETS)

    return run


def shingle_sets(df: DataFrame, id_col: str, text_col: str, k: int, least_words: int) -> DataFrame:
    """id, set_hash, n and the sorted distinct shingles of every row with at least `least_words` words."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.lower(F.col(text_col)).alias("text")).filter("id is not null and text is not null")
    return rows.mapInArrow(_sets(k, least_words), "id bigint, set_hash bigint, n int, shingles binary")


def _blob_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint32) if at[-1] > at[0] else np.empty(0, np.uint32), (at - at[0]) // 4


# -- order of shingles ---------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(1 << SKETCH_BITS, np.int64)
    for b in batches:
        values, _ = _blob_values(b.column(0))
        cells += np.bincount(values >> np.uint32(32 - SKETCH_BITS), minlength=len(cells))
    blocks = cells.astype(np.uint32).reshape(SKETCH_BLOCKS, -1)
    yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_BLOCKS), pa.int32()), pa.array([x.tobytes() for x in blocks], pa.binary())], names=["block", "cells"])


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for block, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            sums[block] = sums.get(block, 0) + np.frombuffer(cells, np.uint32).astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "cells"])


def shingle_ranks(sets: DataFrame) -> np.ndarray:
    """A rank from 0 to 255 for each cell of the sketch, by count; its size is fixed."""
    partial = sets.select("shingles").mapInArrow(_count, "block int, cells binary")
    summed = partial.repartition(SKETCH_BLOCKS, "block").mapInArrow(_add_counts, "block int, cells binary")
    counts = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), np.int64)
    for block, cells in summed.collect():
        counts[block] = np.frombuffer(cells, np.int64)
    return np.minimum(8 * np.log2(1.0 + counts.ravel()), 255).astype(np.uint8)


# -- announcing ----------------------------------------------------------------


def _pairs_of_runs(key: np.ndarray, value: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of equal keys, the keys sorted; yields by distance."""
    at = np.flatnonzero(np.r_[key[1:] == key[:-1], False]) if len(key) else np.empty(0, np.int64)
    distance = 1
    while len(at):
        yield value[at], value[at + distance]
        distance += 1
        at = at[at + distance < len(key)]
        at = at[key[at + distance] == key[at]]


def _announce_chunk(ids: np.ndarray, set_hash: np.ndarray, n: np.ndarray, shingles: np.ndarray, plan: list[Band], t: Fraction, ranks: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    # copies within the chunk are announced once
    _, one, place = np.unique(set_hash, return_index=True, return_inverse=True)
    member_ids, member_sets = ids, set_hash
    row = np.repeat(np.arange(len(n)), n)
    kept = np.zeros(len(n), bool)
    kept[one] = True
    number = np.full(len(n), -1)
    number[one] = np.arange(len(one))
    use = kept[row]
    row, shingles = number[row[use]], shingles[use]
    n = n[one]
    order = np.sort((row.astype(np.uint64) << np.uint64(40)) | (ranks[shingles >> np.uint32(32 - SKETCH_BITS)].astype(np.uint64) << np.uint64(32)) | shingles)
    row, shingles = (order >> np.uint64(40)).astype(np.int64), order.astype(np.uint32)
    bounds = np.append(0, np.cumsum(n))
    position = np.arange(len(row)) - bounds[row]
    lengths = [band.prefix(n, t) for band in plan]
    longest = np.maximum.reduce(lengths)
    running = np.append(np.uint64(0), np.cumsum(mix(shingles.astype(np.uint64) + np.uint64(7))))
    group = mix(running[bounds[:-1] + longest] - running[bounds[:-1]] + mix(n.astype(np.uint64)))
    group = ((group >> np.uint64(24)) << np.uint64(8)) | np.minimum(np.log(n) / np.log(SIZE_STEP), 255).astype(np.uint64)
    found = []
    for band, length in zip(plan, lengths, strict=True):
        use = position < length[row]
        if not use.any():
            continue
        r, s = row[use].astype(np.uint64), shingles[use]
        seed = np.uint64(0x632BE59BD9B4E019 * (band.number + 1) % 2**64)
        if band.classes == 0:
            found.append((mix(s.astype(np.uint64) + seed), r))
            continue
        class_of = mix(s.astype(np.uint64)) % np.uint64(band.classes)
        keys = np.sort(((r * np.uint64(band.classes) + class_of) << np.uint64(32)) | s)
        key, value = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        at = np.arange(len(keys))
        for i, j in _pairs_of_runs(key, at):
            found.append((mix(value[i] * np.uint64(0x9E3779B97F4A7C15) + mix(value[j] + seed)), key[i] // np.uint64(band.classes)))
    signature = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.uint64)
    owner = np.concatenate([x for _, x in found]) if found else np.empty(0, np.uint64)
    bucket = (signature >> np.uint64(32)) % np.uint64(buckets)
    entries = np.sort((bucket << np.uint64(48)) | ((signature & np.uint64(0xFFFFFFFF)) << np.uint64(16)) | owner)
    cuts = np.searchsorted(entries >> np.uint64(48), np.arange(buckets + 1, dtype=np.uint64))
    home = mix(group[place]) % np.uint64(buckets)
    by_home = np.argsort(home, kind="stable")
    home_cuts = np.searchsorted(home[by_home], np.arange(buckets + 1, dtype=np.uint64))
    for x in range(buckets):
        part = entries[cuts[x] : cuts[x + 1]]
        members = by_home[home_cuts[x] : home_cuts[x + 1]]
        if len(part) or len(members):
            yield x, _encode(part, group, group[place[members]], member_sets[members], member_ids[members])


def _six(names: np.ndarray) -> np.ndarray:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _encode(entries: np.ndarray, group: np.ndarray, member_group: np.ndarray, member_set: np.ndarray, member_id: np.ndarray) -> bytes:
    """Signatures, each with the name of its group: as many bytes an announcement for any number of buckets."""
    sig = ((entries >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype(">u4")
    planes = np.ascontiguousarray(sig.view(np.uint8).reshape(-1, 4).T)  # sorted: the upper bytes compress away
    names = group[(entries & np.uint64(0xFFFF)).astype(np.int64)].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    head = np.array([len(entries), len(member_id)], np.int64)
    return b"".join(x.tobytes() for x in (head, planes, names, member_group.view(np.int64), member_set, member_id))


def _decode(blob: bytes) -> tuple[np.ndarray, ...]:
    """signature and group of each announcement; group, set and id of each member."""
    entries, members = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    at, out = 16, []
    for count, kind in ((entries * 4, np.uint8), (entries * 6, np.uint8), (members, np.int64), (members, np.int64), (members, np.int64)):
        out.append(np.frombuffer(blob, kind, count, at))
        at += out[-1].nbytes
    wide = np.zeros((entries, 8), np.uint8)
    wide[:, :6] = out[1].reshape(-1, 6)
    sig = np.ascontiguousarray(out[0].reshape(4, -1).T).view(">u4").ravel().astype(np.uint64)
    return sig, wide.view("<u8").ravel().astype(np.uint64), *out[2:]


def _announce(plan: list[Band], t: Fraction, ranks_of, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of.value
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            values = [_blob_values(b.column(3))[0] for b in held]
            ids, sets, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3))
            for bucket, blob in _announce_chunk(ids, sets, n.astype(np.int64), np.concatenate(values), plan, t, ranks, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([blob], pa.binary())], names=["bucket", "entries"])

        texts = shingles = 0
        for b in batches:
            for i in range(0, len(b), 5_000):
                piece = b.slice(i, 5_000)
                size = int(piece.column(2).to_numpy().sum())
                if held and (texts + len(piece) > CHUNK_TEXTS or shingles + size > CHUNK_SHINGLES):
                    yield from flush()
                    held, texts, shingles = [], 0, 0
                held.append(piece)
                texts, shingles = texts + len(piece), shingles + size
        if held:
            yield from flush()

    return run


def _code_reach(t: Fraction) -> int:
    """How far the size codes of alike sets can lie apart."""
    return int(np.log(float(1 / t)) / np.log(SIZE_STEP)) + 1


def _meet(t: Fraction, hot: int):
    """Within a bucket: groups that were announced under one signature (0), the members of groups (1), and the groups under a signature that more than `hot` have (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        bucket = 0
        for b in batches:
            bucket = b.column(0)[0].as_py() if len(b) else bucket
            for blob in b.column(1):
                sig, group, *members = _decode(blob.as_buffer().to_pybytes())
                if len(members[0]):
                    yield _rows(1, members[0], members[1], members[2])
                parts.append((sig, group))
        if not parts:
            return
        sig, group = (np.concatenate([p[i] for p in parts]) for i in range(2))
        parts.clear()
        group, number = np.unique(group, return_inverse=True)
        size_code = (group & np.uint64(0xFF)).astype(np.int64)
        keys = np.unique((sig << np.uint64(32)) | number.astype(np.uint64))
        sig, number = keys >> np.uint64(32), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.empty(0, np.int64)
        size = np.diff(np.append(first, len(sig)))
        if (size > hot).any():
            many = np.repeat(size > hot, size)
            yield _rows(2, (sig[many] | np.uint64(bucket << 32)).view(np.int64), group[number[many]].view(np.int64), size_code[number[many]])
            sig, number = sig[~many], number[~many]
        held, count = [], 0
        for a, b in _pairs_of_runs(sig, number):
            close = np.abs(size_code[a] - size_code[b]) <= _code_reach(t)
            held.append((a[close].astype(np.uint64) << np.uint64(32)) | b[close].astype(np.uint64))
            count += len(held[-1])
            if count > 8_000_000:
                held = [np.unique(np.concatenate(held))]
                count = len(held[0])
        if held:
            pairs = np.unique(np.concatenate(held))
            a, b = group[(pairs >> np.uint64(32)).astype(np.int64)], group[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)]
            for i in range(0, len(pairs), 500_000):
                x, y = a[i : i + 500_000].view(np.int64), b[i : i + 500_000].view(np.int64)
                yield _rows(0, np.minimum(x, y), np.maximum(x, y), np.zeros(len(x), np.int64))

    return run


def _rows(kind: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b), pa.array(ids)], schema=MEETINGS)


# -- verifying -----------------------------------------------------------------


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << FILTER_BITS, bool)
    for b in batches:
        bits[(mix(b.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])


def _marked(bits_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bits_of.value, np.uint8)
        for b in batches:
            at = (mix(b.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            kept = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            if kept.any():
                yield b.filter(pa.array(kept.astype(bool)))

    return run


def _overlaps(t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = []
            sizes = []
            for c in (2, 3):
                values, bounds = _blob_values(b.column(c))
                sizes.append(np.diff(bounds))
                keys.append((np.repeat(np.arange(len(b)), sizes[-1]).astype(np.uint64) << np.uint64(32)) | values)
            both = np.sort(np.concatenate(keys))
            twice = both[1:][both[1:] == both[:-1]]
            shared = np.bincount((twice >> np.uint64(32)).astype(np.int64), minlength=len(b))
            union = sizes[0] + sizes[1] - shared
            kept = shared * t.denominator >= union * t.numerator
            out = [b.column(0).filter(pa.array(kept)), b.column(1).filter(pa.array(kept)), pa.array(shared[kept].astype(np.int32)), pa.array(union[kept].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, names=["a", "b", "shared", "distinct"])

    return run


def _hot_pairs(met: DataFrame, t: Fraction, hot: int) -> DataFrame:
    """Groups a < b of fitting sizes under a signature with very many: a join by signature and block, each of at most about `hot` groups."""
    rows = met.filter("kind = 2").select(F.col("a").alias("sig"), F.col("b").alias("grp"), F.col("id").alias("code"))
    blocks = rows.groupBy("sig").agg(F.ceil(F.count("*") / hot).cast("bigint").alias("blocks"))
    rows = rows.join(blocks, "sig").withColumn("block", F.pmod(F.xxhash64("grp"), F.col("blocks")))
    left = rows.select("sig", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), F.col("grp").alias("a"), F.col("code").alias("code_a"))
    right = rows.select("sig", "block", F.col("grp").alias("b"), F.col("code").alias("code_b"))
    close = F.abs(F.col("code_a") - F.col("code_b")) <= _code_reach(t)
    return left.join(right, ["sig", "block"]).filter((F.col("a") < F.col("b")) & close).select("a", "b")


@dataclass(frozen=True)
class Similar:
    """`links`: pairs of distinct sets a < b (by set_hash) with shared and distinct shingles; `members`: set_hash, id of every text, without repeats."""

    links: DataFrame
    members: DataFrame


def similar_sets(df: DataFrame, id_col: str, text_col: str, similarity: float = 0.8, k: int = 5, least_words: int = 0, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> Similar:
    """All pairs of distinct shingle sets with a Jaccard similarity of at least `similarity`.

    Defined cases: rows with a null id or text, and texts of fewer than
    max(k, least_words) words, take no part. A row that repeats counts once; if
    rows of one id have different texts, each text stands for that id. Empty
    tables give empty results. Columns other than the two named are ignored.
    """
    spark = df.sparkSession
    t = Fraction(str(similarity))
    sets = materialize(shingle_sets(df, id_col, text_col, k, least_words), "shingle-sets", "none")
    smallest, largest = sets.agg(F.min("n"), F.max("n")).first()
    plan = bands(t, smallest or 1, largest or 0)
    buckets = parts_for(sets, bucket_bytes)
    if plan:
        ranks = spark.sparkContext.broadcast(shingle_ranks(sets))
        announced = sets.mapInArrow(_announce(plan, t, ranks, buckets), "bucket int, entries binary")
        met = announced.repartitionById(buckets, F.col("bucket")).mapInArrow(_meet(t, hot), "kind tinyint, a bigint, b bigint, id bigint")
    else:
        met = spark.createDataFrame([], "kind tinyint, a bigint, b bigint, id bigint")
    met = materialize(met, "meetings")
    members = met.filter("kind = 1").select(F.col("a").alias("grp"), F.col("b").alias("set_hash"), "id").distinct()
    held = members.select("grp", "set_hash").distinct()
    groups = met.filter("kind = 0").select("a", "b").unionByName(_hot_pairs(met, t, hot)).distinct()
    left, right = held.select(F.col("grp").alias("a"), F.col("set_hash").alias("x")), held.select(F.col("grp").alias("b"), F.col("set_hash").alias("y"))
    across = groups.join(left, "a").join(right, "b").select("x", "y")
    within = left.join(right, F.col("a") == F.col("b")).filter("x < y").select("x", "y")
    pairs = across.unionByName(within).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = materialize(pairs.distinct(), "candidate-pairs")
    needed = pairs.select(F.col("a").alias("s")).unionByName(pairs.select(F.col("b").alias("s")))
    # a filter of fixed size keeps sets that no candidate names out of the shuffle
    marks = needed.coalesce(max(1, min(16, partitions(spark)))).mapInArrow(_mark, "bits binary")
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in marks.toLocalIterator():
        bits |= np.frombuffer(row[0], np.uint8)
    wanted = sets.select("set_hash", "shingles").mapInArrow(_marked(spark.sparkContext.broadcast(bits.tobytes())), "set_hash bigint, shingles binary").dropDuplicates(["set_hash"])
    wanted = materialize(wanted, "wanted-sets", "none")
    filled = pairs.join(wanted.select(F.col("set_hash").alias("a"), F.col("shingles").alias("of_a")), "a").join(wanted.select(F.col("set_hash").alias("b"), F.col("shingles").alias("of_b")), "b")
    links = filled.select("a", "b", "of_a", "of_b").mapInArrow(_overlaps(t), "a bigint, b bigint, shared int, distinct int")
    return Similar(materialize(links, "links"), members.select("set_hash", "id").distinct())


def similar_pairs(found: Similar) -> DataFrame:
    """Every pair of ids a < b whose sets are alike or the same, with its similarity."""
    members = found.members
    left, right = members.select(F.col("set_hash").alias("a"), F.col("id").alias("x")), members.select(F.col("set_hash").alias("b"), F.col("id").alias("y"))
    likeness = (F.col("shared") / F.col("distinct")).alias("similarity")
    across = found.links.join(left, "a").join(right, "b").filter("x <> y").select("x", "y", likeness)
    within = left.join(right, F.col("a") == F.col("b")).filter("x < y").select("x", "y", F.lit(1.0).alias("similarity"))
    both = across.unionByName(within)
    return both.groupBy(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).agg(F.max("similarity").alias("similarity"))


def similar_groups(found: Similar) -> DataFrame:
    """id, class_id (the same for exact copies), group_id (a component of alike classes), and links: the number of other classes it is alike with."""
    parts = connected(found.links)
    ends = found.links.select(F.col("a").alias("set_hash")).unionAll(found.links.select(F.col("b").alias("set_hash")))
    degree = ends.groupBy("set_hash").agg(F.count("*").alias("links"))
    classes = found.members.groupBy("set_hash").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    classes = classes.join(degree, "set_hash", "left").join(parts.withColumnRenamed("node", "set_hash"), "set_hash", "left")
    heads = classes.groupBy(F.coalesce("component", "set_hash").alias("root")).agg(F.min("class_id").alias("group_id"))
    classes = classes.withColumn("root", F.coalesce("component", "set_hash")).join(heads, "root")
    rows = found.members.join(classes, "set_hash")
    return rows.select("id", "class_id", "group_id", F.coalesce("links", F.lit(0)).alias("links"), "copies")
