"""Keyword-stuffed and link-list pages.

Two kinds of evidence are joined. Phrases: every sequence of five words of every
page is sent to a bucket by its hash, where the distinct hosts that carry it are
counted; a page's stitched share is the share of its phrases that more than one
host carries. List density: the share of its words that stand in units without
the make-up of a sentence (`listiness`). A page is flagged if most of its words
stand in lists, or nearly most and most of its phrases are replicated elsewhere.

Phrases travel packed: a few large rows per task and bucket, five bytes a phrase
and two for its page, with the pages of that bucket only. A phrase that enough
hosts carry within one task's pages is settled there, and only its name goes on,
so that boilerplate costs one entry a task and not one a page. There are as many
buckets as the texts' size asks for; so a bucket is as large, and by its five
bytes a phrase is taken for another as seldom (one in some 100,000), for any
number of pages. Counts per page come back as numbers only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.listiness import units_of
from rostrum.llm.shingles import mix, shingle_hashes, text_buffer
from rostrum.session import parts_for

PHRASE_WORDS = 5
LEAST_HOSTS = 2
#: Words in lists that flag a page, and those that flag it if so many of its phrases are replicated.
LIST_SHARE, NEAR_SHARE, STITCHED_SHARE = 0.5, 0.42, 0.5
#: Beside prose, fewer words in lists are a heading, as a catalogue entry has, and no list.
LEAST_LIST_WORDS, LEAST_NEAR_WORDS = 12, 24
CHUNK_TEXTS, CHUNK_WORDS = 20_000, 4_000_000
#: Bytes of the pages' files whose phrases make a bucket; compressed texts give about five times as many.
BUCKET_BYTES = 2 << 20

# What a sentence has at least: of all words function words, and words that make sentences; and what a repeated-keyword unit has.
LEAST_FUNCTION, LEAST_SENTENCE, KEYWORD_SHARE, KEYWORD_FUNCTION = 0.15, 0.1, 0.9, 0.5

EVIDENCE = pa.schema([("doc_id", pa.int64()), ("words", pa.int64()), ("list_words", pa.int64()), ("phrases", pa.int64()), ("replicated", pa.int64())])


def list_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text its words and its words in lists; and text index and hash of every word."""
    units, text, word = units_of(data, offsets)
    n = len(offsets) - 1
    if not len(text):
        return np.zeros(n, np.int64), np.zeros(n, np.int64), text, word
    function, sentence = units.function / units.words, units.sentence / units.words
    content = units.words - units.function
    stuffed = (content > 0) & (units.keyword >= KEYWORD_SHARE * content) & (function < KEYWORD_FUNCTION)
    prose = (function >= LEAST_FUNCTION) & (sentence >= LEAST_SENTENCE) & ~stuffed & (units.links == 0)
    words = np.bincount(units.text, units.words, n).astype(np.int64)
    return words, np.bincount(units.text, np.where(prose, 0, units.words), n).astype(np.int64), text, word


def _carried(phrase: np.ndarray, hosts: np.ndarray, least_hosts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted phrases where each begins, and whether so many of the hosts beside it carry it. Hosts of phrases that stand but once are not looked at."""
    first = np.append(True, phrase[1:] != phrase[:-1])
    size = np.diff(np.append(np.flatnonzero(first), len(phrase)))
    many = size >= least_hosts
    at = np.flatnonzero(np.repeat(many, size))
    number = np.repeat(np.arange(int(many.sum())), size[many])
    pairs = np.unique((number.astype(np.uint64) << np.uint64(32)) | hosts[at].astype(np.uint64))
    many[many] = np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=int(many.sum())) >= least_hosts
    return first, many


def _settle(entries: np.ndarray, hosts: np.ndarray, least_hosts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries sorted by phrase: those that are open here, one of each phrase that enough hosts here carry, and how many such phrases each page has."""
    page = (entries & np.uint64(0xFFFF)).astype(np.int64)
    first, known = _carried(entries >> np.uint64(16), np.unique(hosts, return_inverse=True)[1][page], least_hosts)
    settled = np.repeat(known, np.diff(np.append(np.flatnonzero(first), len(entries))))
    return entries[~settled], entries[first & settled], np.bincount(page[settled], minlength=len(hosts))


def _planes(entries: np.ndarray) -> np.ndarray:
    """Five bytes of each entry's phrase, byte by byte: sorted as they are, the upper ones compress away."""
    return np.ascontiguousarray((entries >> np.uint64(16)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].T)


def _from_planes(planes: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(planes) // 5, 8), np.uint8)
    wide[:, 3:] = planes.reshape(5, -1).T
    return wide.view(">u8").ravel().astype(np.uint64)


def _blob(open_: np.ndarray, known: np.ndarray, ids: np.ndarray, hosts: np.ndarray, *sums: np.ndarray) -> bytes:
    """Open entries with the ids and hosts of their pages only, known phrases, and the sums of the pages that are counted in this bucket."""
    used, local = np.unique((open_ & np.uint64(0xFFFF)).astype(np.int64), return_inverse=True)
    head = np.array([len(used), len(open_), len(known), len(sums[0])], np.int64)
    return b"".join(x.tobytes() for x in (head, ids[used], hosts[used], _planes(open_), local.astype(np.uint16), _planes(known), *sums))


def _unblob(raw: bytes) -> list[np.ndarray]:
    """ids, hosts, phrases, pages, known phrases, and the five columns of sums."""
    used, entries, known, pages = (int(x) for x in np.frombuffer(raw, np.int64, 4))
    at, out = 32, []
    for kind, count in ((np.int64, used), (np.int64, used), (np.uint8, 5 * entries), (np.uint16, entries), (np.uint8, 5 * known), *[(np.int64, pages)] * 5):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    out[2], out[4] = _from_planes(out[2]), _from_planes(out[4])
    return out


def _pack(buckets: int, least_hosts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        texts = words_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids, hosts, words, listed, phrases = (np.concatenate([h[i] for h in held]) for i in range(5))
            bases = np.append(0, np.cumsum([len(h[0]) for h in held[:-1]])).astype(np.int64)
            entries = np.concatenate([h[5] + (b.astype(np.uint64) if h[5].size else np.uint64(0)) for h, b in zip(held, bases, strict=True)])
            entries.sort()
            settled = np.zeros(len(ids), np.int64)
            known = entries[:0]
            if len(entries):
                entries, known, settled = _settle(entries, hosts, least_hosts)
            edges = np.array([(x << 48) // buckets for x in range(buckets + 1)], np.uint64)
            cuts, known_cuts = (np.searchsorted(x >> np.uint64(16), edges) for x in (entries, known))
            home = abs(int(ids[0])) % buckets
            for x in range(buckets):
                part, names = entries[cuts[x] : cuts[x + 1]], known[known_cuts[x] : known_cuts[x + 1]]
                sums = [c if x == home else c[:0] for c in (ids, words, listed, phrases, settled)]
                if len(part) or len(names) or x == home:
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()), pa.array([_blob(part, names, ids, hosts, *sums)], pa.binary())], names=["bucket", "entries"])

        for b in batches:
            for i in range(0, len(b), 2_000):
                piece = b.slice(i, 2_000)
                data, offsets = text_buffer(piece.column(2))
                words, listed, text, word = list_words(data, offsets)
                text, full = shingle_hashes(text, word, PHRASE_WORDS)
                # a page's phrase counts once; the upper 48 bits of its hash, whose range is cut into buckets, and the page's place in one number
                key = np.unique((mix(full) & ~np.uint64(0xFFFF)) | text.astype(np.uint64))
                phrases = np.bincount((key & np.uint64(0xFFFF)).astype(np.int64), minlength=len(piece))
                total = int(words.sum())
                if held and (texts + len(piece) > CHUNK_TEXTS or words_held + total > CHUNK_WORDS):
                    yield from flush()
                    held, texts, words_held = [], 0, 0
                ids, hosts = piece.column(0).to_numpy(), piece.column(1).to_numpy()
                held.append((ids, hosts, words, listed, phrases, key))
                texts, words_held = texts + len(piece), words_held + total
        if held:
            yield from flush()

    return run


def _count_hosts(least_hosts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hosts, sig, page, names = [], [], [], [], []
        total = 0
        for b in batches:
            for blob in b.column(1):
                id_, host, phrase, local, known, *sums = _unblob(blob.as_buffer().to_pybytes())
                if len(sums[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in sums], schema=EVIDENCE)
                ids.append(id_)
                hosts.append(host)
                sig.append(phrase)
                page.append(local.astype(np.int64) + total)
                names.append(known)
                total += len(id_)
        if not total:
            return
        id_, host = np.concatenate(ids), np.unique(np.concatenate(hosts), return_inverse=True)[1]
        signature, pages = np.concatenate(sig), np.concatenate(page)
        order = np.argsort(signature, kind="stable")  # of sorted runs
        signature, pages = signature[order], pages[order]
        known = np.concatenate(names)
        if len(signature):
            first, many = _carried(signature, host[pages], least_hosts)
            phrase = signature[first]
            if len(known):
                at = np.minimum(np.searchsorted(phrase, known), len(phrase) - 1)
                many[at[phrase[at] == known]] = True
            pages = pages[np.repeat(many, np.diff(np.append(np.flatnonzero(first), len(signature))))]
        counts = np.bincount(pages, minlength=total)
        at = np.flatnonzero(counts)
        zero = np.zeros(len(at), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (id_[at], zero, zero, zero, counts[at])], schema=EVIDENCE)

    return run


def page_evidence(pages: DataFrame, id_col: str, text_col: str, host_col: str, least_hosts: int = LEAST_HOSTS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, words, list_words, phrases, replicated (phrases that at least `least_hosts` hosts carry), list_share, stitched_share.

    Defined cases: rows without an id take no part; pages without words have no
    evidence and shares of 0; a null host is a host of its own; repeated rows of an
    id add up, which leaves its shares as they are. Empty tables give empty
    results. Other columns are ignored.
    """
    buckets = parts_for(pages, bucket_bytes)
    rows = pages.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(host_col)).alias("host"), F.coalesce(F.lower(F.col(text_col)), F.lit("")).alias("text")).filter("doc_id is not null")
    packed = rows.mapInArrow(_pack(buckets, least_hosts), "bucket int, entries binary")
    counted = packed.repartitionById(buckets, F.col("bucket")).mapInArrow(_count_hosts(least_hosts), "doc_id bigint, words bigint, list_words bigint, phrases bigint, replicated bigint")
    sums = counted.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("words", "list_words", "phrases", "replicated")))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return sums.select("*", share("list_words", "words").alias("list_share"), share("replicated", "phrases").alias("stitched_share"))


def stuffed_pages(evidence: DataFrame) -> DataFrame:
    """The pages that are flagged: mostly lists, or nearly so and mostly replicated elsewhere. A page without any prose has no heading and is flagged at every length."""
    share, words = F.col("list_share"), F.col("list_words")
    near = (share > NEAR_SHARE) & (words >= LEAST_NEAR_WORDS) & (F.col("stitched_share") > STITCHED_SHARE)
    return evidence.filter(((share > LIST_SHARE) & ((words >= LEAST_LIST_WORDS) | (words == F.col("words")))) | near)
