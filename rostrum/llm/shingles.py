"""Words and word shingles of whole batches of texts, as arrays of hashes.

A batch's texts are one buffer of UTF-8 bytes; words, their hashes and the
hashes of word sequences come from a few passes over that buffer, without a
Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20_240_501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its values; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word (a run of a-z and 0-9) of lower-cased texts: the index of its text, and its hash."""
    inside = _IS_WORD[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    heads = offsets[:-1]
    before[heads[heads < len(data)]] = False
    if len(before):
        before[0] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    opens = (~before)[inside]
    first = np.flatnonzero(opens)
    length = np.diff(np.append(first, len(opens)))
    place = np.arange(len(opens)) - np.repeat(first, length)
    powers = np.ones(int(length.max()), np.uint64)
    powers[1:] = _PRIME
    powers = np.multiply.accumulate(powers)
    hashes = np.add.reduceat(_BYTE_CODES[data[inside]] * powers[place], first)
    return np.searchsorted(offsets, starts, side="right") - 1, mix(hashes)


def shingle_hashes(text: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sequence of k words within a text: the index of the text, and the sequence's hash."""
    if len(words) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    n = len(words) - k + 1
    whole = text[:n] == text[k - 1 :]
    h = words[:n].copy()
    for j in range(1, k):
        h = mix(h * _PRIME + words[j : n + j])
    return text[:n][whole], h[whole]
