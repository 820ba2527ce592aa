"""Compressed bitmaps of integer codes, in containers of 65,536 codes.

A container is kept in the smaller of two forms: a sorted array of 16-bit codes,
or a bitset of 8,192 bytes. The form is chosen by the number of codes in it.
"""

from __future__ import annotations

import numpy as np

CONTAINER = 1 << 16
ARRAY_MAX = CONTAINER // 16


class Bitmap:
    """An immutable set of non-negative integers below 2**48."""

    __slots__ = ("containers",)

    def __init__(self, containers: dict[int, np.ndarray]):
        self.containers = containers

    @classmethod
    def of(cls, codes: np.ndarray) -> Bitmap:
        codes = np.unique(np.asarray(codes, dtype=np.int64))
        high = codes >> 16
        cuts = np.flatnonzero(np.diff(high)) + 1
        parts = np.split(codes, cuts) if len(codes) else []
        return cls({int(x[0] >> 16): _pack((x & 0xFFFF).astype(np.uint16)) for x in parts})

    def codes(self) -> np.ndarray:
        parts = [(_unpack(c).astype(np.int64)) + (h << 16) for h, c in sorted(self.containers.items())]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def _merge(self, other: Bitmap, mode: str) -> Bitmap:
        out: dict[int, np.ndarray] = {}
        keys = self.containers.keys() if mode != "or" else self.containers.keys() | other.containers.keys()
        for h in keys:
            a, b = self.containers.get(h), other.containers.get(h)
            if a is None or b is None:
                kept = {"or": b if a is None else a, "andnot": a, "and": None}[mode]
                if kept is not None:
                    out[h] = kept
                continue
            x, y = _bits(a), _bits(b)
            z = x | y if mode == "or" else x & y if mode == "and" else x & ~y
            if z.any():
                out[h] = _shrink(z)
        return Bitmap(out)

    def __or__(self, other: Bitmap) -> Bitmap:
        return self._merge(other, "or")

    def __and__(self, other: Bitmap) -> Bitmap:
        return self._merge(other, "and")

    def andnot(self, other: Bitmap) -> Bitmap:
        """The codes of this bitmap that the other lacks."""
        return self._merge(other, "andnot")

    def __len__(self) -> int:
        return sum(len(_unpack(c)) for c in self.containers.values())


def _pack(low: np.ndarray) -> np.ndarray:
    return low if len(low) <= ARRAY_MAX else _bits(low)


def _bits(container: np.ndarray) -> np.ndarray:
    if container.dtype == np.uint8:
        return container
    flags = np.zeros(CONTAINER, np.uint8)
    flags[container] = 1
    return np.packbits(flags)


def _unpack(container: np.ndarray) -> np.ndarray:
    return container if container.dtype == np.uint16 else np.flatnonzero(np.unpackbits(container)).astype(np.uint16)


def _shrink(bits: np.ndarray) -> np.ndarray:
    low = _unpack(bits)
    return low if len(low) <= ARRAY_MAX else bits
