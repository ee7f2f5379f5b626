"""Directly addressable codes: an immutable array of unsigned integers with random access and no block decoding.

Every value gives its low 8 bits to level 0; a continuation bitmap marks values with more bits, which go on in level
1, and so on. A rank directory holds the number of set bits before every 512th bit, so the place of a value in the
next level is one directory entry plus the set bits of at most 64 bytes.

Layout, little-endian: magic ``DAC1``, u32 levels, u64 values; then per level u64 n, n bytes of chunks, the bitmap
((n + 7) // 8 bytes, bit i % 8 of byte i // 8), and (n // 512 + 1) u64 ranks. The last level's bitmap has no bit set.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
STEP = 512


def encode(values: np.ndarray) -> bytes:
    """``values``: unsigned integers below 2**64."""
    rest = np.ascontiguousarray(values, dtype=np.uint64 if values.dtype.itemsize > 4 else np.uint32)
    parts, levels, n = [], 0, len(rest)
    while levels == 0 or len(rest):
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        counts = np.zeros(len(rest) // STEP + 1, np.uint64)
        if len(counts) > 1:
            ones = np.bitwise_count(bitmap[: (len(counts) - 1) * STEP // 8]).reshape(-1, STEP // 8).sum(axis=1, dtype=np.uint64)
            counts[1:] = np.cumsum(ones)
        parts += [struct.pack("<Q", len(rest)), rest.astype(np.uint8).tobytes(), bitmap.tobytes(), counts.astype("<u8").tobytes()]
        rest = rest[more] >> 8
        levels += 1
    return MAGIC + struct.pack("<IQ", levels, n) + b"".join(parts)


class DacArray:
    """Reader over the bytes of :func:`encode`; nothing is decoded at construction."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC array")
        levels, self.n = struct.unpack_from("<IQ", data, 4)
        self.levels, at = [], 16
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            chunk = np.frombuffer(data, np.uint8, n, at)
            at += n
            bitmap = np.frombuffer(data, np.uint8, (n + 7) // 8, at)
            at += (n + 7) // 8
            ranks = np.frombuffer(data, "<u8", n // STEP + 1, at)
            at += 8 * (n // STEP + 1)
            self.levels.append((chunk, bitmap, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """One value: per level one chunk, one bit and one rank."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunk, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunk[i]) << (8 * level)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bitmap, ranks, i)
        return value

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before bit i."""
        block = i // STEP
        before = int(np.bitwise_count(bitmap[block * STEP // 8 : i >> 3]).sum())
        partial = int(bitmap[i >> 3]) & ((1 << (i & 7)) - 1) if i & 7 else 0
        return int(ranks[block]) + before + partial.bit_count()

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Values start to stop (uint32, or uint64 where the array has more than four levels): each level is entered
        at the rank of the slice's first value."""
        start, stop = max(0, start), min(self.n, stop)
        kind = np.uint32 if len(self.levels) <= 4 else np.uint64
        out, where = np.zeros(max(0, stop - start), kind), None
        for level, (chunk, bitmap, ranks) in enumerate(self.levels):
            if stop <= start:
                break
            part = chunk[start:stop].astype(kind) << kind(8 * level)
            if where is None:
                out = part
            else:
                out[where] |= part
            low = start & ~7
            bits = np.unpackbits(bitmap[low >> 3 : (stop + 7) >> 3], bitorder="little")[start - low : stop - low].view(bool)
            where = np.flatnonzero(bits) if where is None else where[bits]
            start = self._rank(bitmap, ranks, start)
            stop = start + len(where)
        return out
