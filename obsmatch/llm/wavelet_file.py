"""A shard of token ids as one succinct file: a wavelet matrix with rank directories.

Layout, little-endian: 8 bytes magic, then int64 n (ids), levels, documents; the documents' end offsets (int64 each);
for each level, highest bit first: the number of zero bits (int64), the bit-plane in bytes (bit k of the plane is bit
k % 8 of byte k // 8), padded to whole words of 64 bits, and the running count of ones before every word (uint32).
"""

from __future__ import annotations

import numpy as np

MAGIC = b"WMTOKEN1"
WORD = 64


def _pad(bits: int) -> int:
    return -(-bits // WORD) * WORD


def encode(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The file of the ids of consecutive documents, the k-th ending before place ``ends[k]``."""
    ids = np.ascontiguousarray(ids)
    n = len(ids)
    levels = max(1, int(ids.max()).bit_length()) if n else 1
    current = ids.astype(np.uint16) if levels <= 16 else ids.astype(np.uint32)
    parts = [MAGIC, np.array([n, levels, len(ends)], "<i8").tobytes(), np.asarray(ends, "<i8").tobytes()]
    for level in range(levels - 1, -1, -1):
        bit = (current & current.dtype.type(1 << level)) != 0
        plane = np.zeros(_pad(n) // 8, np.uint8)
        packed = np.packbits(bit, bitorder="little")
        plane[: len(packed)] = packed
        ones = np.bitwise_count(plane.view("<u8")).astype(np.uint32)
        before = np.zeros(len(ones), "<u4")
        np.cumsum(ones[:-1], out=before[1:])
        total = int(ones.sum())
        parts += [np.array([n - total], "<i8").tobytes(), plane.tobytes(), before.tobytes()]
        if level:
            current = np.concatenate([current[~bit], current[bit]])
    return b"".join(parts)


class WaveletFile:
    """Reads a file made by ``encode`` without expanding it; ``decode`` gives all ids at once."""

    def __init__(self, blob: bytes):
        if blob[:8] != MAGIC:
            raise ValueError("not a token file")
        self.n, self.levels, documents = (int(v) for v in np.frombuffer(blob, "<i8", 3, 8))
        self.ends = np.frombuffer(blob, "<i8", documents, 32)
        at = 32 + 8 * documents
        self.zeros, self.planes, self.before = [], [], []
        words = _pad(self.n) // WORD
        for _ in range(self.levels):
            self.zeros.append(int(np.frombuffer(blob, "<i8", 1, at)[0]))
            self.planes.append(np.frombuffer(blob, "<u8", words, at + 8))
            self.before.append(np.frombuffer(blob, "<u4", words, at + 8 + 8 * words))
            at += 8 + 12 * words

    def _ones(self, level: int, place: np.ndarray) -> np.ndarray:
        """Ones among the first ``place`` bits of a level."""
        word, bit = place // WORD, (place % WORD).astype(np.uint64)
        inside = word < len(self.planes[level])
        w = np.where(inside, word, 0)
        total = self.n - self.zeros[level]
        if not len(self.planes[level]):
            return np.zeros(len(place), np.int64)
        part = np.bitwise_count(self.planes[level][w] & ((np.uint64(1) << bit) - np.uint64(1)))
        return np.where(inside, self.before[level][w].astype(np.int64) + part, total)

    def _bit(self, level: int, place: np.ndarray) -> np.ndarray:
        return ((self.planes[level][place // WORD] >> (place % WORD).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def access(self, places) -> np.ndarray:
        """The ids at ``places``."""
        place = np.asarray(places, np.int64)
        out = np.zeros(len(place), np.int64)
        for level in range(self.levels):
            bit = self._bit(level, place)
            ones = self._ones(level, place)
            out = out << 1 | bit
            place = np.where(bit, self.zeros[level] + ones, place - ones)
        return out

    def _range(self, token: int, end: int) -> tuple[int, int]:
        ends = np.array([0, end], np.int64)
        for level in range(self.levels):
            ones = self._ones(level, ends)
            bit = token >> (self.levels - 1 - level) & 1
            ends = self.zeros[level] + ones if bit else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of ``token`` among the first ``end`` ids."""
        if token >> self.levels:
            return 0
        a, b = self._range(token, self.n if end is None else end)
        return b - a

    def find(self, token: int) -> np.ndarray:
        """The places of ``token``, by select through the levels upward."""
        if token >> self.levels:
            return np.zeros(0, np.int64)
        a, b = self._range(token, self.n)
        place = np.arange(a, b)
        for level in range(self.levels - 1, -1, -1):
            bits = np.unpackbits(self.planes[level].view(np.uint8), bitorder="little")[: self.n]
            if token >> (self.levels - 1 - level) & 1:
                place = np.flatnonzero(bits)[place - self.zeros[level]]
            else:
                place = np.flatnonzero(bits == 0)[place]
        return place

    def decode(self) -> np.ndarray:
        """All ids: from the lowest plane up, each level's order is undone."""
        ids = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self.planes[level].view(np.uint8), bitorder="little", count=self.n).view(bool)
            up = np.empty_like(ids)
            up[~bit] = ids[: self.zeros[level]]
            up[bit] = ids[self.zeros[level] :] | ids.dtype.type(1 << (self.levels - 1 - level))
            ids = up
        return ids
