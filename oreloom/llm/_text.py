"""Vectorised word hashing over Arrow string columns.

Texts are handled as UTF-8 bytes, a few megabytes at a time and cut only between documents, so the memory a worker
needs is bounded by ``PART_BYTES`` (or by the longest single text), not by the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PART_BYTES = 1 << 18
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(inside: bytes) -> np.ndarray:
    """A 256-entry table that is True for the (lower-cased) bytes that belong to words."""
    table = np.zeros(256, dtype=bool)
    table[list(inside)] = True
    return table


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z: digits, a-z and every byte of a non-ASCII character.
ALNUM = byte_class(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
#: ``[^\x20\x09-\x0D]+``
NONSPACE = byte_class(bytes(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse**i modulo 2**64 for i < n, kept per worker."""
    have = _POW.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            with np.errstate(over="ignore"):
                p = np.full(size, b, dtype=np.uint64)
                p[0] = 1
                out.append(np.multiply.accumulate(p))
        have = _POW[base] = (out[0], out[1])
    return have


def forget() -> None:
    """Drop the powers that a long text has asked for."""
    _POW.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of some whole texts: byte spans, 64-bit hashes, and the range of words of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        low = LOWER[data]
        inside = table[low]
        n = len(low)
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        cut = offsets[:-1][offsets[:-1] < n]
        start[cut] = inside[cut]
        end = np.zeros(n + 1, dtype=bool)
        end[1:] = inside
        end[1:n] &= ~inside[1:] | start[1:]
        self.data, self.offsets = low, offsets
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end)
        self.first = np.searchsorted(self.start, offsets)  # the words of text i: first[i] .. first[i + 1]
        power, inverse = powers(_P, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        h = (total[self.end] - total[self.start]) * inverse[self.start]
        self.hash = mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(_Q))
        self._sum = None

    def grams(self, at: np.ndarray, k: int) -> np.ndarray:
        """64-bit hashes of the k words that begin at the word positions ``at``."""
        power, inverse = powers(_Q, len(self.hash) + 1)
        if self._sum is None:
            self._sum = np.zeros(len(self.hash) + 1, dtype=np.uint64)
            np.cumsum(self.hash * power[: len(self.hash)], out=self._sum[1:])
        return mix((self._sum[at + k] - self._sum[at]) * inverse[at] + np.uint64(k))

    def starts(self, k: int) -> np.ndarray:
        """Positions at which k words of one text begin."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, dtype=np.int64)
        last = np.repeat(self.first[1:], np.diff(self.first))  # the end of each word's text
        at = np.arange(n - k + 1)
        return at[at + k <= last[: n - k + 1]]

    def text_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, side="right") - 1

    def words(self, i: int) -> list[bytes]:
        """The lower-cased words of text i."""
        raw = self.data.tobytes() if not hasattr(self, "_raw") else self._raw
        self._raw = raw
        return [raw[a:b] for a, b in zip(self.start[self.first[i] : self.first[i + 1]].tolist(), self.end[self.first[i] : self.first[i + 1]].tolist(), strict=True)]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column (null: empty) and its len + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = column.type
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(kind) or pa.types.is_large_string(kind) else b"")
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def parts(column: pa.Array, size: int = PART_BYTES):
    """(first row, bytes, offsets) of runs of whole texts of about ``size`` bytes."""
    data, at = bytes_of(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, side="right")) - 1)
        yield lo, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi
