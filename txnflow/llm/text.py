"""Words, lines and 64-bit hashes of Arrow text columns, computed with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of characters other than these; space and the controls 09 to 0D.
WHITE = r"\x20\x09-\x0D"
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes of text worked on at once. A single longer document is still handled in blocks of words.
CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTERS = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if size > 1 << 23:
            return known[:n]
        _powers[int(base)] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash; a bijection on 64 bits."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the rows' offsets; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def document_runs(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose texts together hold about ``limit`` bytes, at least one row each."""
    first, last = 0, len(bounds) - 1
    while first < last:
        end = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        end = min(max(end, first + 1), last)
        yield first, end
        first = end


class Words:
    """The words of consecutive documents: byte spans, and where each document's words begin."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.data, self.n_docs = data, len(bounds) - 1
        inner = ~_IS_WHITE[data]
        begins, ends = inner.copy(), inner.copy()
        begins[1:] &= ~inner[:-1]
        ends[:-1] &= ~inner[1:]
        # A word ends with its document, even when the next one begins with a word.
        edges = bounds[(bounds > 0) & (bounds < len(data))]
        begins[edges] = inner[edges]
        ends[edges - 1] = inner[edges - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def doc(self) -> np.ndarray:
        """The document's number of every word."""
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word's bytes, the same in every task."""
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):
            origin = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, origin + 2 * CHUNK_BYTES, "right")))
            part = self.data[origin : self.ends[to - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_LETTERS[part] * powers(_BASE, len(part)), out=sums[1:])
            low, high = self.starts[at:to] - origin, self.ends[at:to] - origin
            out[at:to] = mix((sums[high] - sums[low]) * powers(_BASE_INVERSE, len(part))[low])
            at = to
        return out


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive hashes; runs may cross documents."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - size + 1].copy()
    factor = np.uint64(0xD6E8FEB86659FD93)
    for k in range(1, size):
        out *= factor
        out += hashes[k : len(hashes) - size + 1 + k]
    return mix(out)


def runs_inside(first: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` consecutive words lie in a single document."""
    n = int(first[-1])
    if n < size:
        return np.zeros(0, bool)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return owner[: n - size + 1] == owner[size - 1 :]


def words_of(text: Column) -> Column:
    """The words of a text as an array, with built-in functions only; a null has none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^[{WHITE}]+|[{WHITE}]+$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, rf"[{WHITE}]+"))


def fold(key: Column, folds: int) -> Column:
    """CRC-32 of a key's text modulo ``folds``; a null key falls in no fold."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))
