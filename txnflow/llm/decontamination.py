"""Benchmark decontamination by SimHash over item-sized windows.

Every benchmark item has a SimHash fingerprint of its word shingles, and so has each window of
a document that is as long as the item. A fingerprint of 128 bits within 31 bits of an item's is
within 7 in one of its four blocks of 32, and so within 3 in one half of that block. Items
are posted under every value within 3 bits of each of their eight halves, as sorted keys. A
window looks up its own halves; what it finds is checked on the block of 32 bits, and only what
is left, about one pair in 200 by chance, on all bits. So the index finds all fingerprints
within the radius. The exact similarity of the shingles, weighted by how often each occurs,
then decides.

Windows that cannot reach the similarity, because too few of their shingles occur in any item
of the benchmark at all, are passed over before their fingerprint is made; this loses nothing.

Defined cases: a null or empty text has no windows, an item without words matches nothing. An
item with fewer words than a shingle is one shingle, its whole sequence, and matches where
that stands in a document. A document shorter than a longer item is one window. Letters
A-Z are lower-cased. Repeated rows and repeated items are matched each. An empty benchmark
gives no rows. Texts are read whole; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.text import Words, document_runs, mix, runs_inside, text_buffers, window_hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HALVES, _HALF_BITS, _BLOCK_BITS = 3, 16, 7
_FILTER_BITS = 22
#: Windows fingerprinted at once, candidates checked at once.
_SLICE, _CANDIDATES = 4096, 1 << 18
_MATCH = "doc_id long, item_id long, similarity double, distance int, first_word long, n_words long"


@dataclass(frozen=True)
class DecontaminationParams:
    """``pass_bytes`` bounds the index of one pass; a larger benchmark takes several passes.

    ``max_bits`` is the largest distance of two 128-bit fingerprints, 31 at most: up to that the
    index misses none.
    """

    shingle: int = 5
    similarity: float = 0.8
    max_bits: int = 31
    pass_bytes: int = 48 << 20


def _bits(shingles: np.ndarray) -> np.ndarray:
    """128 bits of each shingle as +1 and -1."""
    two = np.stack((mix(shingles), mix(shingles ^ np.uint64(0x5851F42D4C957F2D))), axis=1)
    return np.unpackbits(two.view(np.uint8), axis=1).astype(np.int32) * 2 - 1


def _fingerprints(shingles: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Sixteen bytes for each run of ``width`` shingles."""
    low, high = int(starts[0]), int(starts[-1]) + width
    sums = np.concatenate((np.zeros((1, 128), np.int32), np.cumsum(_bits(shingles[low:high]), axis=0)))
    return np.packbits(sums[starts - low + width] - sums[starts - low] > 0, axis=1)


def _near_values(bits: int, flips: int) -> np.ndarray:
    """What to flip to reach every value within some bits of a value."""
    return np.array([sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(range(bits), k)], np.uint16)


_FLIPS = _near_values(_HALF_BITS, _HALVES)
#: A posting is a key and a number, for each flip of each half.
_ITEM_BYTES = 8 * len(_FLIPS) * 6


class Postings:
    """The fingerprints of one width, posted under all values near each of their eight halves."""

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        numbers = np.repeat(np.arange(len(prints), dtype=np.int32), len(_FLIPS))
        self.halves = []
        for half in prints.view(np.uint16).T:
            keys = (half[:, None] ^ _FLIPS).ravel()
            order = np.argsort(keys, kind="stable")
            self.halves.append((keys[order], numbers[order]))

    def candidates(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (window, item) of which one block of 32 bits is near, in window order."""
        blocks, own = windows.view(np.uint32), self.prints.view(np.uint32)
        found = [np.zeros(0, np.int64)]
        for h, (keys, numbers) in enumerate(self.halves):
            value = windows.view(np.uint16)[:, h]
            begin, end = np.searchsorted(keys, value, "left"), np.searchsorted(keys, value, "right")
            ends = np.cumsum(end - begin)
            at = 0
            while at < len(windows):
                # As many windows as keep the list short, one at least.
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _CANDIDATES, "right")))
                count = (end - begin)[at:to]
                w = np.repeat(np.arange(at, to), count)
                place = np.arange(len(w)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[at:to], count)
                i = numbers[place]
                near = np.bitwise_count(blocks[w, h // 2] ^ own[i, h // 2]) <= _BLOCK_BITS
                found.append(w[near] * len(own) + i[near])
                at = to
        return np.divmod(np.unique(np.concatenate(found)), len(own))


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two multisets of shingles."""
    values, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    left = np.bincount(where[: len(a)], minlength=len(values))
    right = np.bincount(where[len(a) :], minlength=len(values))
    return float(np.minimum(left, right).sum() / np.maximum(left, right).sum())


class ItemIndex:
    """The items of one pass, by their number of shingles; those shorter than a shingle by their words."""

    def __init__(self, items: list[tuple[int, str]], params: DecontaminationParams) -> None:
        self.params = params
        by_width: dict[int, list[tuple[int, np.ndarray]]] = {}
        short: dict[int, list[tuple[int, int]]] = {}
        for item_id, text in items:
            data = _LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            hashes = Words(data, np.array([0, len(data)])).hashes()
            shingles = window_hashes(hashes, params.shingle)
            if len(shingles):
                by_width.setdefault(len(shingles), []).append((item_id, shingles))
            elif len(hashes):
                short.setdefault(len(hashes), []).append((int(window_hashes(hashes, len(hashes))[0]), item_id))
        self.groups = []
        for width, group in sorted(by_width.items()):
            prints = np.concatenate([_fingerprints(s, np.zeros(1, np.int64), width) for _, s in group])
            self.groups.append((width, ceil(params.similarity * width - 1e-9), group, Postings(prints)))
        #: Sorted hashes of the whole short items and their ids, by number of words.
        self.short = {
            size: (np.array([h for h, _ in sorted(found)], np.uint64), [i for _, i in sorted(found)])
            for size, found in short.items()
        }
        listed = [s for _, group in by_width.items() for _, s in group]
        self.known = np.unique(np.concatenate(listed)) if listed else np.zeros(0, np.uint64)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.known >> np.uint64(64 - _FILTER_BITS)] = True
        self.least = min((need for _, need, *_ in self.groups), default=0)
        #: Pairs whose whole fingerprints were compared.
        self.compared = 0

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in some item."""
        found = self.maybe[shingles >> np.uint64(64 - _FILTER_BITS)]
        here = np.flatnonzero(found)
        at = np.minimum(np.searchsorted(self.known, shingles[here]), len(self.known) - 1)
        found[here] = self.known[at] == shingles[here]
        return found

    def matches(self, shingles: np.ndarray, hit: np.ndarray) -> list[tuple[int, float, int, int, int]]:
        """(item, similarity, distance, first word, words) of the best window of each item found."""
        seen = np.concatenate(([0], np.cumsum(hit)))
        found = []
        for width, need, group, postings in self.groups:
            size = min(width, len(shingles))
            if seen[-1] < need or size < need:
                continue
            enough = np.flatnonzero(seen[size:] - seen[: len(seen) - size] >= need)
            best: dict[int, tuple] = {}
            # Windows are taken by where they begin, so a slice spans few words.
            for starts in np.split(enough, np.flatnonzero(np.diff(enough // _SLICE)) + 1) if len(enough) else ():
                windows = _fingerprints(shingles, starts, size)
                w, i = postings.candidates(windows)
                self.compared += len(w)
                away = np.bitwise_count(windows[w] ^ postings.prints[i]).sum(axis=1)
                near = np.flatnonzero(away <= self.params.max_bits)
                for k in near.tolist():
                    start, item = int(starts[w[k]]), int(i[k])
                    if item in best and best[item][1] == 1.0:
                        continue
                    likeness = weighted_similarity(shingles[start : start + size], group[item][1])
                    if likeness >= self.params.similarity - 1e-12 and (item not in best or likeness > best[item][1]):
                        words = size + self.params.shingle - 1
                        best[item] = (group[item][0], likeness, int(away[k]), start, words)
            found.extend(best.values())
        return found

    def short_matches(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(document, item, 1.0, 0, first word, words) of each short item's first place in each document."""
        for size, (wanted, ids) in self.short.items():
            own = window_hashes(hashes, size)
            at = np.flatnonzero(np.isin(own, wanted) & runs_inside(first, size))
            doc = np.searchsorted(first, at, "right") - 1
            seen = set()
            for d, place in zip(doc.tolist(), at.tolist(), strict=True):
                low, high = (int(np.searchsorted(wanted, own[place], side)) for side in ("left", "right"))
                for number in range(low, high):
                    if (d, number) not in seen:
                        seen.add((d, number))
                        yield d, ids[number], 1.0, 0, place - int(first[d]), size


def _scan(index: ItemIndex):
    size = index.params.shingle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            data, bounds = text_buffers(batch.column("text"))
            rows = []
            for first, last in document_runs(bounds):
                part = bounds[first : last + 1]
                words = Words(_LOWER[data[part[0] : part[-1]]], part - part[0])
                hashes = words.hashes()
                rows.extend((ids[first + d], *m) for d, *m in index.short_matches(hashes, words.first))
                if not index.groups:
                    continue
                shingles = window_hashes(hashes, size)
                hit = index.hits(shingles) & runs_inside(words.first, size)
                seen = np.concatenate(([0], np.cumsum(hit)))
                begins = words.first[:-1]
                ends = np.maximum(words.first[1:] - size + 1, begins)
                begins, ends = np.minimum(begins, len(shingles)), np.minimum(ends, len(shingles))
                for d in np.flatnonzero(seen[ends] - seen[begins] >= max(index.least, 1)).tolist():
                    a, b = int(begins[d]), int(ends[d])
                    rows.extend((ids[first + d], *m) for m in index.matches(shingles[a:b], hit[a:b]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "item_id", "similarity", "distance", "first_word", "n_words"],
            )

    return run


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams()
) -> DataFrame:
    """Each document (row) and benchmark item it holds, with the most similar window.

    The benchmark is the stated query set: it is read in parts whose index takes about
    ``pass_bytes``, by the measured sizes of the items, and each part scans all documents once,
    without a shuffle.
    """
    spark = docs.sparkSession
    benchmark = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = F.coalesce(F.sum(F.octet_length("text") * 8 + _ITEM_BYTES), F.lit(0))
    passes = max(1, ceil(benchmark.agg(size).first()[0] / params.pass_bytes))
    docs = docs.select("doc_id", "text")
    found = []
    for number in range(passes):
        chosen = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        items = [(row["item_id"], row["text"]) for row in chosen.orderBy("item_id", "text").collect()]
        index = ItemIndex(items, params)
        if index.groups or index.short:
            found.append(docs.mapInArrow(_scan(index), _MATCH))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _MATCH)
