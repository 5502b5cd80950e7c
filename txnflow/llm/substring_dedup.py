"""Removal of repeated word windows by recompression.

A document's words are compressed in rounds: first runs of an equal word become one symbol,
then, round by round, each symbol of class L followed by one of class R becomes their pair.
Names and classes are hashes of the content, so they are the same everywhere without an
exchange, and equal stretches of words compress alike except near their ends. For every symbol
the stretch of words that decided it is kept; a window that holds this stretch holds the
symbol wherever the window occurs.

Each window is represented by one of the last round's symbols whose deciding stretch lies
inside it, the one with the least key. Spark finds the symbols that occur in two documents or
more; only windows represented by those can repeat. Their own hashes are then compared over
all documents, and a window that also starts in a smaller document is removed. A window
without such a symbol, as inside a long run, represents itself, so none is missed.

Within a task, copies are settled on the spot and a hash is sent once for all of them, so a
passage however frequent sends a row per batch of documents.

Defined cases: a null or empty text has no words. Documents shorter than a window keep all.
Rows that repeat a doc_id do not remove each other's windows; each gets a row. A null doc_id
counts as larger than any other; such rows are told apart by their text. Windows are compared by 64-bit hashes. Texts are read whole;
other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.llm.text import Words, document_runs, mix, powers, runs_inside, text_buffers, window_hashes

_LAST = (1 << 63) - 1
_SUM_BASE = np.uint64(0xBF58476D1CE4E5B9)
_SUM_INVERSE = np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
#: ``doc`` is what "smaller" compares; rows without an id share it and differ by ``own``, a hash of the text.
_SEEN = "key long, doc long, own long, known boolean"
#: Bytes of text whose copies are settled within the task.
_BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class SubstringParams:
    window: int = 13
    rounds: int = 3


def compress_words(hashes: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that decide the last round's symbols, in order.

    ``first`` tells where each document's words begin. A stretch that would need words beyond
    its document reaches one word past it, so that no window holds it.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    heads = np.ones(n, bool)
    heads[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(heads)
    end = np.append(start[1:], n)
    owner = doc[start]
    length = (end - start).astype(np.uint64)
    symbols = np.where(length > 1, mix(hashes[start] + length * np.uint64(0x9E3779B97F4A7C15)), hashes[start])
    # A run ends where its neighbours differ, so both of them decide it.
    low, high = start - 1, end + 1
    for number in range(rounds):
        right = (mix(symbols + np.uint64(0xD1B54A32D192ED03 + number)) >> np.uint64(63)).astype(bool)
        joined = np.zeros(len(symbols), bool)
        joined[:-1] = ~right[:-1] & right[1:] & (owner[:-1] == owner[1:])
        second = np.zeros(len(symbols), bool)
        second[1:] = joined[:-1]
        next_high = np.append(high[1:], n + 1)
        next_high[:-1][owner[:-1] != owner[1:]] = 0
        beyond = first[owner + 1] + 1
        next_high = np.where(next_high == 0, beyond, np.minimum(next_high, beyond))
        previous_low = np.append(-1, low[:-1])
        previous_low[1:][owner[1:] != owner[:-1]] = -1
        previous_low = np.maximum(previous_low, first[owner] - 1)
        # An unjoined L is decided by its right neighbour, an unjoined R by its left one.
        new_low = np.where(right & ~second, previous_low, low)
        new_high = np.where(~right, next_high, high)
        keep = ~second
        pair = np.flatnonzero(joined)
        new_high[pair] = high[pair + 1]
        named = symbols.copy()
        named[pair] = mix(symbols[pair] * np.uint64(0x94D049BB133111EB) + mix(symbols[pair + 1]))
        symbols, low, high, owner = named[keep], new_low[keep], new_high[keep], owner[keep]
    return low, high


def representative_keys(hashes: np.ndarray, first: np.ndarray, params: SubstringParams) -> tuple[np.ndarray, np.ndarray]:
    """Key and own hash of every window position; only those inside one document mean anything."""
    size = params.window
    own = window_hashes(hashes, size)
    if not len(own):
        return own, own
    low, high = compress_words(hashes, first, params.rounds)
    usable = (low >= 0) & (high <= len(hashes)) & (high - low <= size)
    low, high = low[usable], high[usable]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_SUM_BASE, len(hashes)), out=sums[1:])
    keys = mix((sums[high] - sums[low]) * powers(_SUM_INVERSE, len(hashes))[low] + (high - low).astype(np.uint64))
    at = np.arange(len(own))
    begin = np.searchsorted(low, at)
    end = np.searchsorted(high, at + size, "right")
    count = end - begin
    out = own.copy()
    least, step = keys, 1
    while step <= size:
        here = np.flatnonzero((count >= step) & (count < 2 * step))
        if len(here):
            out[here] = np.minimum(least[begin[here]], least[end[here] - step])
        if len(least) <= step:
            break
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return out, own


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from, to, word hashes and first words of stretches of a batch."""
    data, bounds = text_buffers(batch.column("text"))
    for begin, end in document_runs(bounds, _BATCH_BYTES):
        part = bounds[begin : end + 1]
        words = Words(data[part[0] : part[-1]], part - part[0])
        yield begin, end, words.hashes(), words.first


def _distinct(keys: np.ndarray, docs: np.ndarray, owns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (key, doc, own) in this order, and the index of the first one of each one's key."""
    order = np.lexsort((owns, docs, keys))
    keys, docs, owns = keys[order], docs[order], owns[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    fresh = new.copy()
    fresh[1:] |= (docs[1:] != docs[:-1]) | (owns[1:] != owns[:-1])
    starts = np.flatnonzero(new[fresh])
    firsts = np.repeat(starts, np.diff(np.append(starts, np.count_nonzero(fresh))))
    return keys[fresh], docs[fresh], owns[fresh], firsts


def _seen_batch(
    keys: np.ndarray, docs: np.ndarray, owns: np.ndarray, missing: np.ndarray, known: np.ndarray
) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(docs, pa.int64(), mask=missing), pa.array(owns), pa.array(known)],
        ["key", "doc", "own", "known"],
    )


def _emit_keys(params: SubstringParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc").to_numpy(), batch.column("own").to_numpy()
            for begin, end, hashes, first in _batches(batch):
                keys, _ = representative_keys(hashes, first, params)
                inside = runs_inside(first, params.window)
                docs = np.repeat(ids[begin:end], np.diff(first))[: len(keys)]
                owns = np.repeat(texts[begin:end], np.diff(first))[: len(keys)]
                keys, docs, owns, firsts = _distinct(keys[inside], docs[inside], owns[inside])
                several = np.bincount(firsts, minlength=len(keys))[firsts] > 1
                # A key of several documents is known here; one row without a document tells the others.
                told = several & (firsts == np.arange(len(keys)))
                yield _seen_batch(
                    np.concatenate((keys, keys[told])),
                    np.concatenate((docs, docs[told])),
                    np.concatenate((owns, owns[told])),
                    np.concatenate((np.zeros(len(keys), bool), np.ones(int(told.sum()), bool))),
                    np.concatenate((several, np.zeros(int(told.sum()), bool))),
                )

    return run


def _emit_windows(params: SubstringParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc").to_numpy(), batch.column("own").to_numpy()
            shared = batch.column("shared")
            for begin, end, hashes, first in _batches(batch):
                keys, own = representative_keys(hashes, first, params)
                last = np.maximum(first[1:] - params.window + 1, first[:-1])
                found, docs, owns = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for d in range(end - begin):
                    wanted = shared[begin + d].values
                    if wanted is None or last[d] == first[d]:
                        continue
                    here = slice(first[d], last[d])
                    at = np.isin(keys[here], wanted.to_numpy(zero_copy_only=False).view(np.uint64))
                    found.append(own[here][at])
                    docs.append(np.full(int(at.sum()), ids[begin + d], np.int64))
                    owns.append(np.full(int(at.sum()), texts[begin + d], np.int64))
                keys, docs, owns, firsts = _distinct(*(np.concatenate(part) for part in (found, docs, owns)))
                yield _seen_batch(keys, docs, owns, np.zeros(len(keys), bool), docs > docs[firsts])

    return run


def _apply(params: SubstringParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column("text"), batch.column("removed")
            n_words, n_removed, digests = [], [], []
            for text, gone in zip(texts, removed, strict=True):
                raw = (text.as_py() or "").encode()
                words = raw.split()
                n_words.append(len(words))
                gone = gone.values
                if gone is not None:
                    data = np.frombuffer(raw, np.uint8)
                    own = window_hashes(Words(data, np.array([0, len(data)])).hashes(), params.window)
                    hit = np.isin(own, gone.to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.int64)
                    edges = np.zeros(len(words) + 1, np.int64)
                    edges[: len(hit)] += hit
                    edges[params.window : params.window + len(hit)] -= hit
                    kept = np.cumsum(edges[:-1]) == 0
                    words = list(compress(words, kept.tolist()))
                n_removed.append(n_words[-1] - len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def _by_document(seen: DataFrame, holds: Column, name: str) -> DataFrame:
    """Each document's keys for which ``holds``, as far as the rows of a key tell; ``known`` rows need no others.

    Known rows go their own way instead of meeting at their key: their document's hash is
    mixed into the key for the shuffle and taken out again after it.
    """
    own_way = F.when(F.col("known"), F.xxhash64("doc", "own")).otherwise(F.lit(0).cast("long"))
    together = Window.partitionBy("route")
    judged = seen.select(F.col("key").bitwiseXOR(own_way).alias("route"), "doc", "own", "known").select(
        "route", "doc", "own", "known", F.count("*").over(together).alias("n"), F.min("doc").over(together).alias("least")
    )
    judged = judged.withColumn("key", F.col("route").bitwiseXOR(own_way))
    # A set, so that what copies without an id hold in common is kept once.
    return (
        judged.where((F.col("known") | holds) & F.col("doc").isNotNull())
        .groupBy(F.col("doc").alias("of_doc"), F.col("own").alias("of_own"))
        .agg(F.collect_set("key").alias(name))
    )


def remove_repeats(docs: DataFrame, params: SubstringParams = SubstringParams()) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row.

    The texts are shuffled by document once; both joins read the same exchange.
    """
    text_hash = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), text_hash.alias("own"))
    keys = docs.select("doc", "own", "text").mapInArrow(_emit_keys(params), _SEEN)
    shared = _by_document(keys, F.col("n") > 1, "shared")
    same = (F.col("doc") == F.col("of_doc")) & (F.col("own") == F.col("of_own"))
    # The same columns of the texts as below, so that the plan holds one exchange of them.
    suspects = docs.join(shared, same, "left").where(F.col("shared").isNotNull())
    suspects = suspects.select("doc_id", "text", "doc", "own", "shared")
    windows = suspects.mapInArrow(_emit_windows(params), _SEEN)
    removed = _by_document(windows, F.col("least") < F.col("doc"), "removed")
    joined = docs.join(removed, same, "left")
    return joined.select("doc_id", "text", "doc", "own", "removed").mapInArrow(
        _apply(params), "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
