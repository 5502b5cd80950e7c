"""Stupid-backoff scores of documents from n-gram counts over all of them.

Documents are dealt into groups of bounded size. A group explodes its n-grams of every order
and sends each distinct one, with its count, to the bucket its hash falls in. A bucket adds up
the counts of an n-gram over all groups, which is its part of the count table, and answers
each group with the totals of the n-grams it sent. The group joins the totals to its exploded
n-grams and sums the scores per document. An n-gram makes one row part per group, however
often it occurs, so frequent ones do not gather in one task.

The score of a word after its predecessors is the logarithm of count(n-gram) / count(context)
for the longest n-gram seen at least ``min_count`` times, times ``backoff`` per order given
up; single words always have count / words in all.

Defined cases: a null or empty text has no words and scores 0. The first words of a document
have shorter contexts, without a penalty. Repeated rows count and are scored each. Words are
taken as they are, and n-grams compared by 64-bit hashes. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.text import Words, mix, runs_inside, text_buffers, window_hashes

_SENT = "bucket long, part long, keys array<long>, counts array<int>"
# Totals travel as ints; a bucket with larger ones answers in ``large`` instead.
_ANSWERED = "part long, bucket long, totals array<int>, large array<long>"
_SCORED = "doc_id long, n_words long, n_backoff long, log_score double"


@dataclass(frozen=True)
class LanguageModelParams:
    """``group_bytes`` is the text of a group; buckets are as many as groups."""

    order: int = 2
    backoff: float = 0.4
    min_count: int = 2
    group_bytes: int = 8 << 20


def _words(column: pa.ChunkedArray | pa.Array) -> Words:
    if isinstance(column, pa.ChunkedArray):
        column = pc.cast(column, pa.large_string()).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return Words(*text_buffers(column))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = text_buffers(batch.column("text"))
        words = len(Words(data, bounds))
        yield pa.RecordBatch.from_arrays([pa.array([len(data)]), pa.array([words])], ["bytes", "words"])


def _order_keys(hashes: np.ndarray, order: int) -> np.ndarray:
    return mix(window_hashes(hashes, order) + np.uint64(order))


def _group_keys(words: Words, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys of every n-gram inside a document, and per order the words at which they start."""
    hashes = words.hashes()
    keys, at = [], []
    for k in range(1, order + 1):
        inside = np.flatnonzero(runs_inside(words.first, k))
        keys.append(_order_keys(hashes, k)[inside])
        at.append(inside)
    return np.concatenate(keys), at


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _lists(flat: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, kind))


def _send(order: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        keys, counts = np.unique(_group_keys(_words(table.column("text")), order)[0], return_counts=True)
        bucket, first = np.unique(_bucket(keys, buckets), return_index=True)
        edges = np.append(first, len(keys))
        part = np.full(len(bucket), table.column("part")[0].as_py(), np.int64)
        return pa.table(
            [
                pa.array(bucket.astype(np.int64)), pa.array(part),
                _lists(keys.view(np.int64), edges, pa.int64()), _lists(counts, edges, pa.int32()),
            ],
            names=["bucket", "part", "keys", "counts"],
        )

    return run


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column in a row, and each row's number of them."""
    sizes = pc.list_value_length(column).to_numpy()
    return pc.list_flatten(column).to_numpy(), sizes


def _count(table: pa.Table) -> pa.Table:
    keys, sizes = _flat(table.column("keys"))
    counts, _ = _flat(table.column("counts"))
    found, where = np.unique(keys, return_inverse=True)
    totals = np.bincount(where, counts, len(found)).astype(np.int64)[where]
    edges, nothing = np.concatenate(([0], np.cumsum(sizes))), pa.nulls(table.num_rows, pa.list_(pa.int64()))
    if len(totals) and totals.max() >= 1 << 31:
        answers = [nothing.cast(pa.list_(pa.int32())), _lists(totals, edges, pa.int64())]
    else:
        answers = [_lists(totals.astype(np.int32), edges, pa.int32()), nothing]
    return pa.table(
        [table.column("part"), table.column("bucket"), *answers], names=["part", "bucket", "totals", "large"]
    )


def _score(n_words: int, params: LanguageModelParams):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        words = _words(docs.column("text"))
        keys, at = _group_keys(words, params.order)
        found, where = np.unique(keys, return_inverse=True)
        # Of the two lists of a row one is null, so this keeps the order of the buckets.
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        lists = pc.coalesce(answers.column("totals").cast(pa.list_(pa.int64())), answers.column("large"))
        totals, _ = _flat(lists.take(pa.array(order)))
        if len(totals) != len(found):
            raise RuntimeError("the answers do not fit the group's n-grams")
        counted = totals[where].astype(np.float64)
        per_order = np.split(counted, np.cumsum([len(a) for a in at])[:-1])
        score = np.log(per_order[0] / max(n_words, 1))
        lower = np.zeros(len(words), np.int64)
        context = per_order[0]
        for k in range(2, params.order + 1):
            starts, own = at[k - 1], per_order[k - 1]
            before = context[np.searchsorted(at[k - 2], starts)]
            last = starts + k - 1
            seen = own >= params.min_count
            score[last] = np.where(seen, np.log(own / before), np.log(params.backoff) + score[last])
            lower[last] = ~seen
            context = own
        doc = words.doc()
        return pa.table(
            [
                docs.column("doc_id"),
                pa.array(np.diff(words.first), pa.int64()),
                pa.array(np.bincount(doc, lower, words.n_docs).astype(np.int64)),
                pa.array(np.bincount(doc, score, words.n_docs)),
            ],
            names=["doc_id", "n_words", "n_backoff", "log_score"],
        )

    return run


def score_documents(docs: DataFrame, params: LanguageModelParams = LanguageModelParams()) -> DataFrame:
    """doc_id, n_words, n_backoff (words that gave up the full order) and log_score of every row.

    The texts are shuffled once, into groups; both uses of the groups read that exchange.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sizes = docs.select("text").mapInArrow(_sizes, "bytes long, words long")
    n_bytes, n_words = sizes.agg(F.sum("bytes"), F.sum("words")).first()
    groups = max(1, -(-(n_bytes or 0) // params.group_bytes))
    grouped = docs.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))
    sent = grouped.groupBy("part").applyInArrow(_send(params.order, groups), _SENT)
    answered = sent.groupBy("bucket").applyInArrow(_count, _ANSWERED)
    return (
        grouped.groupBy("part").cogroup(answered.groupBy("part")).applyInArrow(_score(n_words or 0, params), _SCORED)
    )
