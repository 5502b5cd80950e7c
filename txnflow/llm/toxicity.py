"""Toxicity by the nearest labelled examples.

A bounded sample of labelled documents is kept as examples. Every word of theirs counts, by
its TF-IDF times its association with the label among them, the squared phi coefficient
(chi-squared by the number of examples, so it means the same at every size). A word that no
example holds has none and weighs exactly nothing. Inverse document frequencies come from all
documents. Each document's exact cosine to the examples is searched through an inverted index
in blocks of examples: the largest weight of a word in a block bounds the block's cosines,
the blocks of the highest bounds are read first, then every other that can still hold a
nearer example. The nearest ones vote with their cosine, each class weighted back to its
share of all labels, and the share of labels stands in where nothing is near.

Defined cases: a null or empty text, or one without a word of the examples, scores the share
of toxic labels. Without labels of both classes there is no vocabulary and all documents score
that share (0 without any label). Repeated rows are scored each. Of several labels of a
document the toxic one counts, and of several texts of a labelled id the least. Examples with
equal cosine vote in the examples' order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.session import work_folder

_TERM = re.compile(r"[^\W\d_]+")
_VECTOR = "doc_id long, terms array<int>, counts array<int>"
_SCORED = "doc_id long, score double, evidence array<struct<doc_id: long, toxic: int, cosine: float>>"


@dataclass(frozen=True)
class ToxicityParams:
    """Bounds: at most ``per_class`` examples of each label, with all their words.

    ``neighbours`` is the number of voters, ``prior_weight`` the vote of the overall share,
    ``evidence`` the examples shown. Without ``association`` words weigh by TF-IDF alone.
    """

    per_class: int = 2000
    association: bool = True
    neighbours: int = 15
    block: int = 64
    prior_weight: float = 0.1
    evidence: int = 3


def _terms(text: str | None) -> list[str]:
    return _TERM.findall(text.lower()) if text else []


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (doc, toxic, term)
            for doc, toxic, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for term in sorted(set(_terms(text)))
        ]
        columns = list(zip(*rows, strict=True)) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())],
            ["doc_id", "toxic", "term"],
        )


def sample_examples(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> tuple[DataFrame, float]:
    """At most ``per_class`` labelled documents of each class by hash of their id, and the toxic share."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    ordered = [
        known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.per_class)
        for kind in (0, 1)
    ]
    return ordered[0].unionByName(ordered[1]), share


def example_words(example_terms: DataFrame) -> tuple[list[str], np.ndarray]:
    """The examples' words in their order, each with the same factor."""
    found = example_terms.select("term").distinct().toArrow().sort_by("term")
    return found["term"].to_pylist(), np.ones(found.num_rows)


def label_associations(example_terms: DataFrame, sizes: tuple[int, int]) -> tuple[list[str], np.ndarray]:
    """The examples' words in their order, and the squared phi coefficient of each with the label.

    A word held by the same share of both classes has a coefficient of zero and is left out.
    """
    clean, toxic = (F.lit(float(n)) for n in sizes)
    a, b = F.col("a"), F.col("b")
    c, d = toxic - a, clean - b
    phi2 = (a * d - b * c) * (a * d - b * c) / (toxic * clean * (a + b) * (c + d))
    found = (
        example_terms.groupBy("term")
        .agg(F.count_if(F.col("toxic") == 1).cast("double").alias("a"), F.count_if(F.col("toxic") == 0).cast("double").alias("b"))
        .where(a * d != b * c)
        .select("term", phi2.alias("phi2"))
        .toArrow()
        .sort_by("term")
    )
    return found["term"].to_pylist(), found["phi2"].to_numpy()


def _vectors(vocabulary: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(vocabulary)}.get
        for batch in batches:
            ids, counts, offsets = [], [], [0]
            for text in batch.column("text"):
                held = [i for i in map(number, _terms(text.as_py())) if i is not None]
                if held:
                    term, n = np.unique(held, return_counts=True)
                    ids.append(term)
                    counts.append(n)
                    offsets.append(offsets[-1] + len(term))
                else:
                    offsets.append(offsets[-1])
            flat = [pa.array(np.concatenate(x) if x else [], pa.int32()) for x in (ids, counts)]
            bounds = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.ListArray.from_arrays(bounds, x) for x in flat)],
                ["doc_id", "terms", "counts"],
            )

    return run


def _frequencies(n_terms: int):
    """Documents that hold each word, counted within each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_terms, np.int64)
        for batch in batches:
            n += np.bincount(batch.column("terms").flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n[found], pa.int64())], ["term", "n"])

    return run


def _weights(terms: np.ndarray, counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    w = (1 + np.log(counts)) * factors[terms]
    norm = np.sqrt((w * w).sum())
    return (w / norm if norm > 0 else w).astype(np.float32)


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each start up to its end, and the size of each span."""
    sizes = ends - starts
    found = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    found += np.arange(len(found))
    return found, sizes


class Postings:
    """The examples that hold each word with its weight there; indexing with words gives dense rows."""

    def __init__(self, terms: np.ndarray, at: np.ndarray, values: np.ndarray, n_terms: int, width: int) -> None:
        order = np.lexsort((at, terms))
        self.at, self.values, self.width = at[order], values[order], width
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def __getitem__(self, terms: np.ndarray) -> np.ndarray:
        p, sizes = _spans(self.first[terms], self.first[terms + 1])
        rows = np.zeros((len(terms), self.width), np.float32)
        rows[np.repeat(np.arange(len(terms)), sizes), self.at[p]] = self.values[p]
        return rows


class BlockMaxIndex:
    """Example weights by word, in blocks of examples with the largest weight of each word."""

    def __init__(self, examples: list[tuple[int, int, np.ndarray, np.ndarray]], n_terms: int, block: int) -> None:
        # Examples led by the same word share a block, which keeps the blocks' bounds tight.
        examples = sorted(
            examples, key=lambda e: (e[2][int(np.argmax(e[3]))] if len(e[2]) else n_terms, e[1], e[0])
        )
        self.block, self.n = block, len(examples)
        self.n_blocks = -(-max(self.n, 1) // block)
        self.ids = np.array([e[0] for e in examples], np.int64)
        self.toxic = np.array([e[1] for e in examples], np.int32)
        terms = np.concatenate([np.zeros(0, np.int64), *(e[2] for e in examples)]).astype(np.int64)
        at = np.repeat(np.arange(self.n, dtype=np.intp), [len(e[2]) for e in examples])
        values = np.concatenate([np.zeros(0, np.float32), *(e[3] for e in examples)])
        self.weights = Postings(terms, at, values, n_terms, self.n)
        # A word's postings lie in the order of the examples, so those of a block are next to each other.
        owner = np.repeat(np.arange(n_terms), np.diff(self.weights.first))
        key = owner * self.n_blocks + self.weights.at // block
        self.starts = np.flatnonzero(np.diff(key, prepend=-1))
        self.blocks = (key[self.starts] % self.n_blocks).astype(np.intp)
        self.highest = np.maximum.reduceat(self.weights.values, self.starts) if len(key) else values
        self.first = np.searchsorted(key[self.starts], np.arange(n_terms + 1) * self.n_blocks)
        self.starts = np.append(self.starts, len(key))

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k examples with the highest positive cosine."""
        j, sizes = _spans(self.first[terms], self.first[terms + 1])
        blocks, factors = self.blocks[j], np.repeat(values, sizes)
        bounds = np.bincount(blocks, self.highest[j] * factors, self.n_blocks)
        order = np.argsort(-bounds, kind="stable")
        ahead = -(-k // self.block) + 1
        read = np.zeros(self.n_blocks, bool)
        found, cosines = np.zeros(0, np.int64), np.zeros(0)
        for step in (order[:ahead], order[ahead:]):
            least = cosines[-1] if len(cosines) == k else 0.0
            # The margin covers rounding, so that no equal cosine is passed over.
            read[:] = False
            read[step] = (bounds[step] > 0) & (bounds[step] >= least - 1e-6)
            if not read.any():
                break
            held = np.flatnonzero(read[blocks])
            lists = j[held]
            p, sizes = _spans(self.starts[lists], self.starts[lists + 1])
            near = np.bincount(self.weights.at[p], self.weights.values[p] * np.repeat(factors[held], sizes), self.n)
            positive = np.flatnonzero(near >= least if least > 0 else near > 0)
            if len(positive) > k:
                # What is further than the k-th of these is not sorted.
                positive = positive[near[positive] >= np.partition(near[positive], -k)[-k]]
            found, cosines = np.append(found, positive), np.append(cosines, near[positive])
            best = np.lexsort((found, -cosines))[:k]
            found, cosines = found[best], cosines[best]
        return found, cosines


def _votes(index: BlockMaxIndex, factors: np.ndarray, share: float, params: ToxicityParams):
    ones = max(int(index.toxic.sum()), 1)
    zeros = max(index.n - ones, 1)
    balance = np.where(index.toxic == 1, share / ones, (1 - share) / zeros)
    balance = balance / balance.max() if len(balance) and balance.max() > 0 else balance

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, list[dict]]] = {}
        for batch in batches:
            scores, evidence = [], []
            for terms, counts in zip(batch.column("terms"), batch.column("counts"), strict=True):
                terms = terms.values.to_numpy(zero_copy_only=False)
                counts = counts.values.to_numpy(zero_copy_only=False)
                key = blake2b(terms.tobytes() + counts.tobytes(), digest_size=16).digest()
                if key not in known:
                    if len(known) > 50_000:
                        known.clear()
                    at, cosine = index.nearest(terms, _weights(terms, counts, factors), params.neighbours)
                    votes = cosine * balance[at]
                    yes = float((votes * index.toxic[at]).sum()) + params.prior_weight * share
                    all_votes = float(votes.sum()) + params.prior_weight
                    shown = [
                        {"doc_id": int(index.ids[i]), "toxic": int(index.toxic[i]), "cosine": float(c)}
                        for i, c in zip(at[: params.evidence], cosine[: params.evidence], strict=True)
                    ]
                    known[key] = (min(max(yes / all_votes, 0.0), 1.0), shown)
                score, shown = known[key]
                scores.append(score)
                evidence.append(shown)
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(evidence, kind)],
                ["doc_id", "score", "evidence"],
            )

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, score and evidence of every row of ``docs``, learned from ``labels`` (doc_id, toxic).

    The driver receives the examples' vectors, their words and the words' document frequencies;
    ``params`` bounds the number of examples. The documents' vectors are written once to the shared
    folder; the frequencies and the search both read them.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    sample, share = sample_examples(docs, labels, params)
    folder = work_folder(spark, "toxicity")
    sample.write.parquet(f"{folder}/sample")
    sample = spark.read.schema("doc_id long, toxic int").parquet(f"{folder}/sample")
    held = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    held.write.parquet(f"{folder}/examples")
    held = spark.read.schema("doc_id long, toxic int, text string").parquet(f"{folder}/examples")
    counted = {row["toxic"]: row["count"] for row in held.groupBy("toxic").count().collect()}
    sizes = (counted.get(0, 0), counted.get(1, 0))
    terms = held.mapInArrow(_example_terms, "doc_id long, toxic int, term string")
    if not all(sizes):
        vocabulary, association = [], np.zeros(0)
    elif params.association:
        vocabulary, association = label_associations(terms, sizes)
    else:
        vocabulary, association = example_words(terms)

    docs.mapInArrow(_vectors(vocabulary), _VECTOR).write.parquet(f"{folder}/vectors")
    vectors = spark.read.schema(_VECTOR).parquet(f"{folder}/vectors")
    n_docs = vectors.count()
    frequency = np.zeros(len(vocabulary))
    counted = vectors.select("terms").mapInArrow(_frequencies(len(vocabulary)), "term int, n long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency[counted["term"].to_numpy()] = counted["n"].to_numpy()
    factors = (np.log((1 + n_docs) / (1 + frequency)) + 1e-6) * association
    found = held.mapInArrow(_vectors(vocabulary), _VECTOR).join(F.broadcast(sample), "doc_id").toArrow()
    examples = []
    for doc, toxic, terms, counts in zip(*(found[c] for c in ("doc_id", "toxic", "terms", "counts")), strict=True):
        at, n = (x.values.to_numpy(zero_copy_only=False) for x in (terms, counts))
        examples.append((doc.as_py(), toxic.as_py(), at, _weights(at, n, factors)))
    index = BlockMaxIndex(examples, len(vocabulary), params.block)
    return vectors.mapInArrow(_votes(index, factors, share, params), _SCORED)
