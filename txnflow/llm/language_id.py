"""Language identification by rank-order profiles.

A language's profile lists its most frequent character n-grams of one to three letters in
rank order, counted over a bounded sample of its documents. A document's own most frequent
n-grams are compared with each profile: every n-gram adds the difference of its two ranks,
or the profile's length where the language lacks it. The smallest sum wins.

Letters are lower-cased; anything between letters counts as one gap. Defined cases: a null
text, or one without a letter, is ``und`` with score 0, as is everything when no language was
learned. Equal distances go to the language first in order of names; n-grams with equal
counts rank in order of their characters. Whole texts are counted. Repeated rows are
predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
_GAP = np.uint64(ord("_"))
_COUNTS = "lang string, gram long, n long"


@dataclass(frozen=True)
class LanguageParams:
    """``per_language`` bounds, in expectation, the documents sampled per language by hash."""

    per_language: int = 2000
    ranks: int = 300


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, packed 21 bits a character, and their counts; empty without a letter."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not text:
        return none
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return none
    chars = np.where(letter, points, _GAP).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    chars = np.concatenate(([_GAP], chars[keep], [_GAP]))
    if chars[1] == _GAP:
        chars = chars[1:]
    if len(chars) > 2 and chars[-2] == _GAP:
        chars = chars[:-1]
    two = (chars[:-1] << np.uint64(21)) | chars[1:]
    three = (two[:-1] << np.uint64(21)) | chars[2:]
    found, n = np.unique(np.concatenate((chars[chars != _GAP], two, three)), return_counts=True)
    return found, n


def ranked(found: np.ndarray, n: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams in rank order."""
    if len(found) > 4 * ranks:
        floor = np.partition(n, len(n) - ranks)[len(n) - ranks]
        found, n = found[n >= floor], n[n >= floor]
    return found[np.lexsort((found, -n))[:ranks]]


def _language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            parts.setdefault(lang, []).append(grams(text.as_py()))
        for lang, counted in parts.items():
            found, where = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
            n = np.bincount(where, np.concatenate([c for _, c in counted]), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found)), pa.array(found.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"]
            )


def learn_profiles(train: DataFrame, params: LanguageParams = LanguageParams()) -> dict[str, np.ndarray]:
    """Profiles from rows with text and a non-null lang; the driver gets ``ranks`` n-grams a language."""
    known = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = known.select("doc_id", "lang")
    sizes = ids.groupBy("lang").agg(F.count("*").alias("size"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    chosen = ids.join(sizes, "lang").where(place * F.col("size") < params.per_language).select("doc_id").distinct()
    sampled = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id").select("lang", "text")
    counts = sampled.mapInArrow(_language_counts, _COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= params.ranks)
    profiles: dict[str, list] = {}
    for row in top.select("lang", "gram", "place").orderBy("lang", "place").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(found, np.uint64) for lang, found in profiles.items()}


class ProfileTable:
    """All profiles side by side: each known n-gram's rank in each language, or ``ranks``."""

    def __init__(self, profiles: dict[str, np.ndarray], ranks: int) -> None:
        self.langs, self.ranks = sorted(profiles), ranks
        listed = [profiles[lang] for lang in self.langs]
        self.grams = np.unique(np.concatenate(listed)) if listed else np.zeros(0, np.uint64)
        # The last row serves n-grams that no profile holds.
        self.places = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for j, found in enumerate(listed):
            self.places[np.searchsorted(self.grams, found), j] = np.arange(len(found))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Best language and closeness: 1 for equal ranks, 0 where no n-gram is shared."""
        top = ranked(*grams(text), self.ranks)
        if not len(top) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.grams, top)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != top)] = len(self.grams)
        places = self.places[at]
        away = np.where(places < 0, self.ranks, np.abs(places - np.arange(len(top))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.ranks * len(top))


def predict_language(docs: DataFrame, profiles: dict[str, np.ndarray], params: LanguageParams = LanguageParams()) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs`` (doc_id, text); one narrow pass."""
    table = ProfileTable(profiles, params.ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [table.predict(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
