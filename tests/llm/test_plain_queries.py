"""Queries without SQL against plain versions over their whole table."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from check import connect

from txnflow.llm import queries
from txnflow.llm.sentencepiece_codec import MARK, load_pieces

SF = "/root/testdata/sf0.001"


def best_score(text, pieces):
    """The best sum of scores over all ways to cut a text; a character without a piece costs the least score less ten."""
    text = MARK + text.replace(MARK, "\udfff").replace(" ", MARK)
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - pieces.longest), end):
            known = pieces.known.get(text[start:end])
            if known or end - start == 1:
                best[end] = max(best[end], best[start] + (known[0] if known else pieces.lowest))
    return best[-1]


def score_of(ids, pieces):
    """The sum for pieces as returned; byte pieces in a row spell characters that no piece holds."""
    score_by_id = {i: s for s, i in pieces.known.values()}
    byte_of = {int(i): value for value, i in enumerate(pieces.bytes_at)}
    total, spelled = 0.0, bytearray()
    for i in ids:
        if i in byte_of:
            spelled.append(byte_of[i])
        else:
            total += score_by_id[i]
    return total + pieces.lowest * len(spelled.decode())


def test_encoding_scores_as_well_as_any_cut(spark):
    pieces = load_pieces(queries.PIECES)
    texts = connect(SF).execute("select doc_id, text from documents").fetchall()
    found = {r["doc_id"]: r["ids"] for r in queries.registered()["op8_sentencepiece"](spark, SF).collect()}
    checked = 0
    for doc, text in texts:
        if text and len(text) < 4000:
            assert score_of(found[doc], pieces) == pytest.approx(best_score(text, pieces), abs=1e-3), doc
            checked += 1
    assert checked > 100


def plain_grams(text):
    """Counts of one to three letters of the lower-cased runs of letters, with one gap around each."""
    runs = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line = "_" + "_".join(runs) + "_" if runs else ""
    grams = Counter(line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1))
    del grams["_"]
    return grams


def most_frequent(grams, ranks=300):
    return sorted(grams, key=lambda g: (-grams[g], len(g), g))[:ranks]


def test_languages_equal_those_of_plain_profiles(spark):
    docs = connect(SF).execute("select doc_id, text, lang from documents").fetchall()
    counted = {i: plain_grams(text) for i, text, _ in docs}
    held_out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in docs}
    totals = defaultdict(Counter)
    for i, text, lang in docs:
        if lang is not None and text is not None and not held_out[i]:
            totals[lang] += counted[i]
    profiles = {lang: {g: place for place, g in enumerate(most_frequent(c))} for lang, c in totals.items()}
    found = {r["doc_id"]: r for r in queries.op3_language_id(spark, SF).collect()}
    assert len(found) == len(docs) and len(profiles) > 1
    for i, *_ in docs:
        top = most_frequent(counted[i])
        away = {
            lang: sum(abs(places[g] - at) if g in places else 300 for at, g in enumerate(top))
            for lang, places in sorted(profiles.items())
        }
        best = min(away, key=away.get) if top else "und"
        score = 1 - away[best] / (300 * len(top)) if top else 0
        row = found[i]
        assert (row["held_out"], row["lang_pred"]) == (held_out[i], best)
        assert row["score"] == pytest.approx(score, abs=1e-12)
