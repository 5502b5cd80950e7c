"""Properties of the methods themselves, on small inputs."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from brute import components, lm_scores, repeats_removed
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnflow.llm import language_id as L
from txnflow.llm import lm_scoring as M
from txnflow.llm import sentencepiece_codec as P
from txnflow.llm import simhash_dedup as H
from txnflow.llm import substring_dedup as R
from txnflow.llm import toxicity as T
from txnflow.llm.components import connected_components
from txnflow.llm.decontamination import DecontaminationParams, ItemIndex, Postings, find_contamination, weighted_similarity
from txnflow.llm.queries import PIECES
from txnflow.llm.text import Words, text_buffers, window_hashes, words_of
from txnflow.session import work_folder


@pytest.fixture(scope="module")
def pieces():
    return P.load_pieces(PIECES)


@given(st.lists(st.text(max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_of_a_column(texts):
    data, bounds = text_buffers(pa.array(texts, pa.string()))
    words = Words(data, bounds)
    found = [bytes(data[a:b]) for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == [w for t in texts for w in t.encode().split()]
    assert np.diff(words.first).tolist() == [len(t.encode().split()) for t in texts]
    assert len(set(words.hashes().tolist())) == len(set(found))


def test_words_with_built_in_functions(spark):
    texts = [None, "", " \x0b\t", "a\x0cb c d ", "\na  b\n"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in frame.select(words_of(F.col("text"))).collect()] == [[], [], [], ["a", "b", "c d"], ["a", "b"]]


@given(st.lists(st.text("ab ▁\né\U0001d518thein", max_size=40), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_viterbi_equals_the_plain_one_and_round_trips(pieces, texts):
    ids, counts = pieces.encode_texts(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert pieces.decode(got.tolist()) == text
        plain = [t for w in pieces.split(text) for t in pieces._spell(np.array(pieces._one(w), np.int32)).tolist()]
        assert got.tolist() == plain


def test_viterbi_is_optimal(pieces):
    """Against every segmentation of short words."""
    def best(word):
        if not word:
            return 0.0
        scores = []
        for size in range(1, len(word) + 1):
            known = pieces.known.get(word[:size])
            if known or size == 1:
                scores.append((known[0] if known else pieces.lowest) + best(word[size:]))
        return max(scores)

    for word in ("▁the", "▁tional", "thhe", "▁schön", "qxz"):
        got = pieces._one(word)
        text = [next((p for p, (_, i) in pieces.known.items() if i == t), None) for t in got]
        assert sum(pieces.known[p][0] if p else pieces.lowest for p in text) == pytest.approx(best(word))


def test_long_word_and_decoding(spark, documents, pieces):
    docs = documents([(1, "x" * 5000 + " end"), (2, None)])
    encoded = P.encode_documents(docs, pieces)
    assert {r["doc_id"]: r["text"] for r in P.decode_documents(encoded, pieces).collect()} == {1: "x" * 5000 + " end", 2: ""}


def test_every_choice_of_positions():
    assert len(H.position_masks(2)) == 28
    assert all(bin(m & (1 << 64) - 1).count("1") == 48 for m in H.position_masks(2))


@pytest.mark.parametrize("size", [40, 400])
def test_links_within_bits(spark, size):
    """A crowd of near fingerprints, small and large enough for either way to find neighbours."""
    rng = random.Random(size)
    values = {i: (0xABCDEF0123456789 ^ sum(1 << rng.randrange(12) for _ in range(rng.randrange(4)))) for i in range(size)}
    values |= {size + i: rng.getrandbits(64) for i in range(50)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in set(values.values())]
    links = H.fingerprint_links(spark.createDataFrame(signed, "fp long"), 2)
    found = connected_components(links, work_folder(spark, "t")).collect()
    root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in found}
    label = components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    groups = {}
    for i, v in values.items():
        groups.setdefault(root.get(v, v), set()).add(i)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(i for i in values if label[i] == r) for r in set(label.values())
    }


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(200, 200)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"), work_folder(spark, "t")).collect()
    root = {r["node"]: r["root"] for r in found}
    assert root == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 180)}}


def test_rows_without_ids_keep_their_keys_apart(spark, documents):
    """They count as larger than any other row, never remove from each other, and gather no common list."""
    def text(start, n=40):
        return " ".join(f"w{j}" for j in range(start, start + n))

    rows = [(1, text(0)), (None, text(0)), (None, text(20)), (None, text(100)), (None, text(100)), (None, text(120)), (2, None)]
    found = R.remove_repeats(documents(rows))
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in found.collect()) == [
        (0, 40, 0), (0, 40, 0), (0, 40, 0), (0, 40, 20), (0, 40, 40), (1, 40, 0), (2, 0, 0)]
    docs = documents(rows).selectExpr(
        "text", "coalesce(doc_id, 9223372036854775807) doc", "if(doc_id is null, xxhash64(text), 0L) own")
    seen = docs.select("doc", "own", "text").mapInArrow(R._emit_keys(R.SubstringParams()), R._SEEN)
    lists = R._by_document(seen, F.col("n") > 1, "shared").collect()
    assert all(len(r["shared"]) <= 28 for r in lists)
    assert len({r["of_own"] for r in lists if r["of_doc"] > 2}) == 4


def test_repeats_with_runs_and_overlaps(spark, documents):
    rng = random.Random(7)
    texts = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(4)
            if kind == 0:
                parts += ["a"] * rng.randrange(1, 30)
            elif kind == 1:
                parts += [rng.choice("ab") for _ in range(rng.randrange(25))]
            elif kind == 2:
                parts += [f"w{j}" for j in range(rng.randrange(5), rng.randrange(12, 40))]
            else:
                parts += [f"u{i}-{j}" for j in range(rng.randrange(20))]
        texts.append((i, " ".join(parts)))
    for rounds in (1, 2, 3, 5):
        found = R.remove_repeats(documents(texts), R.SubstringParams(rounds=rounds)).collect()
        assert {r["doc_id"]: tuple(r) for r in found} == {w[0]: w for w in repeats_removed(texts)}


def test_symbols_inside_a_window_are_the_same_everywhere():
    rng = random.Random(3)
    params = R.SubstringParams()
    for _ in range(50):
        core = [rng.choice("abcdefgh") for _ in range(13)]
        keys = set()
        for _ in range(4):
            text = " ".join([rng.choice("abcdefgh") for _ in range(rng.randrange(6))] + core + [rng.choice("abcd") for _ in range(rng.randrange(6))])
            raw = np.frombuffer(text.encode(), np.uint8)
            words = Words(raw, np.array([0, len(raw)]))
            key, own = R.representative_keys(words.hashes(), words.first, params)
            lone = Words(np.frombuffer(" ".join(core).encode(), np.uint8), np.array([0, 25]))
            want = R.representative_keys(lone.hashes(), lone.first, params)[1][0]
            keys.add(int(key[own == want][0]))
        assert len(keys) == 1


def test_block_max_finds_the_nearest():
    rng = np.random.default_rng(1)
    examples = []
    for i in range(300):
        terms = np.sort(rng.choice(80, rng.integers(1, 9), replace=False)).astype(np.int32)
        examples.append((i, int(rng.integers(2)), terms, T._weights(terms, rng.integers(1, 4, len(terms)), np.ones(80))))
    index = T.BlockMaxIndex(examples, 80, 16)
    for _ in range(50):
        terms = np.sort(rng.choice(80, 5, replace=False)).astype(np.int32)
        values = T._weights(terms, np.ones(5, int), np.ones(80))
        at, cosines = index.nearest(terms, values, 10)
        everything = np.sort(values @ index.weights[terms])[::-1][:10]
        assert np.allclose(cosines, everything[everything > 0][: len(cosines)], atol=1e-6)
        assert len(cosines) == (everything > 0).sum()


@pytest.mark.parametrize("association", [True, False])
def test_toxicity_is_the_vote_by_cosine_over_every_word(spark, documents, association):
    """Cosines and scores against every example, with all the words of both texts."""
    rng = random.Random(4)
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)]
    texts = [(i, " ".join(rng.choices(names[: 150 + 150 * (i % 3 == 0)], k=rng.randrange(5, 60)))) for i in range(60)]
    labels = {i: int(i % 3 == 0) for i in range(40)}
    held = {i: [t.split().count(w) for w in names] for i, t in texts}
    counts = np.array([held[i] for i in range(60)], float)
    toxic, has = np.array(list(labels.values())), counts > 0
    factors = has[:40].any(axis=0).astype(float)
    if association:
        with np.errstate(all="ignore"):
            factors = np.nan_to_num([np.corrcoef(has[:40, w], toxic)[0, 1] for w in range(300)]) ** 2
    with np.errstate(all="ignore"):
        tf = np.where(has, 1 + np.log(counts), 0)
    weights = tf * np.log(61 / (1 + has.sum(axis=0))) * factors
    weights /= np.linalg.norm(weights, axis=1, keepdims=True)
    cosines = weights @ weights[:40].T
    frame = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    params = T.ToxicityParams(association=association)
    found = {r["doc_id"]: r for r in T.score_toxicity(documents(texts), frame, params).collect()}
    # Each class votes by its share of the labels; the heavier one counts in full.
    share = toxic.mean()
    worth = np.where(toxic == 1, share / toxic.sum(), (1 - share) / (1 - toxic).sum())
    worth /= worth.max()
    for i, row in enumerate(cosines):
        best = np.argsort(-row, kind="stable")[: params.neighbours]
        assert np.allclose([e["cosine"] for e in found[i]["evidence"]], row[best][: params.evidence], atol=1e-4)
        yes = (row * worth * toxic)[best].sum() + params.prior_weight * share
        assert found[i]["score"] == pytest.approx(yes / ((row * worth)[best].sum() + params.prior_weight), abs=1e-4)


def test_toxicity_takes_the_least_text_of_a_repeated_id(spark, documents):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    texts = [(1, "vile words"), (1, "awful words"), (2, "kind words"), (3, "awful"), (4, "vile"), (5, None)]
    for order in (texts, texts[::-1]):
        found = {r["doc_id"]: r["score"] for r in T.score_toxicity(documents(order), labels).collect() if r["doc_id"] > 2}
        assert found[3] > 0.9 and found[4] == found[5] == 0.5


def test_rank_order_distance():
    profiles = {"x": L.ranked(*L.grams("aaa aab aac"), 50), "y": L.ranked(*L.grams("zzz zzy zzx"), 50)}
    table = L.ProfileTable(profiles, 50)
    assert table.predict("aaa aab aac") == ("x", 1.0)
    assert table.predict("zzz") [0] == "y"
    assert table.predict("123") == ("und", 0.0)
    assert table.predict("qqq") == ("x", 0.0)


def test_three_word_model(spark, documents):
    texts = [(i, " ".join(random.Random(i).choices("abcde", k=30))) for i in range(20)]
    found = {r["doc_id"]: r for r in M.score_documents(documents(texts), M.LanguageModelParams(group_bytes=200)).collect()}
    for doc, n, lower, score in lm_scores(texts):
        assert (found[doc]["n_words"], found[doc]["n_backoff"]) == (n, lower)
        assert found[doc]["log_score"] == pytest.approx(score, abs=1e-3)
    wider = M.LanguageModelParams(order=3, min_count=1, group_bytes=200)
    assert all(r["n_backoff"] == 0 for r in M.score_documents(documents(texts), wider).collect())


def test_index_covers_the_radius():
    """Flipping up to 31 bits anywhere leaves a block the index still finds, and chance pairs are few."""
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 256, (200, 16)).astype(np.uint8)
    postings = Postings(prints)
    of = rng.integers(0, 200, 2000)
    bits = np.unpackbits(prints[of], axis=1)
    for row in bits:
        row[rng.choice(128, 31, replace=False)] ^= 1
    windows, items = postings.candidates(np.packbits(bits, axis=1))
    assert set(enumerate(of.tolist())) <= set(zip(windows.tolist(), items.tolist()))
    strange = rng.integers(0, 256, (5000, 16)).astype(np.uint8)
    assert len(postings.candidates(strange)[0]) < 0.01 * 5000 * 200


def word_hashes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)])).hashes()


def test_a_long_text_of_items_stays_small_and_compares_few_pairs():
    rng = np.random.default_rng(6)
    items = [(k, " ".join(f"w{x}" for x in rng.integers(0, 3000, 30 + k % 30))) for k in range(1000)]
    index = ItemIndex(items, DecontaminationParams())
    shingles = window_hashes(word_hashes(" ".join(t for _, t in items[:400])), 5)
    hit = index.hits(shingles)
    tracemalloc.start()
    found = index.matches(shingles, hit)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {m[0] for m in found if m[1] == 1.0} == set(range(400))
    assert peak < 200 << 20
    assert index.compared < 0.02 * len(shingles) * 1000


def test_recall_of_windows_just_above_the_threshold(spark, documents):
    """Items of which so many words were changed that 0.80 to 0.85 of the shingles are left."""
    rng = np.random.default_rng(7)
    items, texts, want = [], [], set()
    for k in range(400):
        words = [f"i{k}w{x}" for x in range(50 + k % 12)]
        edited = list(words)
        for at in rng.choice(np.arange(5, len(words) - 5), 1, replace=False):
            edited[at] = "changed"
        likeness = weighted_similarity(*(window_hashes(word_hashes(" ".join(w)), 5) for w in (words, edited)))
        if 0.8 <= likeness <= 0.85:
            items.append((k, " ".join(words)))
            texts.append((k, f"some words before {' '.join(edited)} and some after"))
            want.add((k, k))
    found = find_contamination(documents(texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    hits = {(r["doc_id"], r["item_id"]) for r in found}
    assert len(want) > 200 and hits <= want
    assert len(hits) >= 0.9 * len(want)


def test_items_shorter_than_a_shingle_match_as_a_whole(spark, documents):
    items = spark.createDataFrame(
        [(1, "Golden Gate Bridge"), (2, "alone"), (3, ""), (4, "golden gate bridge")], "item_id long, text string")
    docs = documents([(1, "the golden gate BRIDGE is the golden gate bridge"), (2, "golden gate"), (3, "alone"),
                      (4, "golden"), (5, "gate bridge"), (6, "a golden gate"), (7, "bridge golden gate bridge")])
    found = find_contamination(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["first_word"], r["n_words"], r["similarity"]) for r in found) == [
        (1, 1, 1, 3, 1.0), (1, 4, 1, 3, 1.0), (3, 2, 0, 1, 1.0), (7, 1, 1, 3, 1.0), (7, 4, 1, 3, 1.0)]


def test_decontamination_in_several_passes(spark, documents):
    item = " ".join(f"w{i}" for i in range(60))
    edited = item.replace("w30 ", "other ")
    docs = documents([(1, f"before it {item} after it"), (2, f"x {edited} y"), (3, item[:60]), (4, item.upper())])
    items = spark.createDataFrame([(i, item if i == 3 else f"q{i} " * 20) for i in range(8)], "item_id long, text string")
    for size in (48 << 20, 100_000):
        found = find_contamination(docs, items, DecontaminationParams(pass_bytes=size)).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 3), (2, 3), (4, 3)]


def test_totals_beyond_32_bits():
    """A bucket whose totals need more than an int answers in the wide column, to every part that asked."""
    keys, counts = pa.array([[1, 2], [2]], pa.list_(pa.int64())), pa.array([[1, 2_000_000_000], [2_000_000_000]], pa.list_(pa.int32()))
    sent = pa.table([pa.array([0, 0]), pa.array([7, 8]), keys, counts], names=["bucket", "part", "keys", "counts"])
    assert M._count(sent).to_pylist() == [
        {"part": 7, "bucket": 0, "totals": None, "large": [1, 4_000_000_000]},
        {"part": 8, "bucket": 0, "totals": None, "large": [4_000_000_000]},
    ]
