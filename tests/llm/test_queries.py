"""The registered queries over whole tables, against SQL or a plain version."""

import pytest
from brute import components, contaminated, fingerprint, lm_scores, repeats_removed
from check import compare, connect

from txnflow.llm import queries, sql

SF = "/root/testdata/sf0.001"
ORACLES = sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("select doc_id, text from documents order by 1").fetchall()


def rows(spark, name):
    return queries.registered()[name](spark, SF).collect()


def test_a_query_of_each_operator_is_registered():
    numbered = [name.split("_")[0] for name in queries.registered() if name.startswith("op")]
    assert numbered == [f"op{n}" for n in range(1, len(numbered) + 1)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    count, difference = compare(spark, con, queries.registered()[name], ORACLES[name], SF)
    assert difference is None
    assert count > 0


def test_kept_documents_of_the_quality_query(spark):
    frame = queries.registered()["op10_quality_rules"](spark, SF)
    assert frame.where("kept").count() == sum(r["kept"] for r in frame.collect())


def test_lm_scores(spark, texts):
    found = {r["doc_id"]: r for r in rows(spark, "op1_lm_scoring")}
    for doc, n, lower, score in lm_scores(texts):
        assert (found[doc]["n_words"], found[doc]["n_backoff"]) == (n, lower)
        assert found[doc]["log_score"] == pytest.approx(score, abs=2e-4)


def test_language_of_held_out_documents(spark, con):
    langs = dict(con.execute("select doc_id, lang from documents").fetchall())
    found = [r for r in rows(spark, "op3_language_id") if r["held_out"]]
    assert len(found) > 30
    assert sum(langs[r["doc_id"]] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_decontamination(spark, con, texts):
    items = con.execute("select item_id, text from benchmark").fetchall()
    # Windows are slow to list plainly; the benchmark's words tell which documents can match.
    vocabulary = {w for _, t in items for w in t.lower().split()}
    near = [(d, t) for d, t in texts if sum(w in vocabulary for w in t.lower().split()) > 12 and len(t) < 3000]
    want = contaminated(near, items)
    kept = {d for d, _ in near}
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows(spark, "op5_decontamination")}
    assert {k: pytest.approx(v) for k, v in want.items()} == {k: v for k, v in found.items() if k[0] in kept}
    assert want


def test_simhash(spark, texts):
    prints = {d: fingerprint(t) for d, t in texts}
    label = components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, "op6_simhash_dedup")}
    assert found == {d: (f"{prints[d]:016x}", label[d]) for d in prints}
    assert any(label[d] != d for d in label)


def test_substring_dedup(spark, texts):
    found = {r["doc_id"]: tuple(r) for r in rows(spark, "op7_substring_dedup")}
    want = list(repeats_removed(texts))
    assert found == {w[0]: w for w in want}
    assert sum(w[2] for w in want) > 0


def test_encoding_gives_back_every_text(spark, texts):
    found = rows(spark, "op8_sentencepiece")
    assert len(found) == len(texts)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in found)


def test_toxicity_of_held_out_documents(spark):
    # The larger table: the small one holds too few labels to learn from.
    frame = queries.op2_toxicity(spark, "/root/testdata/sf0.01")
    found = {r["doc_id"]: r for r in frame.collect()}
    con = connect("/root/testdata/sf0.01")
    marked = con.execute(
        "select doc_id, toxic, regexp_matches(lower(text), '(idiot|moron|scum|stupid|loser)') from documents "
        "left join labels using (doc_id)"
    ).fetchall()
    held = [(toxic, plain, found[d]["predicted"]) for d, toxic, plain in marked if found[d]["held_out"]]
    assert all(p == 1 for toxic, plain, p in held if plain)
    assert all(p == 0 for toxic, plain, p in held if toxic == 0)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def marked_toxic(spark, size):
    """doc_id, language, label, whether a plain insult is in it, whether held out, and the prediction."""
    found = {r["doc_id"]: r for r in queries.op2_toxicity(spark, f"/root/testdata/{size}").collect()}
    marked = connect(f"/root/testdata/{size}").execute(
        "select doc_id, lang, toxic, regexp_matches(lower(text), '(idiot|moron|scum|stupid|loser)') from documents "
        "left join labels using (doc_id)"
    ).fetchall()
    return [(*row, found[row[0]]["held_out"], found[row[0]]["predicted"]) for row in marked]


def test_toxicity_of_insults_among_few_labels(spark):
    insults = [p for _, _, _, plain, _, p in marked_toxic(spark, "sf0.001") if plain]
    assert insults and all(insults)


@pytest.mark.parametrize(("size", "least"), [("sf0.01", {"en": 1.0}), ("sf0.1", {"en": 0.9, "de": 0.9, "fr": 0.9, "es": 0.8})])
def test_toxicity_recall_by_language(spark, size, least):
    held = [(lang, toxic, p) for _, lang, toxic, _, held_out, p in marked_toxic(spark, size) if held_out]
    for lang, share in least.items():
        hits = [p for of, toxic, p in held if toxic == 1 and of == lang]
        assert sum(hits) >= share * len(hits) > 0, lang
    clean = [p for _, toxic, p in held if toxic == 0]
    assert sum(clean) <= 0.01 * len(clean)
