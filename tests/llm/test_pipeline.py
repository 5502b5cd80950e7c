"""The pipeline's stages, each against what its operator says, and the whole run."""

import corpus_pipeline as C
import pytest
from brute import components, contaminated, fingerprint
from pyspark.sql import functions as F

from txnflow.llm import toxicity
from txnflow.llm.queries import table
from txnflow.llm.text import fold

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    return table(spark, SF, "documents")


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages():
    assert [name for name, _ in C.STAGES] == ["toxicity", "near-dedup", "decontamination", "secrets", "encoding"]


def test_toxic_documents_go(spark, docs):
    labels = table(spark, SF, "labels").where(fold(F.col("doc_id"), 5) != 0)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    left = C.toxicity_stage(spark, docs, SF)
    assert tuple(left.columns) == C.COLUMNS
    assert ids(left) == sorted(d for d, s in scores.items() if s < 0.5)


def test_one_document_of_each_group_stays(spark, docs):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    label = components({d: fingerprint(t) for d, t in texts}, lambda a, b: (a ^ b).bit_count() <= 2)
    left = C.near_dedup_stage(spark, docs.unionByName(docs), SF)
    assert tuple(left.columns) == C.COLUMNS
    assert ids(left) == sorted(set(label.values()))


def test_null_and_repeated_ids_are_judged_by_their_component(spark, documents):
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(40)) for c in "pqrs")
    docs = documents([(1, one), (1, two), (None, two), (None, three), (None, three), (2, four), (None, four)])
    left = [(r["doc_id"], r["text"]) for r in C.near_dedup_stage(spark, docs, SF).collect()]
    assert sorted(left, key=lambda r: r[1]) == [(1, one), (1, two), (None, three), (2, four)]


def test_contaminated_documents_go(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"]) < 2500][:60]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    bad = {d for d, _ in contaminated(rows, items)}
    chosen = docs.where(F.col("doc_id").isin([d for d, _ in rows]))
    assert ids(C.decontamination_stage(spark, chosen, SF)) == sorted({d for d, _ in rows} - bad)


def test_secrets_are_masked(spark, documents):
    docs = documents([(1, "x token=abcdefghijklmnop y"), (2, "clean"), (3, None)])
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in C.secrets_stage(spark, docs, SF).collect()}
    assert left == {1: ("x [secret] y", 12), 2: ("clean", 5), 3: ("", 0)}


def test_empty_and_awkward_documents(spark, documents, odd_columns):
    for name, stage in C.STAGES:
        assert stage(spark, documents([]), SF).collect() == [], name
        left = stage(spark, odd_columns, SF).collect()
        want = {"near-dedup": [1, 4, 6, 7, 99]}.get(name, [1, 2, 3, 4, 4, 5, 6, 7, 99])
        assert sorted(99 if r["doc_id"] is None else r["doc_id"] for r in left) == want, name


def test_run(spark, docs):
    encoded = C.run(spark, SF).collect()
    assert all(r["round_trip"] for r in encoded)
    step = docs
    for _, stage in C.STAGES[:-1]:
        step = stage(spark, step, SF)
    assert sorted(r["doc_id"] for r in encoded) == ids(step)
