"""Small document tables that every operator of the texts must stand."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    def build(texts, lang="en"):
        rows = [(i, t, lang, "s", len(t or "")) for i, t in texts]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture
def awkward(documents):
    """Nulls, empty texts, white space only, a repeated row, a tie, a null id and a very long text."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    return documents(
        [
            (1, None), (2, ""), (3, " \t\n"), (4, "same words here again and again"),
            (4, "same words here again and again"), (5, "same words here again and again"),
            (None, "a row without an id has words as well"), (6, long_text), (7, "naïve Größe ▁ € 𝔘 x"),
        ]
    )


@pytest.fixture
def odd_columns(awkward):
    """The same rows with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = (
        "words", "spans", "kinds", "found_id", "doc", "key", "known", "part", "bucket", "fp", "node", "root", "n", "k",
        "host", "score", "terms", "counts", "shared", "removed", "hashes", "windows", "placed", "at", "lines",
    )
    return awkward.select("*", *(F.lit("x").alias(n) for n in names))
