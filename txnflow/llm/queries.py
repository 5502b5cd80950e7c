"""The registered queries of the text operators. Each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm import (
    decontamination,
    exact_dedup,
    hard_negatives,
    language_id,
    lm_scoring,
    merkle_manifest,
    quality_rules,
    secret_scans,
    sentencepiece_codec,
    simhash_dedup,
    substring_dedup,
    toxicity,
    url_filters,
)
from txnflow.llm.text import fold
from txnflow.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]

#: The model whose pieces encode the documents.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
URL_RULES = (
    url_filters.UrlRule("net/", url_filters.BLOCK),
    url_filters.UrlRule("example.net/en/", url_filters.ALLOW),
    url_filters.UrlRule("example.com/de/", url_filters.BLOCK),
    url_filters.UrlRule("org/fr/", url_filters.ALLOW),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """A page's URL ends its path with the number of its document, whose label is the outcome."""
    number = F.regexp_extract(url_filters.url_path(F.col("url")), r"/([0-9]{1,18})(?:\.html|/)?$", 1)
    pages = pages.select("page_id", F.when(number != "", number).cast("long").alias("doc_id"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    return pages.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("page_id", "bad")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.score_documents(table(spark, sf_dir, "documents"))
    return scored.withColumn("log_score", F.round("log_score", 4))


def lm_scoring_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two levels of backoff, from three words to one."""
    params = lm_scoring.LanguageModelParams(order=3)
    scored = lm_scoring.score_documents(table(spark, sf_dir, "documents"), params)
    return scored.withColumn("log_score", F.round("log_score", 4))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "evidence",
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(documents.where(fold(F.col("doc_id"), 4) != 2))
    found = language_id.predict_language(documents, profiles)
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")), URL_RULES)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_components(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_codec.load_pieces(PIECES)
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), pieces)


def _count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [rule.kind for rule in secret_scans.BASE_RULES]
    spans = F.col("spans")
    found = secret_scans.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(_count_kind(spans, kind).alias(f"n_{kind}") for kind in base),
        F.sha2(secret_scans.spans_text(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        secret_scans.spans_text(spans).alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules
    ledger = q.quality_ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        q.fails_policy(q.BASE).alias("base_failed"),
        (~(q.fails_policy(q.BASE) | q.fails_policy(q.CURRENT))).alias("kept"),
        "failed_bits", "n_lines",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides vec_id the label moves on by one, as the contract of the query has it."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, work_folder(spark, "digests"))
    index.insert(table(spark, sf_dir, "documents"))
    return index.groups()


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 7 divides the CRC-32 of doc_id, the audited copy counts one character more."""
    # Wider than a long, so that the largest number of characters can be added to.
    more = merkle_manifest.leaf(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1)
    claimed = F.when(fold(F.col("doc_id"), 7) == 0, more)
    return merkle_manifest.audit(merkle_manifest.build_manifest(table(spark, sf_dir, "documents"), claimed=claimed))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy removes, and removes alone."""
    q = quality_rules
    return q.ablations(q.quality_ledger(table(spark, sf_dir, "documents")), q.CURRENT)


def registered() -> dict[str, Query]:
    listed = (
        op1_lm_scoring, op2_toxicity, op3_language_id, op4_url_filters, op5_decontamination,
        op6_simhash_dedup, op7_substring_dedup, op8_sentencepiece, op9_secret_scans, op10_quality_rules,
        op11_hard_negatives, op12_exact_dedup, op13_merkle_manifest, quality_ablations,
        lm_scoring_order3,
    )
    return {fn.__name__: fn for fn in listed}
