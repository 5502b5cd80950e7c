"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps its measurements and one bit per
failed rule. A policy is a version name and a set of rules, so applying another version, or
asking what each rule alone removes, needs the ledger only and never the texts.

Defined cases: a null or empty text has no words and fails ``few_words``. Repeated rows each
get their own row. Texts of any length are handled whole, inside their own row. Windows are
compared by 64-bit hashes of their words' 64-bit hashes. Other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.text import WHITE, words_of

WINDOW = 8
_WHITE_CHARACTERS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRule:
    name: str
    bit: int
    fails: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


RULES = (
    QualityRule("few_words", 0, lambda: F.col("n_words") < 20),
    QualityRule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    QualityRule("symbols", 2, lambda: F.col("n_symbols") > F.col("n_words")),
    QualityRule("duplicate_lines", 3, lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    QualityRule(
        "word_length", 4,
        lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
    ),
)
BASE = Policy("base", ("few_words", "repeated_windows"))
CURRENT = Policy("v2", tuple(rule.name for rule in RULES))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def mask(policy: Policy, rules: tuple[QualityRule, ...] = RULES) -> int:
    bits = {rule.name: rule.bit for rule in rules}
    return sum(1 << bits[name] for name in policy.rules)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeated_words(frame: DataFrame) -> DataFrame:
    """Words covered by windows whose hash occurs twice or more in the row."""
    count = F.size("words")
    frame = frame.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    window = F.transform(
        F.sequence(F.lit(0), count - WINDOW),
        lambda i: F.xxhash64(*(F.get(F.col("hashes"), i + k) for k in range(WINDOW))),
    )
    frame = frame.withColumn("windows", F.when(count > WINDOW, window))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    frame = frame.withColumn("placed", F.when(repeats, placed))
    twice = F.transform(
        "placed",
        lambda x, i: F.when(
            (x["h"] == F.get(F.col("placed"), i - 1)["h"]) | (x["h"] == F.get(F.col("placed"), i + 1)["h"]), x["i"]
        ),
    )
    frame = frame.withColumn("at", F.when(F.col("placed").isNotNull(), F.array_sort(F.array_compact(twice))))
    covered = F.transform(
        "at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), i + 1) - p, F.lit(WINDOW)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b)
    return frame.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop(
        "hashes", "windows", "placed", "at"
    )


def quality_ledger(docs: DataFrame, rules: tuple[QualityRule, ...] = RULES) -> DataFrame:
    """doc_id, the measurements and ``failed_bits`` of every row; one narrow pass, no shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{WHITE}]"))
    frame = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        words_of(F.col("text")).alias("words"),
        lines.alias("lines"),
        F.length(_without(F.col("text"), _WHITE_CHARACTERS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), _SYMBOLS))).cast("long").alias("n_symbols"),
    )
    frame = _repeated_words(frame).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_repeat_words",
    )
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    # A filter on the ledger stays above the one-element ``inline``; pushed below it, into the
    # arrays' projections, it would compute every array again for each of its uses.
    return frame.select(F.inline(F.array(F.struct("doc_id", *MEASURES, bits.alias("failed_bits")))))


def fails_policy(policy: Policy, rules: tuple[QualityRule, ...] = RULES) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) != 0


def ablations(ledger: DataFrame, policy: Policy, rules: tuple[QualityRule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: documents failing it, and those that only it removes.

    One aggregate over the ledger; ``any_failed`` is the policy's bitwise union, the bits that
    occur at all.
    """
    within = F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long"))
    chosen = [rule for rule in rules if rule.name in policy.rules]
    sums = [F.count("*").alias("n_docs"), F.bit_or(within).alias("any_failed")]
    for rule in chosen:
        bit = F.lit(1 << rule.bit).cast("long")
        sums += [
            F.count_if(within.bitwiseAND(bit) != 0).alias(f"all_{rule.name}"),
            F.count_if(within == bit).alias(f"only_{rule.name}"),
        ]
    each = F.array(
        *(
            F.struct(
                F.lit(policy.version).alias("policy"), F.lit(rule.name).alias("rule"),
                F.col(f"all_{rule.name}").alias("n_failed"), F.col(f"only_{rule.name}").alias("n_only"),
            )
            for rule in chosen
        )
    )
    return ledger.agg(*sums).select("n_docs", "any_failed", F.inline(each))
