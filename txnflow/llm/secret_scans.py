"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query of trigrams that any match must
hold. The index lists, per trigram that some rule asks for, the documents holding it in lower
case. Intersecting the postings gives each rule's candidate documents, and only these are
searched with the expression. A rule without mandatory trigrams searches every document.

Defined cases: a null text is empty and holds nothing. Rows that repeat a doc_id share
postings, which can only add candidates; each row is then searched by itself. Rows with a null
doc_id share postings only where their texts are equal. Texts are searched whole. Other input columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SecretRule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", 0, 18),
    SecretRule("hex", r"[0-9a-f]+", 0, 16),
)
MORE_RULES = (
    SecretRule("hosting", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    SecretRule("chat", r"xox[abp]-[A-Za-z0-9-]{10,}"),
    SecretRule("maps", r"AIza[A-Za-z0-9_-]{35,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Strings followed at once while a sequence is read; beyond it the sequence is cut there.
_MOST_STRINGS = 64

Query = list[frozenset[str]]


def _texts(node) -> set[str] | None:
    """The finite set of lower-case strings a parsed piece matches, or None."""
    op, value = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(value).lower()}
    if op == "IN" and all(str(kind) == "LITERAL" for kind, _ in value):
        return {chr(code).lower() for _, code in value}
    if op == "SUBPATTERN":
        return _sequence(value[-1])
    if op == "BRANCH":
        parts = [_sequence(part) for part in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and value[1] <= 2:
        inner = _sequence(value[2])
        if inner is not None:
            return {"".join(x) for n in range(value[0], value[1] + 1) for x in product(inner, repeat=n)}
    return None


def _sequence(nodes) -> set[str] | None:
    strings = {""}
    for node in nodes:
        texts = _texts(node)
        if texts is None or len(strings) * len(texts) > _MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in texts}
    return strings


def _clauses(nodes) -> list[Query]:
    """Alternatives of trigram sets; a match satisfies one alternative of every clause."""
    found: list[Query] = []
    strings = {""}

    def close() -> None:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if all(sets):
            found.append([x for x in sets if not any(y < x for y in sets)])

    for node in nodes:
        texts = _texts(node)
        if texts is not None and len(strings) * len(texts) <= _MOST_STRINGS:
            strings = {a + b for a in strings for b in texts}
            continue
        close()
        strings = texts if texts is not None and len(texts) <= _MOST_STRINGS else {""}
        if str(node[0]) == "SUBPATTERN":
            found.extend(_clauses(node[1][-1]))
        elif str(node[0]) == "MAX_REPEAT" and node[1][0] >= 1:
            found.extend(_clauses(node[1][2]))
    close()
    return found


def trigram_query(pattern: str) -> Query:
    """Alternative sets of trigrams, one of which every match holds whole; none: scan fully."""
    clauses = _clauses(re._parser.parse(pattern))
    if not clauses:
        return []
    joint = {frozenset().union(*chosen) for chosen in product(*clauses)}
    return sorted((x for x in joint if not any(y < x for y in joint)), key=sorted)


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id, _own) of the given trigrams in the lower-cased texts."""
    lowered = docs.select("doc_id", "_own", F.lower("text").alias("lowered"))
    held = F.array_compact(F.array(*(F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in trigrams)))
    return lowered.select("doc_id", "_own", F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """doc_id, _own and the kinds whose query its postings satisfy, by intersecting posting lists."""
    asked = [
        F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("alternative"), F.lit(len(wanted)).alias("wanted"))
        for kind, query in queries.items()
        for i, wanted in enumerate(query)
    ]
    users: dict[str, list[int]] = {}
    number = 0
    for query in queries.values():
        for wanted in query:
            for trigram in wanted:
                users.setdefault(trigram, []).append(number)
            number += 1
    # Each trigram names the alternatives it serves; a document's distinct trigrams are counted for each.
    serves = F.create_map(
        *(x for t, uses in users.items() for x in (F.lit(t), F.array(*(asked[u] for u in uses))))
    )
    return (
        postings.select("doc_id", "_own", "trigram", F.inline(serves[F.col("trigram")]))
        .groupBy("doc_id", "_own", "kind", "alternative", "wanted")
        .agg(F.count_distinct("trigram").alias("held"))
        .where("held = wanted")
        .groupBy("doc_id", "_own")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def match_spans(text: Column, rule: SecretRule) -> Column:
    """Array of (start, end, kind) in code points, end exclusive, of a rule's matches.

    Splitting at the matches and extracting them gives the lengths between which they lie.
    """
    pattern = rule.pattern
    if rule.group == 0 and rule.least > 1 and pattern.startswith("["):
        # A maximal run of one class: shorter runs need not be listed to be dropped.
        pattern = f"(?<!{pattern[:-1]}){pattern[:-1]}{{{rule.least},}}"
    lengths = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x)).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), lambda x: F.length(x)).alias("kept"),
    )
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    walked = F.aggregate(
        F.filter(lengths, lambda x: x["size"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(
                x["kept"] >= rule.least,
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + x["size"]).alias("end"),
                            F.lit(rule.kind).alias("kind"),
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return F.when(text.rlike(pattern), walked["spans"]).otherwise(empty)


def scan_secrets(
    docs: DataFrame, rules: tuple[SecretRule, ...] = RULES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, text and ``spans`` (start, end, kind; by start, then rule order) of every row.

    Columns named in ``keep`` go along.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if query}
    trigrams = sorted({t for query in indexed.values() for wanted in query for t in wanted})
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *keep)
    if indexed:
        # Rows without an id are told apart by their text, so they do not all meet in one task.
        rows = rows.withColumn("_own", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
        found = candidates(trigram_index(rows, trigrams), indexed).select(
            F.col("doc_id").alias("found_id"), F.col("_own").alias("found_own"), "kinds"
        )
        same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("_own") == F.col("found_own"))
        rows = rows.join(found.hint("shuffle_hash"), same, "left")
    empty = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    per_rule = []
    for rule in rules:
        spans = match_spans(F.col("text"), rule)
        if rule.kind in indexed:
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(empty)
        per_rule.append(spans)
    order = F.create_map(*(x for i, rule in enumerate(rules) for x in (F.lit(rule.kind), F.lit(i))))
    ranked = F.transform(
        F.concat(*per_rule),
        lambda s: F.struct(s["start"], order[s["kind"]].alias("rank"), s["end"], s["kind"]),
    )
    return rows.select(
        "doc_id", "text", *keep,
        F.transform(
            F.array_sort(ranked), lambda s: F.struct(s["start"], s["end"], s["kind"])
        ).alias("spans"),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch covered by spans replaced by one mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    walked = F.aggregate(
        spans,
        start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(
                    acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)
                ).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
    )
    rest = F.substring(text, walked["at"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(walked["out"], rest)).otherwise(text)
