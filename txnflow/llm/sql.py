"""The text operators' queries as SQL over the driver's tables, where SQL can express them."""

from __future__ import annotations

from txnflow.llm.secret_scans import BASE_RULES, RULES, SecretRule
from txnflow.llm.url_filters import SUFFIXES

_WORDS = r"[^\x20\x09-\x0D]+"


def _secret_spans(rule: SecretRule, rank: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    kind = f"select doc_id, '{rule.kind}' as kind, {rank} as rank"
    return f"""
{rule.kind}_parts as (
    select doc_id,
           list_transform(regexp_split_to_array(text, '{pattern}'), lambda x: length(x)) as gap,
           list_transform(regexp_extract_all(text, '{pattern}', 0), lambda x: length(x)) as sizes,
           list_transform(regexp_extract_all(text, '{pattern}', {rule.group}), lambda x: length(x)) as kept
    from d where regexp_matches(text, '{pattern}')
),
{rule.kind}_spans as (
    {kind}, before + gap[i] as "start", before + gap[i] + sizes[i] as "end"
    from (
        select doc_id, gap, sizes, kept, i,
               coalesce(list_sum(gap[1:i-1]), 0) + coalesce(list_sum(sizes[1:i-1]), 0) as before
        from {rule.kind}_parts, unnest(range(1, len(sizes) + 1)) as t(i)
    ) where kept[i] >= {rule.least}
)"""


def _op9() -> str:
    parts = ",".join(_secret_spans(rule, i) for i, rule in enumerate(RULES))
    union = " union all ".join(f"select * from {rule.kind}_spans" for rule in RULES)
    base = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
    shown = """string_agg(kind || ':' || cast("start" as bigint) || ':' || cast("end" as bigint), ',' order by "start", rank)"""
    counts = ", ".join(f"count(*) filter (where kind = '{r.kind}') as n_{r.kind}" for r in BASE_RULES)
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE_RULES)
    return f"""
with d as (select doc_id, coalesce(text, '') as text from documents), {parts},
spans as ({union}),
found as (
    select doc_id, {counts}, {shown} filter (where kind in ({base})) as base, {shown} as spans
    from spans group by doc_id
)
select doc_id, {zeros}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join found using (doc_id)"""


_OP4 = r"""
with located as (
    select page_id,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path
    from pages
),
outcome as (
    select page_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
    from (select page_id, try_cast(regexp_extract(path, '/([0-9]{1,18})(?:\.html|/)?$', 1) as bigint) as doc_id
          from located)
    join labels using (doc_id) group by page_id
),
h0 as (
    select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as k
    from located left join outcome using (page_id) group by host
),
h as (
    select host, n, k, case when address then name
                            when two in ($suffixes) then array_to_string(list_slice(labels, -3, -1), '.')
                            else two end as domain,
           case when address then name when two in ($suffixes) then two else labels[-1] end as suffix
    from (
        select *, string_split(name, '.') as labels, array_to_string(list_slice(string_split(name, '.'), -2, -1), '.') as two,
               starts_with(name, '[') or regexp_matches(name, '^[0-9]+(\.[0-9]+){3}$') as address
        from (select *, case when starts_with(host, '[') then split_part(host, ']', 1) || ']'
                             else split_part(host, ':', 1) end as name from h0)
    )
),
overall as (select (sum(k) + 1) / (sum(n) + 2)::double as m from h0),
s as (select suffix, sum(n) as n, sum(k) as k from h group by suffix),
s_fit as (
    select sum((k - n * m) * (k - n * m)) as spread, sum(n * m * (1 - m)) as chance,
           sum(n * (n - 1) * m * (1 - m)) as pairs from s, overall
),
s_strength as (
    select case when coalesce(pairs, 0) = 0 then 4.0::double when spread <= chance then 1000.0::double
                else least(greatest(1 / ((spread - chance) / pairs) - 1, 4), 1000) end as w from s_fit
),
s_mean as (select suffix, (k + w * m) / (n + w) as m from s, overall, s_strength),
d as (select suffix, domain, sum(n) as n, sum(k) as k from h group by suffix, domain),
d_fit as (
    select sum((k - n * m) * (k - n * m)) as spread, sum(n * m * (1 - m)) as chance,
           sum(n * (n - 1) * m * (1 - m)) as pairs from d join s_mean using (suffix)
),
d_strength as (
    select case when coalesce(pairs, 0) = 0 then 4.0::double when spread <= chance then 1000.0::double
                else least(greatest(1 / ((spread - chance) / pairs) - 1, 4), 1000) end as w from d_fit
),
d_mean as (select domain, (k + w * m) / (n + w) as m from d join s_mean using (suffix), d_strength),
h_fit as (
    select sum((k - n * m) * (k - n * m)) as spread, sum(n * m * (1 - m)) as chance,
           sum(n * (n - 1) * m * (1 - m)) as pairs from h join d_mean using (domain)
),
h_strength as (
    select case when coalesce(pairs, 0) = 0 then 4.0::double when spread <= chance then 1000.0::double
                else least(greatest(1 / ((spread - chance) / pairs) - 1, 4), 1000) end as w from h_fit
),
h_mean as (select host, n, k, w, (k + w * m) / (n + w) as mean from h join d_mean using (domain), h_strength),
judged as (
    select host, n, k, mean, greatest(mean - 1.645 * sqrt(mean * (1 - mean) / (n + w + 1)), 0) as bound from h_mean
),
rules as (
    select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) t(rule_host, rule_path, v)
),
fitted as (
    select host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
           arg_max(v, length(rule_host || rule_path)) as v
    from (select distinct host, path from located)
    join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by host, path
)
select page_id, host, path, rule,
       coalesce(v, case when bound > 0.5 then 'block' else 'allow' end) as verdict,
       n as n_labelled, k as n_bad, round(mean, 6) as bad_share, round(bound, 6) as bad_bound
from located join judged using (host) left join fitted using (host, path)"""


def _op4() -> str:
    return _OP4.replace("$suffixes", ", ".join(f"'{suffix}'" for suffix in SUFFIXES))


_OP10 = rf"""
with d as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '{_WORDS}') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) as lines
    from documents
),
w as (
    select doc_id, i, array_to_string(words[i:i+7], ' ') as win
    from d, unnest(range(1, len(words) - 6)) as t(i)
),
starts as (select doc_id, i from (select *, count(*) over (partition by doc_id, win) as c from w) where c > 1),
covered as (
    select doc_id, sum(least(8, coalesce(following - i, 8))) as n
    from (select doc_id, i, lead(i) over (partition by doc_id order by i) as following from starts)
    group by doc_id
),
m as (
    select doc_id, len(words)::bigint as n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
           len(lines)::bigint as n_lines,
           coalesce(covered.n, 0)::bigint as n_repeat_words
    from d left join covered using (doc_id)
),
b as (
    select *, n_words < 20 as b0, 100 * n_repeat_words > 30 * n_words as b1, n_symbols > n_words as b2,
           2 * n_dup_lines > n_lines as b3, word_chars < 2 * n_words or word_chars > 20 * n_words as b4
    from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 or b1 as base_failed,
       not (b0 or b1 or b2 or b3 or b4) as kept,
       (b0::int + 2 * b1::int + 4 * b2::int + 8 * b3::int + 16 * b4::int)::bigint as failed_bits, n_lines
from b"""


_ABLATED = ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length")

_ABLATIONS = f"""
with ledger as ({_OP10}),
each as (
    select 'v2' as policy, rule, bit, failed_bits
    from ledger, (values {", ".join(f"('{name}', {1 << bit})" for bit, name in enumerate(_ABLATED))}) r(rule, bit)
)
select count(*) as n_docs, bit_or(failed_bits) as any_failed, policy, rule,
       count(*) filter (where failed_bits & bit <> 0) as n_failed, count(*) filter (where failed_bits = bit) as n_only
from each group by policy, rule"""


_LISTED = rf"""
d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') as words from documents),
t as (select doc_id, i, words[i] as w, words[i - 1] as v from d, unnest(range(1, len(words) + 1)) as t(i))"""

_OP1 = f"""
with {_LISTED},
c1 as (select w, count(*) as n from t group by w),
c2 as (select v, w, count(*) as n from t where i > 1 group by v, w),
scored as (
    select t.doc_id, i > 1 and c2.n < 2 as lower,
           case when i > 1 and c2.n >= 2 then ln(c2.n / before.n)
                else ln(c1.n / (select count(*) from t)) + case when i > 1 then ln(0.4) else 0 end end as score
    from t join c1 using (w) left join c2 on t.v = c2.v and t.w = c2.w and t.i > 1
    left join c1 as before on before.w = t.v
)
select doc_id, len(words)::bigint as n_words, coalesce(n_backoff, 0)::bigint as n_backoff,
       round(coalesce(score, 0), 4)::double as log_score
from d left join (
    select doc_id, sum(lower::int) as n_backoff, sum(score) as score from scored group by doc_id
) using (doc_id)"""

_LM3 = f"""
with {_LISTED},
p as (select t.*, before.v as u from t left join t as before on before.doc_id = t.doc_id and before.i = t.i - 1),
c1 as (select w, count(*) as n from p group by w),
c2 as (select v, w, count(*) as n from p where i > 1 group by v, w),
c3 as (select u, v, w, count(*) as n from p where i > 2 group by u, v, w),
two as (
    select p.*, c2.n as n2, case when i > 1 and c2.n >= 2 then ln(c2.n / before.n)
                                 else ln(c1.n / (select count(*) from p)) + case when i > 1 then ln(0.4) else 0 end end as score
    from p join c1 using (w) left join c2 on p.v = c2.v and p.w = c2.w and p.i > 1 left join c1 as before on before.w = p.v
),
scored as (
    select two.doc_id, case when i > 2 then c3.n < 2 else i > 1 and n2 < 2 end as lower,
           case when i > 2 and c3.n >= 2 then ln(c3.n / before.n) when i > 2 then ln(0.4) + score else score end as score
    from two left join c3 on two.u = c3.u and two.v = c3.v and two.w = c3.w and two.i > 2
    left join c2 as before on before.v = two.u and before.w = two.v and two.i > 2
)
select doc_id, len(words)::bigint as n_words, coalesce(n_backoff, 0)::bigint as n_backoff,
       round(coalesce(score, 0), 4)::double as log_score
from d left join (
    select doc_id, sum(lower::int) as n_backoff, sum(score) as score from scored group by doc_id
) using (doc_id)"""

_OP7 = f"""
with {_LISTED},
windows as (
    select doc_id, i, array_to_string(words[i:i+12], ' ') as win from d, unnest(range(1, len(words) - 11)) as t(i)
),
starts as (
    select doc_id, i from (select *, min(doc_id) over (partition by win) as least from windows) where least < doc_id
),
gone as (select distinct doc_id, j as i from starts, unnest(range(i, i + 13)) as u(j)),
kept as (
    select doc_id, string_agg(w, ' ' order by i) as words from t anti join gone using (doc_id, i) group by doc_id
),
lost as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, len(d.words)::bigint as n_words, coalesce(lost.n, 0)::bigint as n_removed,
       sha256(coalesce(kept.words, '')) as kept_sha256
from d left join kept using (doc_id) left join lost using (doc_id)"""


_OP11 = """
with e as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_inner_product(a.q, c.q)::bigint as score
    from e a join e c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id
),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10"""


_OP12 = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept,
       sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# CRC-32, a byte at a time from the usual table of its reversed polynomial.
_OP13 = f"""
with recursive crc_table(byte, x, k) as (
    select b, b::ubigint, 0 from range(256) t(b)
    union all
    select byte, case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end, k + 1
    from crc_table where k < 8
),
crc_of as (select list(x order by byte) as table_ from crc_table where k = 8),
leaves as (
    select doc_id, coalesce('=' || lang, '') as grp, {_leaf("n_chars")} as leaf, {_leaf("(n_chars + 1)")} as longer,
           xor(list_reduce(
               list_prepend(4294967295::ubigint,
                            list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::ubigint)),
               lambda x, c: xor(table_[1 + (xor(x, c) & 255)::int], x >> 8)), 4294967295::ubigint) % 7 = 0 as tampered
    from documents, crc_of
),
placed as (select *, row_number() over (partition by grp order by doc_id nulls first) - 1 as place from leaves),
tree(grp, level, place, hash, n) as (
    select grp, 0, place, leaf, count(*) over (partition by grp) from placed
    union all
    select grp, level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (any_value(n) + 1) // 2
    from tree where n > 1 group by grp, level, place // 2
),
subroots as (
    select grp, hash as subroot, row_number() over (order by grp) - 1 as place, count(*) over () as n
    from tree where n = 1
),
top(level, place, hash, n) as (
    select 0, place, subroot, n from subroots
    union all
    select level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (any_value(n) + 1) // 2
    from top where n > 1 group by level, place // 2
),
walk(doc_id, grp, row, level, place, n, acc, proof) as (
    select doc_id, grp, place, 0, place, count(*) over (partition by grp),
           case when tampered then longer else leaf end, ''
    from placed
    union all
    select doc_id, w.grp, row, w.level + 1, w.place // 2, (w.n + 1) // 2,
           sha256(case when w.place % 2 = 1 then t.hash || acc else acc || coalesce(t.hash, '') end),
           proof || coalesce(t.hash, '')
    from walk w left join tree t on t.grp = w.grp and t.level = w.level and t.place = xor(w.place, 1)
    where w.n > 1
),
climb(doc_id, grp, row, level, place, n, acc, proof) as (
    select doc_id, grp, row, 0, s.place, s.n, acc, proof from walk join subroots s using (grp) where walk.n = 1
    union all
    select doc_id, grp, row, c.level + 1, c.place // 2, (c.n + 1) // 2,
           sha256(case when c.place % 2 = 1 then t.hash || acc else acc || coalesce(t.hash, '') end),
           proof || coalesce(t.hash, '')
    from climb c left join top t on t.level = c.level and t.place = xor(c.place, 1)
    where c.n > 1
),
root as (select hash as root from top where n = 1)
select p.doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, acc as folded_root, acc = root as verified
from climb join placed p on climb.grp = p.grp and climb.row = p.place join subroots s on s.grp = p.grp, root
where climb.n = 1"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_lm_scoring": _OP1, "lm_scoring_order3": _LM3, "op7_substring_dedup": _OP7, "op4_url_filters": _op4(),
        "op9_secret_scans": _op9(), "op10_quality_rules": _OP10, "quality_ablations": _ABLATIONS,
        "op11_hard_negatives": _OP11, "op12_exact_dedup": _OP12, "op13_merkle_manifest": _OP13,
    }
