"""The registered queries as SQL over the driver's tables, for comparison."""

from __future__ import annotations

from txnflow import schemas as S
from txnflow.functions import picks
from txnflow.plans import inputs


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_CUSTOMERS = """
customers as (
    select c_custkey as customer_id, c_name as customer_name, r_name as customer_country,
           n_name as customer_city, c_mktsegment as segment
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""
_MERCHANTS = f"""
merchants as (
    select p_partkey as merchant_id, p_name as merchant_name, p_type as category, p_brand as brand
    from part where p_size <= {inputs.LARGEST_MERCHANT_SIZE}
)"""
_ALL_MERCHANTS = _MERCHANTS.replace(f" where p_size <= {inputs.LARGEST_MERCHANT_SIZE}", "")
_TX = f"""{_CUSTOMERS}, {_MERCHANTS},
tx as (
    select event_id as transaction_id, user_id as customer_id,
           cast(json_extract_string(props, '$.k') as bigint) as merchant_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') as transaction_date,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as transaction_date_iso,
           ts, value as amount,
           {_list(inputs.CURRENCIES)}[event_id % 5 + 1] as currency,
           customer_country as transaction_country, customer_city as transaction_city,
           {_list(inputs.PAYMENTS)}[user_id % 5 + 1] as payment_method,
           case event_type when 'purchase' then 'approved' when 'error' then 'declined' else 'pending' end as status,
           {_list(inputs.DEVICES)}[event_id % 4 + 1] as device_type,
           'event ' || event_type as description,
           event_id % 3 as partition, event_id // 3 as "offset"
    from events join customers on user_id = customer_id
)"""
_ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"
_MONEY = "cast(sum(cast({} as decimal(18, 2))) as double)"


def _stats(interval: str, source: str = "tx") -> str:
    return f"""
stats as (
    select category, transaction_country as country, time_bucket(interval '{interval}', ts, timestamp '1970-01-01') as window_start,
           {_MONEY.format('amount')} as total_amount, count(*) as txn_count
    from {source} join merchants using (merchant_id)
    where status = 'approved' and category is not null
    group by all
)"""


def _stats_query(interval: str, source: str = "tx", more: str = "") -> str:
    return f"""with {_TX}{more}, {_stats(interval, source)}
select category, country, strftime(window_start, {_ISO}) as window_start_iso,
       strftime(window_start + interval '{interval}', {_ISO}) as window_end_iso, total_amount, txn_count
from stats"""


_TWO_BATCHES = """
log as (
    select 0 as batch_id, transaction_id, customer_id, merchant_id, amount, currency, status, transaction_date_iso
    from tx where status = 'approved'
    union all
    select 1, transaction_id, customer_id + 1, merchant_id + 1, amount + 1000, 'JPY', status, transaction_date_iso
    from tx
)"""

_PARSED_COLUMNS = ", ".join(S.TRANSACTION_COLUMNS)
_PROJECTED = "transaction_id, customer_id, merchant_id, amount, currency, status, transaction_date_iso"

_ARRIVAL_BOUNDS = f"""
bounds as (select min(ts) as low, max(ts) as high from events),
edges as (
    select i, low + to_microseconds(cast(floor(i * datediff('microsecond', low, high) / {inputs.ARRIVALS}) as bigint)) as edge
    from bounds, range({inputs.ARRIVALS}) r(i)
)"""


def _draw(seed: int, salt: int, key: str = "id") -> str:
    m = picks.MODULUS
    x = (f"((({key} % {m}) * {picks.FIRST_MULTIPLIER} + (({key} // {m}) % {m}) * {picks.HIGH_MULTIPLIER}"
         f" + {seed + salt * picks.SALT_STEP}) % {m})")
    x = f"xor({x}, {x} >> 15)"
    x = f"(({x} * {picks.SECOND_MULTIPLIER} + {salt}) % {m})"
    return f"(xor({x}, {x} >> 13) % {m})"


def _pick(pool, drawn: str) -> str:
    return f"{_list(pool)}[{drawn} % {len(pool)} + 1]"


def _between(low: int, high: int, drawn: str) -> str:
    return f"({drawn} % {high - low + 1} + {low})"


def _generators() -> dict[str, str]:
    c, m, t = S.CUSTOMER_SEED_NUMBER, S.MERCHANT_SEED_NUMBER, 0
    return {
        "gen_customers": f"""
            with ids as (select c_custkey + 1 as id from customer)
            select id as customer_id, '{S.CUSTOMER_NAME_PREFIX}' || id as customer_name,
                   '{S.CUSTOMER_EMAIL_PREFIX}' || id || '{S.CUSTOMER_EMAIL_SUFFIX}' as email,
                   {_pick(S.COUNTRIES, _draw(c, 2))} as customer_country,
                   {_pick(S.CITIES, _draw(c, 3))} as customer_city,
                   cast({_between(*S.AGE_RANGE, _draw(c, 4))} as integer) as age,
                   strftime(date '{S.FIRST_REGISTRATION}'
                       + cast({_between(0, S.REGISTRATION_SPAN_DAYS, _draw(c, 1))} as integer), '%Y-%m-%d') as registration_date
            from ids""",
        "gen_merchants": f"""
            with ids as (select p_partkey + 1 as id from part)
            select id as merchant_id, '{S.MERCHANT_NAME_PREFIX}' || id as merchant_name,
                   {_pick(S.CATEGORIES, _draw(m, 1))} as category,
                   {_pick(S.COUNTRIES, _draw(m, 2))} as merchant_country,
                   {_pick(S.CITIES, _draw(m, 3))} as merchant_city
            from ids""",
        "gen_transactions": f"""
            with ids as (select event_id + 1 as id, ts from events)
            select id as transaction_id,
                   {_between(1, S.DEFAULT_CUSTOMERS, _draw(t, 1))} as customer_id,
                   {_between(1, S.DEFAULT_MERCHANTS, _draw(t, 2))} as merchant_id,
                   case when date_trunc('second', ts) = ts then strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
                        else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') end as transaction_date,
                   {_between(*S.AMOUNT_CENTS_RANGE, _draw(t, 3))} / 100.0::double as amount,
                   {_pick(S.CURRENCIES, _draw(t, 4))} as currency,
                   {_pick(S.COUNTRIES, _draw(t, 5))} as transaction_country,
                   {_pick(S.CITIES, _draw(t, 6))} as transaction_city,
                   {_pick(S.PAYMENT_METHODS, _draw(t, 7))} as payment_method,
                   {_pick(S.STATUSES, _draw(t, 8))} as status,
                   {_pick(S.DEVICE_TYPES, _draw(t, 9))} as device_type,
                   '{S.DESCRIPTION_PREFIX}' || id || '{S.DESCRIPTION_SUFFIX}' as description
            from ids""",
    }


def oracle_sql() -> dict[str, str]:
    hour = _stats_query("1 hour")
    approved_rows = f"with {_TX} select {_PROJECTED} from tx where status = 'approved'"
    transactions_now = (
        f"with {_TX} select transaction_id, amount, currency, status, transaction_date_iso "
        "from tx where status = 'approved'"
    )
    late = f""", {_ARRIVAL_BOUNDS},
placed as (
    select tx.*, (select count(*) - 1 from edges where edge <= tx.ts) as slice,
           currency = 'EUR' as delayed
    from tx
),
arriving as (
    select *, least(case when delayed then slice + 1 else slice end, {inputs.ARRIVALS - 1}) as arrival from placed
),
marks as (
    select arrival, max(ts) - interval '1 minute' as mark from arriving where status = 'approved' group by arrival
),
kept as (
    select * from arriving a
    where not exists (
        select 1 from marks
        where marks.arrival < a.arrival
          and time_bucket(interval '1 hour', a.ts, timestamp '1970-01-01') + interval '1 hour' <= date_trunc('millisecond', marks.mark)
    )
)"""
    high_water = f"""with {_TX}
            select cast(sum(m) as bigint) as hwm from (select max("offset") + 1 as m from tx group by partition)"""
    newest = f"""with {_TX}
            select transaction_id, status, amount from tx order by ts desc, partition desc, "offset" desc limit 15"""
    details = f"""with {_TX}, first_paths as (
                select * from tx order by customer_id, transaction_id, merchant_id limit 25)
            select p.customer_id, customer_name, transaction_id, p.amount as made_amount, p.amount, p.status,
                   p.transaction_date_iso, p.merchant_id, merchant_name, category
            from first_paths p join customers c using (customer_id)
            left join (select p_partkey as merchant_id, p_name as merchant_name, p_type as category from part) m
            using (merchant_id)"""
    best = f"""with {_TX}
            select customer_id, customer_name as name, count(*) as approved_count
            from tx join customers using (customer_id) where status = 'approved'
            group by all order by approved_count desc, customer_id limit 1"""
    live = f"""with {_TX}, {_ARRIVAL_BOUNDS},
seen as (
    select tx.*, p_type, p_brand, p_size, (select count(*) - 1 from edges where edge <= tx.ts) as arrival
    from tx join part on merchant_id = p_partkey where status = 'approved'
),
known as (
    select *, case when arrival >= {inputs.ARRIVALS // 2} and p_brand = '{inputs.RECLASSED_BRAND}' then 'RECLASSED'
                   else p_type end as kind
    from seen where p_size <= case when arrival >= {inputs.ARRIVALS // 2} then {inputs.LARGEST_MERCHANT_SIZE}
                              else {inputs.SMALL_MERCHANT_SIZE} end
)
select kind as category, transaction_country as country,
       strftime(time_bucket(interval '1 hour', ts, timestamp '1970-01-01'), {_ISO}) as window_start_iso,
       strftime(time_bucket(interval '1 hour', ts, timestamp '1970-01-01') + interval '1 hour', {_ISO}) as window_end_iso,
       {_MONEY.format('amount')} as total_amount, count(*) as txn_count
from known group by all"""
    return {
        **_generators(),
        "encode_messages": f"with {_TX} select cast(transaction_id as varchar) as key, transaction_id, amount, status from tx",
        "stream_ingest": f"""with {_TX} select cast(transaction_id as varchar) as key, cast(partition as integer) as partition, "offset" from tx""",
        "parse_transactions": f"with {_TX} select {_PARSED_COLUMNS}, transaction_date_iso from tx",
        "parse_event_time": f"with {_TX} select transaction_id, epoch_us(ts) as event_micros from tx",
        "format_iso": f"with {_TX} select transaction_id, transaction_date_iso, transaction_date as transaction_date_micros from tx",
        "filter_approved": f"with {_TX} select {_PARSED_COLUMNS} from tx where status = 'approved'",
        "project_transaction": f"with {_TX} select {_PROJECTED}, cast(null as varchar) as merchant_category from tx",
        "dedup_transactions": f"with {_TX} select {_PROJECTED} from tx",
        "merchant_dim": f"with {_ALL_MERCHANTS} select merchant_id, category from merchants",
        "enrich_merchant": f"with {_TX} select transaction_id, merchant_id, category from tx left join merchants using (merchant_id)",
        "enrich_merchant_salted": f"with {_TX} select transaction_id, merchant_id, category from tx left join merchants using (merchant_id)",
        "category_stats": hour,
        "category_stats_1m": _stats_query("1 minute"),
        "category_stats_1d": _stats_query("1 day"),
        "category_stats_large_dim": hour,
        "stream_category_stats": hour,
        "category_stats_pipeline": hour,
        "category_stats_compacted": hour,
        "live_dimension_stats": live,
        "live_dimension_compacted": live,
        "late_data_trace": _stats_query("1 hour", "kept", late),
        "raw_graph_pipeline": transactions_now,
        "raw_graph_compacted": transactions_now,
        "raw_graph_two_runs": f"with {_TX} select transaction_id, amount, currency, status, transaction_date_iso from tx",
        "upsert_customer_stub": f"with {_TX}, {_TWO_BATCHES} select distinct customer_id from log",
        "upsert_merchant_stub": f"with {_TX}, {_TWO_BATCHES} select distinct merchant_id, cast(null as varchar) as category from log",
        "upsert_transaction": f"""with {_TX}, {_TWO_BATCHES}
            select transaction_id, amount, currency, status, transaction_date_iso from log
            qualify row_number() over (partition by transaction_id order by batch_id) = 1""",
        "edge_made": f"""with {_TX}, {_TWO_BATCHES}
            select customer_id, transaction_id, amount, currency, transaction_date_iso as timestamp_iso from log
            qualify row_number() over (partition by customer_id, transaction_id order by batch_id) = 1""",
        "edge_at": f"with {_TX}, {_TWO_BATCHES} select distinct transaction_id, merchant_id from log",
        "upsert_customers": f"""with {_CUSTOMERS}
            select customer_id, customer_name, 'c' || customer_id || '@example.com' as email,
                   case when segment = 'BUILDING' then upper(customer_city) || '!' else customer_city end as customer_city,
                   case when segment = 'BUILDING' then null else customer_country end as customer_country,
                   cast(18 + customer_id % 63 as integer) as age,
                   strftime(date '2018-01-01' + cast(customer_id % 2191 as integer), '%Y-%m-%d') as registration_date_text
            from customers""",
        "upsert_merchants": f"""with {_ALL_MERCHANTS}
            select merchant_id, merchant_name, case when brand = 'Brand#1' then 'RECLASSED' else category end as category,
                   brand as merchant_country
            from merchants""",
        "duplicate_key_check": f"""with {_TX}, {_stats('1 hour')}
            select 'Transaction' as label, cast(transaction_id as varchar) as key, count(*) as cnt
            from (select transaction_id from tx union all select transaction_id from tx where status = 'approved')
            group by transaction_id having count(*) > 1
            union all
            select 'Customer', cast(customer_id as varchar), count(*)
            from (select customer_id from customers union all select customer_id from customers where segment = 'BUILDING')
            group by customer_id having count(*) > 1
            union all
            select 'Merchant', cast(merchant_id as varchar), count(*)
            from (select p_partkey as merchant_id from part) group by merchant_id having count(*) > 1
            union all
            select 'CategoryStats',
                   cast(to_json([category, country, strftime(window_start, '%Y-%m-%d %H:%M:%S')]) as varchar), count(*)
            from (select * from stats union all select * from stats where country = 'ASIA')
            group by category, country, window_start having count(*) > 1""",
        "two_maker_check": f"""with {_TX}, {_TWO_BATCHES}
            select 'MADE' as label, cast(transaction_id as varchar) as key, count(distinct customer_id) as cnt
            from log group by transaction_id having count(distinct customer_id) > 1""",
        "continuous_key_check": f"""with {_TX}, {_TWO_BATCHES}
            select cast(1 as bigint) as check_number, 'Transaction' as label, 'batch' as rule,
                   cast(transaction_id as varchar) as key, count(*) as cnt
            from (select transaction_id from log where batch_id = 1
                  union all select transaction_id from tx where status = 'declined')
            group by transaction_id having count(*) > 1
            union all
            select 1, 'MADE', 'maker', cast(transaction_id as varchar), count(distinct customer_id)
            from log group by transaction_id having count(distinct customer_id) > 1""",
        "top_categories_last_hour": f"""with {_TX}, {_stats('1 hour')}
            select category, country, {_MONEY.format('total_amount')} as total_amount, cast(sum(txn_count) as bigint) as txn_count
            from stats where window_start >= (select max(window_start) from stats) - interval '7 days'
            group by category, country order by total_amount desc, category, country limit 10""",
        "top_customer_approved": best,
        "stored_top_customer": best,
        "transaction_paths": f"""with {_TX}
            select customer_id, transaction_id, merchant_id from tx
            order by customer_id, transaction_id, merchant_id limit 25""",
        "transaction_path_details": details,
        "stored_paths": details,
        "label_counts": f"""with {_TX}, {_stats('1 hour')}
            select 'Customer' as label, count(*) as cnt from customers
            union all select 'Merchant', count(*) from (select p_partkey as merchant_id from part union select merchant_id from tx)
            union all select 'Transaction', count(*) from tx
            union all select 'CategoryStats', count(*) from stats""",
        "relationship_count": f"with {_TX} select cast(2 * count(*) as bigint) as rels from tx",
        "topic_high_water": high_water,
        "consumer_lag": f"""with {_TX}, done as (
                select partition, max("offset") + 1 as end_offset from tx
                where ts < (select max(ts) from tx) - interval '1 day' and partition < 2 group by partition)
            select cast(partition as integer) as partition, max("offset") + 1 - coalesce(any_value(end_offset), 0) as lag
            from tx left join done using (partition) group by partition
            union all select 3, 0""",
        "latest_messages": newest,
        "topic_high_water_stored": high_water,
        "latest_messages_stored": newest,
        "consumer_lag_stored": f"""with {_TX}, {_ARRIVAL_BOUNDS}
            select cast(partition as integer) as partition,
                   max("offset") - max("offset") filter (where ts < (select max(edge) from edges)) as lag
            from tx group by partition""",
        "open_windows": f"""with {_TX}, {_stats('1 hour')}
            select category, country, strftime(window_start, {_ISO}) as window_start_iso from stats
            where window_start + interval '1 hour' >
                  (select date_trunc('millisecond', max(ts)) - interval '1 minute' from tx where status = 'approved')""",
        "pipeline_restarted": f"""with {_TX}, {_stats('1 hour')}
            select 'category_stats' as sink, count(*) as row_count, cast(sum(txn_count) as bigint) as transactions from stats
            union all
            select 'raw_graph', count(*), count(*) from tx where status = 'approved'""",
        "publish_reported": f"with {_TX} select count(*) as produced from tx",
        "batch_commit_log": """
            select case when event_type = 'purchase' then 'category_stats' else 'raw_graph' end as sink,
                   event_id as batch, cast(floor(value) as bigint) as rows
            from events where cast(floor(value) as bigint) > 0""",
        "latest_commits": """
            select case when event_type = 'purchase' then 'category_stats' else 'raw_graph' end as sink,
                   event_id as batch, cast(floor(value) as bigint) as rows
            from events where cast(floor(value) as bigint) > 0 
            order by date_trunc('second', ts) desc, sink, batch desc limit 12""",
        "produced_count": "select cast(max(event_id + 1) as bigint) as produced from events",
        "stream_progress": f"""with {_TX}, {_ARRIVAL_BOUNDS}
            select (select count(*) - 1 from edges where edge <= tx.ts) as arrival, count(*) as input_rows
            from tx group by 1""",
    }
