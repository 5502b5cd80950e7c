"""The registered queries. Each reads whole tables of ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow import schemas as S
from txnflow.functions.messages import encode_messages, json_object, parse_transactions
from txnflow.functions.timetext import as_utc, iso_micros, iso_millis
from txnflow.operators import graph as G
from txnflow.operators import monitor, quality
from txnflow.operators.enrich import enrich_merchant, hot_merchants, measured_strategy
from txnflow.operators.filters import filter_approved, parse_approved, project_transaction
from txnflow.operators.stats import category_stats_of, stats_payload, top_categories
from txnflow.operators.upsert import dedup
from txnflow.plans import inputs
from txnflow.session import require_utc, streaming_session, work_folder
from txnflow.sources import records, textlogs
from txnflow.sources.graphdb import merchant_dimension
from txnflow.sources.topics import file_batch, file_stream, store_topic, stored_end_offsets, stored_tail
from txnflow.streaming import pipeline, progress, state
from txnflow.streaming.audit import KeyAudit
from txnflow.streaming.publisher import ProducerReport, publish_transactions
from txnflow.streaming.store import GraphStore

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}
_ONCE = {"availableNow": True}
_PROJECTED = (
    "transaction_id", "customer_id", "merchant_id", "amount", "currency", "status", "transaction_date_iso",
)


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__.rstrip("_")] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def _stats_columns(stats: DataFrame) -> DataFrame:
    return stats_payload(stats, "long").withColumnRenamed("transaction_country", "country")


def _approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_approved(inputs.parsed(spark, sf_dir))


def _stream_session(spark: SparkSession, state_store: str = "rocksdb") -> SparkSession:
    """As many state partitions as cores, up to the session's: each of them costs per batch."""
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return streaming_session(spark, state_store, partitions)


def _topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.stored_text(inputs.envelope(spark, sf_dir))


# --- messages ---
@query
def encode_messages_(spark, sf_dir):
    messages = encode_messages(inputs.transactions(spark, sf_dir))
    body = json_object(F.col("value"), "transaction_id BIGINT, amount DOUBLE, status STRING")
    return messages.select(F.col("key").cast("string").alias("key"), body.alias("t")).select("key", "t.*")


@query
def stream_ingest(spark, sf_dir):
    """File stream of the envelope to Parquet, one micro-batch per arrival."""
    work, session = work_folder(spark, "stream_ingest"), _stream_session(spark)
    source, target = f"{work}/topic", f"{work}/ingested"
    inputs.run_arrivals(
        inputs.land_in_order(spark, sf_dir, source),
        lambda: pipeline.start_ingest(file_stream(session, source), target, f"{work}/checkpoint", _ONCE),
    )
    return file_batch(spark, target).select(F.col("key").cast("string").alias("key"), "partition", "offset")


@query
def parse_transactions_(spark, sf_dir):
    rows = parse_transactions(_topic(spark, sf_dir))
    return rows.select(*S.TRANSACTION_COLUMNS, iso_millis("transaction_date_ts").alias("transaction_date_iso"))


@query
def parse_event_time(spark, sf_dir):
    rows = parse_transactions(_topic(spark, sf_dir))
    return rows.select("transaction_id", F.unix_micros("transaction_date_ts").alias("event_micros"))


@query
def format_iso(spark, sf_dir):
    return inputs.parsed(spark, sf_dir).select(
        "transaction_id",
        iso_millis("transaction_date_ts").alias("transaction_date_iso"),
        iso_micros(F.col("transaction_date_ts")).alias("transaction_date_micros"),
    )


@query
def filter_approved_(spark, sf_dir):
    return parse_approved(_topic(spark, sf_dir)).select(*S.TRANSACTION_COLUMNS)


@query
def project_transaction_(spark, sf_dir):
    return project_transaction(inputs.parsed(spark, sf_dir))


@query
def dedup_transactions(spark, sf_dir):
    """Every transaction delivered twice, the second time an hour later and dearer."""
    rows = inputs.parsed(spark, sf_dir)
    later = rows.withColumn("amount", F.col("amount") + 1).withColumn(
        "transaction_date_ts", F.col("transaction_date_ts") + F.expr("INTERVAL 1 HOUR")
    )
    once = dedup(later.unionByName(rows), ["transaction_id"], ["transaction_date_ts"])
    return project_transaction(once).select(*_PROJECTED)


# --- dimension and windows ---
@query
def merchant_dim(spark, sf_dir):
    return merchant_dimension(inputs.all_merchants(spark, sf_dir))


@query
def enrich_merchant_(spark, sf_dir):
    return enrich_merchant(inputs.transactions(spark, sf_dir), inputs.merchants(spark, sf_dir)).select(
        "transaction_id", "merchant_id", "category"
    )


@query
def enrich_merchant_salted(spark, sf_dir):
    """The join streams use when the dimension is too large to broadcast."""
    joined = enrich_merchant(
        inputs.transactions(spark, sf_dir), inputs.merchants(spark, sf_dir), strategy="salted"
    )
    return joined.select("transaction_id", "merchant_id", "category")


def _stats_from_messages(spark, sf_dir, window):
    approved = parse_approved(_topic(spark, sf_dir))
    return _stats_columns(category_stats_of(approved, inputs.merchants(spark, sf_dir), window))


@query
def category_stats(spark, sf_dir):
    return _stats_from_messages(spark, sf_dir, "1 hour")


@query
def category_stats_1m(spark, sf_dir):
    return _stats_from_messages(spark, sf_dir, "1 minute")


@query
def category_stats_1d(spark, sf_dir):
    return _stats_from_messages(spark, sf_dir, "1 day")


@query
def category_stats_large_dim(spark, sf_dir):
    """The plan for a dimension beyond the broadcast limit: totals per merchant, then the join."""
    return _stats_columns(
        category_stats_of(_approved(spark, sf_dir), inputs.merchants(spark, sf_dir), "1 hour", limit_bytes=0)
    )


# --- streams ---
@contextmanager
def _listening(listener):
    """Attached to its session's queries meanwhile."""
    listener.attach()
    try:
        yield
    finally:
        listener.detach()


def _run_stats_stream(spark, sf_dir, name, *, state_store="rocksdb", late_text=None, session=None):
    work, session = work_folder(spark, name), session or _stream_session(spark, state_store)
    store = GraphStore(session, f"{work}/store")
    merchants = inputs.merchants(session, sf_dir)
    # The dimension does not change between the runs, so it is measured once for all of them.
    strategy = measured_strategy(merchants, streaming=True)
    config = pipeline.PipelineConfig(
        checkpoint_root=f"{work}/checkpoints", window="1 hour", join_strategy=strategy,
        # Unnamed, every merchant would be copied per salt in each micro-batch.
        hot_merchants=tuple(hot_merchants(_approved(spark, sf_dir))) if strategy == "salted" else None,
    )
    finished = inputs.run_arrivals(
        inputs.land_in_order(spark, sf_dir, f"{work}/topic", late_text),
        lambda: pipeline.start_category_stats(
            file_stream(session, f"{work}/topic"), merchants, store, config, _ONCE
        ),
    )
    return GraphStore(spark, store.root), finished


@query
def stream_category_stats(spark, sf_dir):
    """Update-mode emissions of several micro-batches, resolved to the last per window."""
    store, _ = _run_stats_stream(spark, sf_dir, "stream_category_stats", state_store="default")
    return _stats_columns(G.stats_nodes(store.stats.read()))


@query
def category_stats_pipeline(spark, sf_dir):
    store, _ = _run_stats_stream(spark, sf_dir, "category_stats_pipeline")
    return _stats_columns(store.category_stats())


@query
def category_stats_compacted(spark, sf_dir):
    """The statistics table read from a compacted base and the batches after it."""
    store, _ = _run_stats_stream(spark, sf_dir, "category_stats_compacted")
    store.compact_stats()
    return _stats_columns(store.category_stats())


def _seed_between(spark, sf_dir, store, land):
    """Seeds small merchants, then the other ones and another category for one brand halfway through."""
    rows = inputs.all_merchants(spark, sf_dir).where(F.col("p_size") <= inputs.LARGEST_MERCHANT_SIZE)
    columns = ("merchant_name", "category")
    store.seed_merchants(rows.where(F.col("p_size") <= inputs.SMALL_MERCHANT_SIZE), columns)
    for i, _ in enumerate(land):
        yield
        if i + 1 == inputs.ARRIVALS // 2:
            store.seed_merchants(rows.where(F.col("p_size") > inputs.SMALL_MERCHANT_SIZE), columns)
            store.seed_merchants(
                rows.where(F.col("brand") == inputs.RECLASSED_BRAND).withColumn("category", F.lit("RECLASSED")),
                ("category",),
            )


def _run_live_stream(spark, sf_dir, name):
    work, session = work_folder(spark, name), _stream_session(spark)
    store = GraphStore(session, f"{work}/store")
    config = pipeline.PipelineConfig(checkpoint_root=f"{work}/checkpoints", window="1 hour")
    land = inputs.land_in_order(spark, sf_dir, f"{work}/topic")
    queries = inputs.run_arrivals(
        _seed_between(spark, sf_dir, GraphStore(spark, store.root), land),
        lambda: pipeline.start_merchant_stats(file_stream(session, f"{work}/topic"), store, config, _ONCE),
    )
    return GraphStore(spark, store.root), queries


@query
def live_dimension_stats(spark, sf_dir):
    """Merchants seeded while the stream runs count from the next micro-batch on."""
    store, _ = _run_live_stream(spark, sf_dir, "live_dimension_stats")
    return _stats_columns(store.category_stats())


@query
def live_dimension_compacted(spark, sf_dir):
    """The same from bases: one fold before the last arrival's batches, one over the rest."""
    store, _ = _run_live_stream(spark, sf_dir, "live_dimension_compacted")
    positions = store.merchant_stats.batches()
    store.compact_stats(upto=positions[len(positions) // 2])
    store.compact_stats()
    store.expire("merchant_stats")
    return _stats_columns(store.category_stats())


@query
def late_data_trace(spark, sf_dir):
    """EUR transactions arrive one span late; those whose window has closed are dropped."""
    store, _ = _run_stats_stream(spark, sf_dir, "late_data_trace", late_text='"currency":"EUR"')
    return _stats_columns(store.category_stats())


@query
def stream_progress(spark, sf_dir):
    """Rows read per arrival, from the logged progress reports of the statistics stream."""
    folder = work_folder(spark, "progress")
    session, ended = _stream_session(spark), []
    log = progress.ProgressLog(session, folder)
    with _listening(log):
        _, finished = _run_stats_stream(spark, sf_dir, "stream_progress", session=session)
        for arrival, query_ in enumerate(finished):
            log.wait(query_)
            ended.append((str(query_.runId), arrival))
    runs = spark.createDataFrame(ended, "run_id STRING, arrival BIGINT")
    reports = progress.read_progress(spark, folder).join(runs, "run_id")
    return reports.groupBy("arrival").agg(F.sum("input_rows").alias("input_rows"))


@query
def open_windows(spark, sf_dir):
    """Groups of the statistics stream that are still in its state after the last arrival."""
    store, _ = _run_stats_stream(spark, sf_dir, "open_windows")
    checkpoint = store.root.removesuffix("/store") + "/checkpoints/category_stats"
    return state.open_windows(spark, checkpoint).select(
        "category", F.col("transaction_country").alias("country"), iso_millis("window_start").alias("window_start_iso")
    )


@query
def pipeline_restarted(spark, sf_dir):
    """Both sinks at once, stopped after each arrival and started again from their checkpoints."""
    work, session = work_folder(spark, "pipeline_restarted"), _stream_session(spark)
    store = GraphStore(session, f"{work}/store")
    GraphStore(spark, store.root).seed_merchants(inputs.merchants(spark, sf_dir), ("merchant_name", "category"))
    config = pipeline.PipelineConfig(checkpoint_root=f"{work}/checkpoints", window="1 hour")
    for _ in inputs.land_in_order(spark, sf_dir, f"{work}/topic"):
        running = pipeline.start_pipeline(file_stream(session, f"{work}/topic"), store, config)
        for query_ in running:
            query_.processAllAvailable()
        for query_ in running:
            query_.stop()
    store = GraphStore(spark, store.root)
    counts = F.count(F.lit(1)).alias("row_count")
    stats = store.category_stats().agg(counts, F.sum("txn_count").alias("transactions"))
    nodes = store.graph().transactions.agg(counts, F.count("transaction_id").alias("transactions"))
    return stats.select(F.lit("category_stats").alias("sink"), "*").unionByName(
        nodes.select(F.lit("raw_graph").alias("sink"), "*")
    )


@query
def publish_reported(spark, sf_dir):
    """Every transaction published again from a stream; the count its publisher's log lines end on."""
    work, session = work_folder(spark, "publish_reported"), _stream_session(spark)
    report = ProducerReport(session, f"{work}/log")
    with _listening(report):
        finished = inputs.run_arrivals(
            inputs.land_in_order(spark, sf_dir, f"{work}/topic"),
            lambda: publish_transactions(
                parse_transactions(file_stream(session, f"{work}/topic")), f"{work}/checkpoint",
                {"path": f"{work}/published"}, sink="parquet", trigger=_ONCE,
            ),
        )
        for query_ in finished:
            report.wait(query_)
    return textlogs.produced_count(textlogs.read_log(spark, f"{work}/log"))


def _run_raw_stream(spark, sf_dir, name):
    work, session = work_folder(spark, name), _stream_session(spark)
    store = GraphStore(session, f"{work}/store")
    config = pipeline.PipelineConfig(checkpoint_root=f"{work}/checkpoints")
    inputs.run_arrivals(
        inputs.land_in_order(spark, sf_dir, f"{work}/topic"),
        lambda: pipeline.start_raw_graph(file_stream(session, f"{work}/topic"), store, config, _ONCE),
    )
    return GraphStore(spark, store.root)


def _transaction_columns(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        "transaction_id", "amount", "currency", "status",
        iso_millis("transaction_date").alias("transaction_date_iso"),
    )


@query
def raw_graph_pipeline(spark, sf_dir):
    store = _run_raw_stream(spark, sf_dir, "raw_graph_pipeline")
    return _transaction_columns(store.graph().transactions)


@query
def raw_graph_compacted(spark, sf_dir):
    """Transactions read from a compacted base and the batches after it."""
    store = _run_raw_stream(spark, sf_dir, "raw_graph_compacted")
    store.compact_raw()
    return _transaction_columns(store.graph().transactions)


@query
def raw_graph_two_runs(spark, sf_dir):
    """Two checkpoints: the younger run is compacted first, then the older one goes on.

    The older run's second batch holds first writes of keys the base knows from the younger.
    """
    store = GraphStore(spark, work_folder(spark, "raw_graph_two_runs"))
    approved, again = inputs.two_raw_batches(spark, sf_dir)
    store.raw.write(approved, 0, 0)
    store.raw.write(again, 1, 0)
    store.raw.write(again, 1, 1)
    store.compact_raw()
    store.raw.write(inputs.raw_rows(spark, sf_dir), 0, 1)
    return _transaction_columns(store.graph().transactions)


# --- upserts ---
def _two_batch_log(spark, sf_dir) -> DataFrame:
    """Both batches written to a log and read back."""
    store = GraphStore(spark, work_folder(spark, "two_batches"))
    for batch_id, rows in enumerate(inputs.two_raw_batches(spark, sf_dir)):
        store.raw.write(rows, 0, batch_id)
    return store.raw.read()


@query
def upsert_customer_stub(spark, sf_dir):
    return G.customer_stubs(_two_batch_log(spark, sf_dir))


@query
def upsert_merchant_stub(spark, sf_dir):
    return G.merchant_stubs(_two_batch_log(spark, sf_dir))


@query
def upsert_transaction(spark, sf_dir):
    return _transaction_columns(G.transaction_nodes(_two_batch_log(spark, sf_dir)))


@query
def edge_made(spark, sf_dir):
    edges = G.made_edges(_two_batch_log(spark, sf_dir))
    return edges.select(
        "customer_id", "transaction_id", "amount", "currency", iso_millis("timestamp").alias("timestamp_iso")
    )


@query
def edge_at(spark, sf_dir):
    return G.at_edges(_two_batch_log(spark, sf_dir))


@query
def upsert_customers(spark, sf_dir):
    """All customers in full; then one segment again with only its place columns listed."""
    store = GraphStore(spark, work_folder(spark, "upsert_customers"))
    rows = inputs.customers(spark, sf_dir)
    key = F.col("customer_id")
    full = rows.select(
        "customer_id", "customer_name",
        F.concat(F.lit("c"), key, F.lit("@example.com")).alias("email"),
        "customer_country", "customer_city",
        (F.lit(18) + F.pmod(key, F.lit(63))).alias("age"),
        F.date_format(
            F.date_add(F.lit(S.FIRST_REGISTRATION).cast("date"), F.pmod(key, F.lit(2191)).cast("int")), "yyyy-MM-dd"
        ).alias("registration_date"),
    )
    # Dates arrive as text and are parsed when seeded.
    store.seed_customers(full)
    moved = rows.where(F.col("segment") == "BUILDING").select(
        "customer_id",
        F.lit(None).cast("string").alias("customer_country"),
        F.concat(F.upper("customer_city"), F.lit("!")).alias("customer_city"),
    )
    store.seed_customers(moved, ("customer_country", "customer_city"))
    return G.customer_seed_nodes(store.customer_seed.read()).select(
        "customer_id", "customer_name", "email", "customer_city", "customer_country", "age",
        F.date_format("registration_date", "yyyy-MM-dd").alias("registration_date_text"),
    )


@query
def upsert_merchants(spark, sf_dir):
    """All merchants in full; then one brand again with only the category listed."""
    store = GraphStore(spark, work_folder(spark, "upsert_merchants"))
    rows = inputs.all_merchants(spark, sf_dir)
    store.seed_merchants(
        rows.withColumn("merchant_country", F.col("brand")), ("merchant_name", "category", "merchant_country")
    )
    reclassed = rows.where(F.col("brand") == "Brand#1").withColumn("category", F.lit("RECLASSED"))
    store.seed_merchants(reclassed, ("category",))
    return G.merchant_seed_nodes(store.merchant_seed.read()).select(
        "merchant_id", "merchant_name", "category", "merchant_country"
    )


@query
def duplicate_key_check(spark, sf_dir):
    """Key constraints over tables in which the approved rows, one segment and one country occur twice."""
    tx = inputs.transactions(spark, sf_dir).select("transaction_id", "status")
    people = inputs.customers(spark, sf_dir).select("customer_id", "segment")
    stats = _hour_stats(spark, sf_dir).select(*G.STATS_KEY)
    return quality.duplicate_keys({
        "Transaction": tx.unionByName(filter_approved(tx)),
        "Customer": people.unionByName(people.where(F.col("segment") == "BUILDING")),
        "Merchant": inputs.all_merchants(spark, sf_dir),
        "CategoryStats": stats.unionByName(stats.where(F.col("country") == "ASIA")),
    })


@query
def two_maker_check(spark, sf_dir):
    log = _two_batch_log(spark, sf_dir)
    edges = G.made_edges(log)
    return quality.duplicate_keys({"MADE": edges}, {"MADE": ("transaction_id",)})


@query
def continuous_key_check(spark, sf_dir):
    """Checks after each of two batches; the second holds other customers and some rows twice."""
    store = GraphStore(spark, work_folder(spark, "continuous_key_check"))
    approved, again = inputs.two_raw_batches(spark, sf_dir)
    audit = KeyAudit(store)
    store.raw.write(approved, 0, 0)
    audit.check(upto=(0, 0))
    store.compact_raw(upto=(0, 0))
    store.raw.write(again.unionByName(again.where(F.col("status") == "declined")), 0, 1)
    audit.check(upto=(0, 1))
    return audit.violations()


# --- graph queries ---
def _hour_stats(spark, sf_dir) -> DataFrame:
    return category_stats_of(_approved(spark, sf_dir), inputs.merchants(spark, sf_dir), "1 hour")


def _graph(spark, sf_dir) -> G.Graph:
    return inputs.graph(spark, sf_dir, _hour_stats(spark, sf_dir))


@query
def top_categories_last_hour(spark, sf_dir):
    """The report with a longer look-back, as of the newest window of a stored table."""
    store = GraphStore(spark, work_folder(spark, "top_categories"))
    stats = _hour_stats(spark, sf_dir).withColumn("updated_at", F.current_timestamp())
    store.stats.write(stats.sortWithinPartitions("window_start"), 0, 0)
    newest = as_utc(store.stats.read().agg(F.max("window_start").cast("timestamp_ntz")).first()[0])
    recent = store.category_stats(since=newest - timedelta(days=7))
    return top_categories(recent, F.lit(newest), "7 DAYS")


@query
def top_customer_approved(spark, sf_dir):
    return G.top_customers(_graph(spark, sf_dir))


@query
def transaction_paths(spark, sf_dir):
    return G.transaction_paths(_graph(spark, sf_dir))


def _path_columns(details: DataFrame) -> DataFrame:
    return details.select(
        "customer_id", "customer_name", "transaction_id", "made_amount", "amount", "status",
        iso_millis("transaction_date").alias("transaction_date_iso"), "merchant_id", "merchant_name", "category",
    )


@query
def transaction_path_details(spark, sf_dir):
    graph = _graph(spark, sf_dir)
    return _path_columns(G.path_details(graph, G.transaction_paths(graph)))


def _stored_graph(spark, sf_dir, name) -> G.Graph:
    """A graph as a pipeline leaves it: two batches compacted, a third one after them, merchants and customers seeded."""
    store = GraphStore(spark, work_folder(spark, name))
    rows = inputs.raw_rows(spark, sf_dir)
    for batch_id in range(3):
        store.raw.write(rows.where(F.pmod("transaction_id", F.lit(3)) == batch_id), 0, batch_id)
    store.compact_raw(upto=(0, 1))
    store.seed_customers(inputs.customers(spark, sf_dir), ("customer_name", "customer_country", "customer_city"))
    store.seed_merchants(inputs.all_merchants(spark, sf_dir), ("merchant_name", "category"))
    return store.graph()


@query
def stored_paths(spark, sf_dir):
    """The first paths of a stored graph, with the properties along them."""
    graph = _stored_graph(spark, sf_dir, "stored_paths")
    return _path_columns(G.path_details(graph, G.transaction_paths(graph)))


@query
def stored_top_customer(spark, sf_dir):
    return G.top_customers(_stored_graph(spark, sf_dir, "stored_top_customer"))


@query
def label_counts(spark, sf_dir):
    return G.label_counts(_graph(spark, sf_dir))


@query
def relationship_count(spark, sf_dir):
    return G.relationship_count(_graph(spark, sf_dir))


# --- monitoring ---
@query
def topic_high_water(spark, sf_dir):
    return monitor.topic_high_water(inputs.envelope(spark, sf_dir))


@query
def consumer_lag(spark, sf_dir):
    """A consumer that stopped a day before the newest message and never read one partition.

    Of another partition it had read all, and retention has removed its messages since.
    """
    envelope = inputs.envelope(spark, sf_dir)
    newest = as_utc(envelope.agg(F.max("timestamp").cast("timestamp_ntz")).first()[0])
    read = envelope.where(
        (F.col("timestamp") < F.lit(newest) - F.expr("INTERVAL 1 DAY")) & (F.col("partition") < 2)
    )
    expired = read.groupBy().agg(F.lit(inputs.TOPIC_PARTITIONS).alias("partition"), F.count("*").alias("end_offset"))
    return monitor.consumer_lag(envelope, monitor.end_offsets(read).unionByName(expired))


@query
def latest_messages(spark, sf_dir):
    return monitor.latest_messages(inputs.envelope(spark, sf_dir)).select("transaction_id", "status", "amount")


def _stored_topic(spark, sf_dir, name) -> str:
    folder = work_folder(spark, name)
    store_topic(inputs.envelope(spark, sf_dir), folder)
    return folder


@query
def topic_high_water_stored(spark, sf_dir):
    """From the footers of a stored topic's files."""
    return monitor.high_water(stored_end_offsets(spark, _stored_topic(spark, sf_dir, "topic_high_water")))


@query
def latest_messages_stored(spark, sf_dir):
    """From the end of each partition of a stored topic."""
    tail = stored_tail(spark, _stored_topic(spark, sf_dir, "latest_messages"), 15)
    return monitor.latest_messages(tail).select("transaction_id", "status", "amount")


@query
def consumer_lag_stored(spark, sf_dir):
    """A consumer that had read a stored topic to its end before the last arrival landed."""
    folder = work_folder(spark, "consumer_lag")
    spans = inputs.arrivals(spark, sf_dir)
    for i, span in enumerate(spans):
        if i == len(spans) - 1:
            committed = spark.createDataFrame(stored_end_offsets(spark, folder).collect(), progress.COMMITTED)
        store_topic(inputs.envelope(spark, sf_dir, span), folder)
    return monitor.lag_behind(stored_end_offsets(spark, folder), committed)


def _commit_lines(spark, sf_dir) -> DataFrame:
    """One consumer log line per event, written as text and read back."""
    rows = F.floor("value").cast("long")
    sink = F.when(F.col("event_type") == "purchase", "category_stats").otherwise("raw_graph")
    events = inputs.table(spark, sf_dir, "events")
    tail = F.when(rows > 0, F.concat(F.lit(" rows="), rows)).otherwise(F.lit(" empty"))
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" | INFO | consumer | ["), sink,
        F.lit("] batch="), F.col("event_id"), tail,
    )
    folder = f"{work_folder(spark, 'commit_log')}/lines"
    events.select(line.alias("value")).write.text(folder)
    return textlogs.batch_commits(textlogs.read_log(spark, folder))


@query
def batch_commit_log(spark, sf_dir):
    return _commit_lines(spark, sf_dir).drop("logged_at")


@query
def latest_commits(spark, sf_dir):
    return monitor.latest_commits(_commit_lines(spark, sf_dir)).drop("logged_at")


@query
def produced_count(spark, sf_dir):
    """One producer log line per event."""
    number = F.col("event_id") + 1
    line = F.concat(
        F.lit("INFO | producer | produced "), number, F.lit(" transactions (last id="), number, F.lit(")")
    )
    folder = f"{work_folder(spark, 'producer_log')}/lines"
    inputs.table(spark, sf_dir, "events").select(line.alias("value")).write.text(folder)
    return textlogs.produced_count(textlogs.read_log(spark, folder))


# --- generators, over the ids of the tables ---
@query
def gen_customers(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("id"))
    return records.build_customers(ids)


@query
def gen_merchants(spark, sf_dir):
    ids = inputs.table(spark, sf_dir, "part").select((F.col("p_partkey") + 1).alias("id"))
    return records.build_merchants(ids)


@query
def gen_transactions(spark, sf_dir):
    require_utc(spark)
    ids = inputs.table(spark, sf_dir, "events").select(
        (F.col("event_id") + 1).alias("id"), F.col("ts").cast("timestamp").alias("at")
    )
    return records.build_transactions(ids, F.col("at"))
