import pytest

from txnflow.session import ROCKSDB_PROVIDER, session_options, streaming_session, work_folder
from txnflow.sources.graphdb import GraphTarget, edge_query, merchant_dimension, node_query, read_nodes
from txnflow.sources.topics import kafka_sink_options, kafka_source_options, tail_starts
from txnflow.streaming.pipeline import PipelineConfig


def test_kafka_source_options():
    assert kafka_source_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "failOnDataLoss": "false"}
    more = kafka_source_options(
        "h:1", "t", starting_offsets="earliest", max_offsets_per_trigger=10, min_partitions=6, extra={"failOnDataLoss": "true"})
    assert more["maxOffsetsPerTrigger"] == "10" and more["minPartitions"] == "6"
    assert more["startingOffsets"] == "earliest" and more["failOnDataLoss"] == "true"


def test_kafka_sink_options():
    options = kafka_sink_options("h:1", "t", {"kafka.compression.type": "zstd"})
    assert options["topic"] == "t" and options["kafka.acks"] == "all" and options["kafka.retries"] == "5"
    assert options["kafka.linger.ms"] == "20" and options["kafka.request.timeout.ms"] == "30000"
    assert options["kafka.max.in.flight.requests.per.connection"] == "5"
    assert options["kafka.compression.type"] == "zstd"


def test_graph_target():
    target = GraphTarget.from_env({"NEO4J_URI": "bolt://h:7687", "NEO4J_USER": "u", "NEO4J_PASSWORD": "p"})
    assert target.options() == {
        "url": "bolt://h:7687", "authentication.type": "basic", "authentication.basic.username": "u",
        "authentication.basic.password": "p", "database": "neo4j"}
    assert target.query_options("RETURN 1") == {**target.options(), "query": "RETURN 1", "batch.size": "500"}
    with pytest.raises(KeyError):
        GraphTarget.from_env({})


def test_connector_is_only_needed_at_load(spark):
    with pytest.raises(Exception, match="org.neo4j.spark"):
        read_nodes(spark, GraphTarget("bolt://h:1", "u", "p"), "Merchant")


def test_merchant_dimension(spark):
    found = merchant_dimension(spark.sql("select 3 merchant_id, 'x' category, 1 other"))
    assert found.columns == ["merchant_id", "category"] and found.first()[0] == 3


def test_pipeline_config():
    config = PipelineConfig.from_env({"KAFKA_BOOTSTRAP_SERVERS": "h:1", "KAFKA_TOPIC": "t", "SPARK_WINDOW_DURATION": "5 minutes"})
    assert (config.watermark, config.window, config.app_name) == ("1 minute", "5 minutes", "streaming-transactions")
    assert config.checkpoint("raw_graph") == "./checkpoints/raw_graph"


def test_pipeline_config_in_full():
    config = PipelineConfig.from_env({
        "KAFKA_BOOTSTRAP_SERVERS": "h:1", "KAFKA_TOPIC": "t", "MAX_OFFSETS_PER_TRIGGER": "5", "MIN_PARTITIONS": "9",
        "SPARK_SHUFFLE_PARTITIONS": "64", "GRAPH_STORE_ROOT": "s3://x/graph"})
    assert (config.max_offsets_per_trigger, config.min_partitions, config.shuffle_partitions) == (5, 9, 64)
    assert config.store_root == "s3://x/graph"


def test_session(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session_options()["spark.sql.streaming.stateStore.providerClass"] == ROCKSDB_PROVIDER
    assert "spark.sql.streaming.stateStore.providerClass" not in session_options(state_store="default")
    with pytest.raises(ValueError, match="state store"):
        session_options(state_store="other")
    sibling = streaming_session(spark)
    sibling.conf.set("spark.sql.shuffle.partitions", "3")
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"


def test_work_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "a"), work_folder(spark, "a")
    assert first.startswith(f"{base}/a-") and first != second


class ClusterSession:
    """As much of a cluster session as the folder choice looks at."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(ClusterSession, "x")


def test_merge_queries():
    assert node_query("Customer", ["customer_id"]) == "MERGE (n:Customer {customer_id: event.customer_id})"
    assert node_query("T", ["k"], created=["a", "b"]) == (
        "MERGE (n:T {k: event.k}) ON CREATE SET n.a = event.a, n.b = event.b")
    assert node_query("S", ["k", "l"], overwritten=["v"]) == "MERGE (n:S {k: event.k, l: event.l}) SET n.v = event.v"
    assert edge_query("MADE", ("Customer", "customer_id"), ("Transaction", "transaction_id"), ["amount"]) == (
        "MATCH (a:Customer {customer_id: event.customer_id}) MATCH (b:Transaction {transaction_id: event.transaction_id}) "
        "MERGE (a)-[r:MADE]->(b) ON CREATE SET r.amount = event.amount")


def test_sink_from_the_environment():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "h:1", "KAFKA_TOPIC": "t"}
    assert PipelineConfig.from_env(env).sink == "files"
    assert PipelineConfig.from_env({**env, "GRAPH_SINK": "server"}).sink == "server"


def test_kafka_tail_starts_near_the_end(spark):
    ends = spark.createDataFrame([(0, 100), (1, 3)], "partition INT, end_offset BIGINT")
    assert tail_starts(ends, 15) == {0: 85, 1: 0}
