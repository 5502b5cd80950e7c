"""``python -m txnflow``: run both sinks on a Kafka topic, set up from the environment."""

from __future__ import annotations

import logging

from txnflow.schemas import LOG_FORMAT, LOG_TIME_FORMAT
from txnflow.session import build_session
from txnflow.sources.graphdb import ConnectorServer, GraphTarget
from txnflow.streaming.pipeline import PipelineConfig, run_kafka_pipeline
from txnflow.streaming.progress import ProgressLog
from txnflow.streaming.store import GraphStore


def main() -> None:
    logging.basicConfig(level=logging.INFO, format=LOG_FORMAT, datefmt=LOG_TIME_FORMAT)
    config = PipelineConfig.from_env()
    if config.sink not in ("files", "server"):
        raise ValueError(f"GRAPH_SINK is files or server, not {config.sink!r}")
    server = ConnectorServer(GraphTarget.from_env()) if config.sink == "server" else None
    spark = build_session(config.app_name, shuffle_partitions=config.shuffle_partitions)
    ProgressLog(spark, f"{config.store_root}/progress").attach()
    run_kafka_pipeline(spark, GraphStore(spark, config.store_root), config, server)


if __name__ == "__main__":
    main()
