"""Session building and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_options(shuffle_partitions: int | None = None, state_store: str = "rocksdb") -> dict[str, str]:
    """Settings every session of this package uses.

    ``shuffle_partitions`` also fixes the number of state partitions of a streaming
    aggregate at its first checkpoint, so size it for the largest state expected.
    """
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.metricsEnabled": "true",
    }
    if shuffle_partitions is not None:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if state_store == "rocksdb":
        options["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
        options["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    elif state_store != "default":
        raise ValueError(f"unknown state store {state_store!r}")
    return options


def build_session(
    app_name: str = "streaming-transactions",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    state_store: str = "rocksdb",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**session_options(shuffle_partitions, state_store), **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    require_utc(spark)
    return spark


def require_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: window bounds and ISO text depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(
    spark: SparkSession, state_store: str = "rocksdb", partitions: int | None = None
) -> SparkSession:
    """A sibling session for streaming queries, so their settings do not leak into ``spark``.

    ``partitions`` is the number of state partitions, by default the session's for shuffles.
    """
    sibling = spark.newSession()
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in session_options(partitions, state_store).items():
        sibling.conf.set(key, value)
    return sibling


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for tables and checkpoints every executor can reach.

    The folder comes from ``spark.checkpoint.dir``. Only a local session may go without
    it; on a cluster a machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        base = tempfile.mkdtemp(prefix="txnflow-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file exists on whatever file system the path names."""
    fs, path = _file_system(spark, path)
    return fs.exists(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, from folder names only."""
    fs, path = _file_system(spark, pattern)
    return [str(status.getPath().toString()) for status in fs.globStatus(path) or []]


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false when it is there already, whoever made it."""
    fs, path = _file_system(spark, path)
    fs.mkdirs(path.getParent())
    return fs.createNewFile(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place at once, over an earlier one of the name."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(text.encode())
    out.close()
    fs.delete(target, False)
    fs.rename(draft, target)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, path = _file_system(spark, path)
    fs.delete(path, True)
