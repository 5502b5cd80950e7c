"""The graph server sinks against a recording server."""

from helpers import envelope, land, merchants, rows, txn

from txnflow.operators.filters import parse_approved
from txnflow.session import streaming_session, work_folder
from txnflow.sources.topics import file_stream
from txnflow.streaming.pipeline import PipelineConfig, start_server_pipeline
from txnflow.streaming.sinks import raw_server_writer, stats_server_writer
from txnflow.streaming.store import GraphStore


class Recorder:
    """Merges rows as a server would. There is nothing to read keys or edges with."""

    def __init__(self, spark):
        self.dimension, self.tables, self.sent = merchants(spark), {}, []

    def merchants(self, spark):
        return self.dimension

    def _merge(self, name, frame, keys, created, overwritten=()):
        found = frame.collect()
        self.sent.append((name, len(found)))
        for row in found:
            table, key = self.tables.setdefault(name, {}), tuple(row[k] for k in keys)
            if key not in table:
                table[key] = {c: row[c] for c in created}
            table[key].update({c: row[c] for c in overwritten})

    def merge_nodes(self, frame, label, keys, created=(), overwritten=()):
        self._merge(label, frame, keys, created, overwritten)

    def merge_edges(self, frame, edge, source, target, created=()):
        ends = (source[1], target[1])
        # Edges are merged between nodes the server has.
        for row in frame.collect():
            assert all((row[key],) in self.tables[label] for label, key in (source, target))
        self._merge(edge, frame, ends, created)


def test_raw_sink_creates_and_never_changes(spark):
    server = Recorder(spark)
    write = raw_server_writer(server)
    first = parse_approved(envelope(spark, [txn(1, "10:00:00", 5.0), txn(2, "10:00:01", 6.0)]))
    again = parse_approved(envelope(spark, [txn(1, "10:00:09", 500.0), txn(3, "10:00:10", 7.0)]))
    write(first, 0)
    before = {name: dict(table) for name, table in server.tables.items()}
    write(first, 0)
    assert server.tables == before
    write(again, 1)
    assert {key[0]: row["amount"] for key, row in server.tables["Transaction"].items()} == {1: 5.0, 2: 6.0, 3: 7.0}
    assert sorted(row["amount"] for row in server.tables["MADE"].values()) == [5.0, 6.0, 7.0]
    assert set(server.tables["Transaction"][1,]) == {"amount", "currency", "status", "transaction_date"}
    assert [name for name, _ in server.sent[:5]] == ["Customer", "Merchant", "Transaction", "MADE", "AT"]


def test_stats_sink_overwrites(spark):
    server = Recorder(spark)
    write = stats_server_writer(server)
    for batch, total in enumerate((1.0, 9.0)):
        write(spark.sql(
            f"select 'travel' category, 'MX' country, timestamp'2024-05-01 10:00:00' window_start, "
            f"timestamp'2024-05-01 10:01:00' window_end, {total}D total_amount, 2L txn_count"), batch)
    (key, row), = server.tables["CategoryStats"].items()
    assert key == ("travel", "MX", "2024-05-01T10:00:00.000Z")
    assert row["total_amount"] == 9.0 and set(row) == {"window_end_iso", "total_amount", "txn_count", "updated_at"}


def test_both_sinks_on_a_server(spark):
    session, work = streaming_session(spark, "default"), work_folder(spark, "server")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    store, server = GraphStore(session, f"{work}/store"), Recorder(session)
    config = PipelineConfig(checkpoint_root=f"{work}/checkpoints", sink="server")
    for messages in ([txn(1, "10:00:00"), txn(2, "10:00:01", merchant=2)], [txn(3, "10:00:02")]):
        land(session, f"{work}/topic", messages)
        stream = file_stream(session, f"{work}/topic")
        for query in start_server_pipeline(stream, store, server, config, {"availableNow": True}):
            query.awaitTermination()
    assert len(server.tables["Transaction"]) == 3
    assert {k[0]: r["txn_count"] for k, r in server.tables["CategoryStats"].items()} == {"travel": 2, "health": 1}
    assert rows(store.raw.read()) == []
