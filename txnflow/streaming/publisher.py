"""Publishing transactions at a steady pace, with a count that the monitoring reads."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnflow.functions.messages import encode_messages
from txnflow.schemas import PRODUCED_LINE
from txnflow.session import write_text
from txnflow.sources.topics import publish_stream
from txnflow.streaming.progress import EndedRuns

logger = logging.getLogger("txnflow.producer")
_COUNTED = "produced"


class ProducerReport(EndedRuns):
    """Logs how many transactions a session's publishers have sent, after each batch that sent any.

    With a ``folder`` each line is also a file there, which ``textlogs.read_log`` reads.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        super().__init__()
        self.spark, self.folder, self.sent = spark, folder, 0

    def attach(self) -> ProducerReport:
        self.spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self.spark.streams.removeListener(self)

    def onQueryProgress(self, event) -> None:
        counted = event.progress.observedMetrics.get(_COUNTED)
        if counted is None or not counted["sent"]:
            return
        self.sent += counted["sent"]
        line = PRODUCED_LINE.format(sent=self.sent, last=counted["last_id"])
        logger.info(line)
        if self.folder:
            write_text(self.spark, f"{self.folder}/{self.sent:020d}-{uuid.uuid4().hex}.txt", f"{line}\n")


def publish_transactions(
    transactions: DataFrame, checkpoint: str, options: Mapping[str, str], *, sink: str = "kafka",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Publish a stream of transactions, such as ``records.transaction_stream``, counted as it goes.

    The count is taken while a batch is written, in no pass of its own; an attached
    ``ProducerReport`` logs it.
    """
    counted = transactions.observe(
        _COUNTED, F.count(F.lit(1)).alias("sent"), F.max("transaction_id").alias("last_id")
    )
    return publish_stream(encode_messages(counted), checkpoint, options, sink=sink, trigger=trigger)
