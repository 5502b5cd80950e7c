"""What a stateful query holds, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The groups a window query still keeps after its last batch, one row per group with its window.

    A group missing here was given up when its window closed: later rows of it are dropped.
    """
    state = spark.read.format("statestore").load(checkpoint)
    names = [f.name for f in state.schema["key"].dataType.fields]
    # The window has no name of its own in the state; it is the one struct of the key.
    window, *groups = sorted(names, key=lambda n: state.schema["key"].dataType[n].dataType.typeName() != "struct")
    return state.select(
        *(F.col("key")[g].alias(g) for g in groups),
        F.col("key")[window]["start"].alias("window_start"), F.col("key")[window]["end"].alias("window_end"),
    )
