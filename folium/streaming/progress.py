"""Progress events of a run folded into the state of each stage."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "seq long, ts timestamp, run_id string, stage string, status string, message string"
FINAL = ("done", "failed", "skipped")


def stage_status(events: DataFrame) -> DataFrame:
    """Batch: per run and stage the last status (a warning never overwrites a final one and else means running), the last message and the number of events."""
    status = F.when(F.col("status") == "warning", "running").otherwise(F.col("status"))
    final = F.max_by(F.when(F.col("status") != "warning", F.col("status")), F.when(F.col("status") != "warning", F.col("seq")))
    last = F.max_by(status, F.col("seq"))
    kept = F.when(final.isin(*FINAL), final).otherwise(last)
    return events.groupBy("run_id", "stage").agg(kept.alias("status"), F.max_by("message", "seq").alias("message"), F.count("*").alias("events"))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENT).json(path)


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    status, message, n = state.get if state.exists else (None, None, 0)
    rows = pd.concat(list(frames)).sort_values("seq")
    for s, m in zip(rows["status"], rows["message"]):
        n += 1
        message = m
        if s != "warning":
            status = s
        elif status not in FINAL:
            status = "running"
    state.update((status, message, n))
    yield pd.DataFrame([(key[0], key[1], status, message, n)], columns=["run_id", "stage", "status", "message", "events"])


def stream_status(events: DataFrame) -> DataFrame:
    """Stream (output mode update): the state of each stage that a micro-batch changes."""
    return events.groupBy("run_id", "stage").applyInPandasWithState(_fold, "run_id string, stage string, status string, message string, events long", "status string, message string, events long", "update", "NoTimeout")
