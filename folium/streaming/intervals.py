"""Periods and gaps of a stream of intervals: ordered disjoint-interval maps in keyed state.

The state of a key is cut by blocks of positions, so no state grows with a key's
rows, and a micro-batch sends on only what it changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.operators.intervals import BLOCK, IntervalMap, interval_spans
from folium.runtime import shared_path

OUT = "k string, blk long, s long, e long, change int"
STATE = "starts array<long>, ends array<long>"


def _update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    spans = IntervalMap(*state.get) if state.exists else IntervalMap()
    old = set(spans.periods())
    changed = [spans.insert(s, e) for f in frames for s, e in zip(f["s"].tolist(), f["e"].tolist())]
    if not any(changed):
        return
    state.update((spans.starts, spans.ends))
    new = set(spans.periods())
    rows = [(*key, *p, -1) for p in old - new] + [(*key, *p, 1) for p in new - old]
    yield pd.DataFrame(rows, columns=["k", "blk", "s", "e", "change"])


def stream_pieces(stream: DataFrame, key: str, start: str, end: str, least: int | None = None, block: int = BLOCK) -> DataFrame:
    """Changes (output mode update) of the covered pieces of each key and block of positions: k, blk, s, e, change (1: came, -1: gone). Rows with null or unusable bounds are ignored; a long interval is cut at the blocks' borders."""
    ok = F.col("k").isNotNull() & F.col("s").isNotNull() & F.col("e").isNotNull() & (F.col("s") <= F.col("e"))
    rows = stream.select(F.col(key).cast("string").alias("k"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e")).where(ok)
    if least is not None:
        rows = rows.where(F.col("s") >= least)
    shift = block.bit_length() - 1
    rows = rows.withColumn("blk", F.explode(F.sequence(F.shiftright("s", shift), F.shiftright("e", shift))))
    rows = rows.select("k", "blk", F.greatest("s", F.shiftleft("blk", shift)).alias("s"), F.least("e", F.shiftleft(F.col("blk") + 1, shift) - 1).alias("e"))
    return rows.groupBy("k", "blk").applyInPandasWithState(_update, OUT, STATE, "update", "NoTimeout")


def spans_of_changes(changes: DataFrame) -> DataFrame:
    """Periods and gaps of all changes so far: k, span_kind, span_start, span_end."""
    pieces = changes.groupBy("k", "blk", "s", "e").agg(F.sum("change").alias("n")).where("n > 0")
    return interval_spans(pieces, "k", "s", "e")


def drain_spans(spark: SparkSession, stream: DataFrame, key: str, start: str, end: str, least: int | None = None) -> DataFrame:
    """Run the stream over all that is there now and give its periods and gaps. Each micro-batch writes its changes under its own number, so one that is repeated after a failure counts once."""
    folder = shared_path(spark, "stream")
    write = lambda df, n: df.write.mode("overwrite").parquet(f"{folder}/changes/batch={n}")
    q = stream_pieces(stream, key, start, end, least).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    q.awaitTermination()
    return spans_of_changes(spark.read.schema(OUT).option("recursiveFileLookup", "true").parquet(f"{folder}/changes"))
