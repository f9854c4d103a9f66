"""Overlapping, nested and gapped intervals per entity.

An ordered map of disjoint intervals is kept per key; an insertion finds the
overlapped ones by binary search, replaces them by their union and so opens,
narrows or closes the gaps between its neighbours.  The batch operator keeps one
such map per (key, block of positions), into which the intervals that start in the
block go as they come, in any order, with the farthest end that earlier blocks
reach; periods and gaps are read off the maps.  The streaming form
(folium.streaming.intervals) keeps the maps in keyed state.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folium.runtime import materialize

#: Positions that one map covers. A map holds at most half as many intervals.
BLOCK = 1 << 16


class IntervalMap:
    """Disjoint inclusive integer intervals in ascending order; neighbours that touch are one."""

    __slots__ = ("starts", "ends")

    def __init__(self, starts: list[int] | None = None, ends: list[int] | None = None):
        self.starts, self.ends = list(starts or []), list(ends or [])

    def insert(self, start: int, end: int) -> bool:
        """Add an interval; False if it was covered already."""
        i = bisect_left(self.ends, start - 1)  # the first that touches from the left
        j = bisect_right(self.starts, end + 1)  # past the last that touches from the right
        if i < j:
            if j - i == 1 and self.starts[i] <= start and end <= self.ends[i]:
                return False
            start, end = min(start, self.starts[i]), max(end, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [start], [end]
        return True

    def periods(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends))

    def gaps(self) -> list[tuple[int, int]]:
        return [(e + 1, s - 1) for e, s in zip(self.ends, self.starts[1:])]


_SPAN = "blk long, span_kind string, s long, e long"


def _map_blocks(key_type: pa.DataType, block: int):
    """Rows (key, blk, s, e, carry) grouped by (key, blk) -> what the block's map shows: whole periods and gaps, 'open' (s: a period begins whose end is not known here) and 'shut' (e: the period open before the block ends)."""
    schema = pa.schema([("key", key_type), ("blk", pa.int64()), ("span_kind", pa.string()), ("s", pa.int64()), ("e", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, carried, out = None, IntervalMap(), False, []

        def close():
            k, blk = current
            spans = state.periods()
            out.extend((k, blk, "gap", *g) for g in state.gaps())
            if carried and len(spans) > 1:
                out.append((k, blk, "shut", None, spans[0][1]))
            out.extend((k, blk, "period", *p) for p in spans[carried:-1])
            if len(spans) > carried:
                out.append((k, blk, "open", spans[-1][0], None))

        def batch():
            cols = list(zip(*out)) if out else [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for b in batches:
            for k, blk, s, e, carry in zip(*(c.to_pylist() for c in b.columns)):
                if (k, blk) != current:
                    if current is not None:
                        close()
                    current, state, carried = (k, blk), IntervalMap(), False
                carried |= carry
                state.insert(min(e, blk * block - 1) if carry else s, e)
            if len(out) > 10_000:
                yield batch()
                out = []
        if current is not None:
            close()
        yield batch()

    return run


def _before(df: DataFrame, value: str, name: str) -> DataFrame:
    """The greatest value of earlier blocks of the key (k, blk), by two levels of windows: over the blocks of a range of 65,536, and over such ranges."""
    df = df.withColumn("_far", F.shiftright("blk", 16))
    near = F.max(value).over(Window.partitionBy("k", "_far").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1))
    ranges = df.groupBy("k", "_far").agg(F.max(value).alias("_top"))
    ranges = ranges.select("k", "_far", F.max("_top").over(Window.partitionBy("k").orderBy("_far").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    return df.join(ranges, ["k", "_far"]).withColumn(name, F.greatest(near, "_earlier")).drop("_far", "_earlier")


def interval_spans(df: DataFrame, key: str, start: str, end: str, least: int | None = None, block: int = BLOCK) -> DataFrame:
    """Continuous covered periods of each key and the gaps between them: key, span_kind ('period' or 'gap'), span_start, span_end.

    Rows with a null key or bound, start > end, or start < least do not count.
    Repeated rows and ties change nothing; an empty input gives no rows; other
    columns are not read, so their names cannot clash.

    Plan: a partial aggregation keeps the farthest end per (key, start).  An
    interval belongs to the block in which it starts, uncut however long it is.
    Blocks are summed up in one row each, from which windows over bounded ranges of
    blocks give the farthest end before a block; with that end the block's map is
    complete for every gap in it.  A period that runs over several blocks is
    joined from its two ends by windows over such ends, at most two a block.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    k, s, e = F.col("k"), F.col("s"), F.col("e")
    rows = df.select(F.col(key).alias("k"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e"))
    rows = rows.where(k.isNotNull() & s.isNotNull() & e.isNotNull() & (s <= e))
    if least is not None:
        rows = rows.where(s >= least)
    exact = block & (block - 1) == 0  # for every long
    blk = F.shiftright(s, block.bit_length() - 1) if exact else F.floor(s / F.lit(block))
    rows = rows.groupBy("k", "s").agg(F.max("e").alias("e")).withColumn("blk", blk)
    ends = rows.groupBy("k", "blk").agg(F.max("e").alias("reach"))
    carry = _before(ends, "reach", "e").where(e.isNotNull()).select("k", "blk", F.lit(None).cast("long").alias("s"), "e", F.lit(True).alias("carry"))
    keyed = rows.select("k", "blk", "s", "e", F.lit(False).alias("carry")).unionByName(carry).repartition("k", "blk").sortWithinPartitions("k", "blk")
    kind = df.select(key).schema[0].dataType
    found = materialize(keyed.mapInArrow(_map_blocks(to_arrow_type(kind), block), f"key {kind.simpleString()}, {_SPAN}").withColumnRenamed("key", "k"), "spans")
    stubs = found.where("span_kind IN ('open', 'shut')").withColumn("_far", F.shiftright("blk", 16))
    at = F.coalesce("s", "e")
    shut = F.first("e", ignorenulls=True)
    near = shut.over(Window.partitionBy("k", "_far").orderBy(at, "span_kind").rowsBetween(1, Window.unboundedFollowing))
    ranges = stubs.groupBy("k", "_far").agg(F.min("e").alias("_e"))
    later = F.first("_e", ignorenulls=True).over(Window.partitionBy("k").orderBy("_far").rowsBetween(1, Window.unboundedFollowing))
    ranges = ranges.select("k", "_far", later.alias("_later"))
    last = ends.groupBy("k").agg(F.max("reach").alias("_last"))
    joined = stubs.withColumn("_near", near).where("span_kind = 'open'").join(ranges, ["k", "_far"]).join(last, "k")
    joined = joined.select("k", F.lit("period").alias("span_kind"), "s", F.coalesce("_near", "_later", "_last").alias("e"))
    out = found.where("span_kind IN ('period', 'gap')").select("k", "span_kind", "s", "e").unionByName(joined)
    return out.select(F.col("k").alias(key), "span_kind", F.col("s").alias("span_start"), F.col("e").alias("span_end"))


def merge_intervals(df: DataFrame, key: str, start: str, end: str, least: int | None = None, block: int = BLOCK) -> DataFrame:
    """Continuous covered periods per key: columns key, period_start, period_end (see interval_spans)."""
    spans = interval_spans(df, key, start, end, least, block).where("span_kind = 'period'")
    return spans.select(key, F.col("span_start").alias("period_start"), F.col("span_end").alias("period_end"))
