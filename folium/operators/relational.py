"""Joins, deduplication, top-k and sequence operators over document tables.

Order matters in these tables, so each operator takes the ordinal column that
breaks ties; results never depend on the order in which rows are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folium.operators.intervals import merge_intervals
from folium.runtime import materialize


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes first in the order. One aggregation (partial before the shuffle), no window: a hot key costs no task more."""
    key = F.struct(*[F.when(F.lit(True), c).alias(f"o{i}") for i, c in enumerate(order)])
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), key).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def argmax(df: DataFrame, keys: list[str], score: list[str], ordinal: str) -> DataFrame:
    """The row of each key with the highest score columns (nulls lowest); ties go to the lowest ordinal."""
    key = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))).alias(c) for c in score], (-F.col(ordinal)).alias("_o"))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), key).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def prefer(inputs: list[DataFrame], keys: list[str], ordinal: str) -> DataFrame:
    """Union of inputs in which an earlier input's row wins over a later one's for the same key; within one input the lowest ordinal."""
    tagged = [d.withColumn("_p", F.lit(i)) for i, d in enumerate(inputs)]
    return first_per_key(reduce(DataFrame.unionByName, tagged), keys, [F.col("_p"), F.col(ordinal)]).drop("_p")


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; Spark prunes each partition to n per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


#: Positions of a key that one window sees; neighbours and sums beyond come from one summary row a block.
BLOCK = 4096


def _blocks(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.withColumn("_blk", F.shiftright(F.col(order).cast("long"), BLOCK.bit_length() - 1))


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be null; the right side's keys go."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, reduce(lambda a, b: a & b, on), how).drop(*[f"_r_{k}" for k in keys])


def with_neighbours(df: DataFrame, keys: list[str], order: str, values: list[str], ties: tuple[str, ...] = (), before: bool = True, after: bool = True) -> DataFrame:
    """Adds prev and next: structs of values of the rows before and after within the key, by a whole number (not null) and ties.

    A window sees one block of positions; the rows at its edges get their neighbours
    from the blocks' first and last rows, one summary row a block, so a key that holds
    much of the table is spread over many tasks.  The rows are read twice: store what
    is costly to compute, in few columns.
    """
    d = _blocks(df, keys, order)
    by = F.struct(F.col(order).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])
    item = F.struct(*values)
    w = Window.partitionBy(*keys, "_blk").orderBy(order, *ties)
    out = d.withColumn("_in", F.struct(F.lag(item).over(w).alias("p"), F.lead(item).over(w).alias("n")))
    ends = d.groupBy(*keys, "_blk").agg(F.min_by(item, by).alias("_a"), F.max_by(item, by).alias("_z"))
    far = Window.partitionBy(*keys).orderBy("_blk")
    ends = ends.select(*keys, "_blk", F.lag("_z").over(far).alias("_fp"), F.lead("_a").over(far).alias("_fn"))
    out = same_keys(out, ends, [*keys, "_blk"])
    if before:
        out = out.withColumn("prev", F.coalesce("_in.p", "_fp"))
    if after:
        out = out.withColumn("next", F.coalesce("_in.n", "_fn"))
    return out.drop("_in", "_fp", "_fn", "_blk")


def running_sum(df: DataFrame, keys: list[str], order: str, value: Column, name: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds the sum of a value over the key's rows up to each row, by a whole number (not null) and ties; blocks as in with_neighbours."""
    d = _blocks(df, keys, order).withColumn("_v", value)
    own = F.sum("_v").over(Window.partitionBy(*keys, "_blk").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0))
    sums = d.groupBy(*keys, "_blk").agg(F.sum("_v").alias("_s"))
    base = F.sum("_s").over(Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*keys, "_blk", F.coalesce(base, F.lit(0)).alias("_base"))
    return same_keys(d.withColumn("_own", own), sums, [*keys, "_blk"]).withColumn(name, F.col("_own") + F.col("_base")).drop("_v", "_own", "_base", "_blk")


def _level(length: Column, cell: int) -> Column:
    """The least level whose cells (cell ** (level + 1) positions) are as long as a range: it touches two of them at most."""
    out = F.lit(0)
    for k in range(1, 11):
        out = F.when(length > float(cell) ** k, k).otherwise(out)
    return out


def range_join(points: DataFrame, ranges: DataFrame, on: list[str], point: str, start: str, end: str, cell: int = 64) -> DataFrame:
    """Points within inclusive ranges of the same key, by an equi-join on (key, level, cell): a range goes to the one or two cells that it touches at the level of its own length, a point to its cell at each level that occurs.

    Null and reversed ranges match nothing; a range of any length is two rows at
    most. The levels that occur (eleven at most) are looked up beforehand. Columns:
    all of both sides.
    """
    ok = F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))
    r = ranges.where(ok).withColumn("_level", _level(F.col(end).cast("double") - F.col(start) + 1, cell))
    levels = sorted(x[0] for x in r.select("_level").distinct().collect())
    at = lambda c, k: F.floor(c / F.lit(float(cell) ** (k + 1)))
    both = F.lit(None).cast("array<bigint>")
    for k in levels:
        both = F.when(F.col("_level") == k, F.array_distinct(F.array(at(F.col(start), k), at(F.col(end), k)))).otherwise(both)
    r = r.withColumn("_cell", F.explode(both))
    cells = F.array(*[F.struct(F.lit(k).alias("_level"), at(F.col(point), k).alias("_cell")) for k in levels or [0]])
    p = points.withColumn("_c", F.explode(cells)).select("*", "_c._level", "_c._cell").drop("_c")
    return p.join(r, [*on, "_level", "_cell"]).where(F.col(point).between(F.col(start), F.col(end))).drop("_level", "_cell")


def missing_ranges(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Ranges of whole numbers between each key's least and greatest value that no row has: keys, below, first, last, above (the values at both sides)."""
    v = materialize(df.where(F.col(value).isNotNull()).select(*keys, value).distinct(), "values")
    g = with_neighbours(v, keys, value, [value], before=False).where(F.col(f"next.{value}") > F.col(value) + 1)
    return g.select(*keys, F.col(value).alias("below"), (F.col(value) + 1).alias("first"), (F.col(f"next.{value}") - 1).alias("last"), F.col(f"next.{value}").alias("above"))


def islands(df: DataFrame, keys: list[str], order: list[Column], breaks: Column) -> DataFrame:
    """Number the runs of each key: a row for which `breaks` is true (or null) begins a new one. Adds column island from 1. For keys of a bounded number of rows; see islands_by."""
    w = Window.partitionBy(*keys).orderBy(*order)
    b = F.when(F.coalesce(breaks, F.lit(True)), 1).otherwise(0)
    return df.withColumn("_b", b).withColumn("island", F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_b")


def islands_by(df: DataFrame, keys: list[str], order: str, breaks: Column, ties: tuple[str, ...] = ()) -> DataFrame:
    """islands() by a whole number, in blocks of positions."""
    return running_sum(df, keys, order, F.when(F.coalesce(breaks, F.lit(True)), 1).otherwise(0), "island", ties)


def last_known(df: DataFrame, keys: list[str], order: str, value: Column, name: str, ties: tuple[str, ...] = (), after: bool = False) -> DataFrame:
    """Adds the last value that is not null up to each row (after: the first from it on), by a whole number and ties; blocks as in with_neighbours."""
    d = _blocks(df, keys, order).withColumn("_v", value)
    by = F.struct(F.col(order).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])
    w, far = Window.partitionBy(*keys, "_blk").orderBy(order, *ties), Window.partitionBy(*keys).orderBy("_blk")
    pick, end = (F.first, F.min_by) if after else (F.last, F.max_by)
    span = (0, Window.unboundedFollowing) if after else (Window.unboundedPreceding, 0)
    beyond = (1, Window.unboundedFollowing) if after else (Window.unboundedPreceding, -1)
    ends = d.where(F.col("_v").isNotNull()).groupBy(*keys, "_blk").agg(end("_v", by).alias("_e"))
    every = d.select(*keys, "_blk").distinct()
    ends = same_keys(every, ends, [*keys, "_blk"]).select(*keys, "_blk", pick("_e", ignorenulls=True).over(far.rowsBetween(*beyond)).alias("_f"))
    d = d.withColumn("_own", pick("_v", ignorenulls=True).over(w.rowsBetween(*span)))
    return same_keys(d, ends, [*keys, "_blk"]).withColumn(name, F.coalesce("_own", "_f")).drop("_v", "_own", "_f", "_blk")


def fill_sequence(df: DataFrame, keys: list[str], order: str, value: str, name: str = "filled") -> DataFrame:
    """Fill null numbers from their neighbours: inside only if both sides agree on a step of one per row, before the first by counting back (from 1 on), after the last by counting on."""
    d = materialize(running_sum(materialize(df, "sequence"), keys, order, F.lit(1), "_n"), "numbered")
    at = F.when(F.col(value).isNotNull(), F.struct(F.col("_n").alias("n"), F.col(value).alias("v")))
    d = last_known(last_known(d, keys, order, at, "_p"), keys, order, at, "_q", after=True)
    up, down = F.col("_p.v") + F.col("_n") - F.col("_p.n"), F.col("_q.v") - (F.col("_q.n") - F.col("_n"))
    out = (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(F.col("_p").isNotNull() & F.col("_q").isNotNull(), F.when(up == down, up))
        .when(F.col("_q").isNotNull(), F.when(down >= 1, down))
        .when(F.col("_p").isNotNull(), up)
    )
    return d.withColumn(name, out).drop("_n", "_p", "_q")


def neighbours(df: DataFrame, keys: list[str], order: str, ident: str, ties: tuple[str, ...] = (), prev: str = "prev_id", next_: str = "next_id") -> DataFrame:
    """Ids of the previous and the next row of the key, by a whole number (null counts as the least) and ties."""
    d = with_neighbours(df.withColumn("_order", F.coalesce(order, F.lit(-(1 << 62)))), keys, "_order", [ident], ties)
    return d.withColumn(prev, F.col(f"prev.{ident}")).withColumn(next_, F.col(f"next.{ident}")).drop("_order", "prev", "next")


def next_starts(df: DataFrame, keys: list[str], start: str, last: Column, name: str = "end") -> DataFrame:
    """Close each span before the next one begins; the last ends at `last`."""
    d = with_neighbours(df, keys, start, [start], before=False)
    return d.withColumn(name, F.coalesce(F.col(f"next.{start}") - 1, last)).drop("next")


def sliding_windows(df: DataFrame, keys: list[str], position: str, size: int, stride: int) -> DataFrame:
    """Assign each position (from 0) to all windows [k * stride, k * stride + size) that hold it; short tails come out too. Adds column window_id."""
    first = F.greatest(F.lit(0), F.ceil((F.col(position) - size + 1) / stride)).cast("long")
    return df.withColumn("window_id", F.explode(F.sequence(first, F.floor(F.col(position) / stride).cast("long"))))


def _stretches(df: DataFrame, key: str, start: str, end: str, ordinal: str) -> DataFrame:
    """Adds _stretch, the beginning of the connected stretch of the key in which a span lies."""
    periods = merge_intervals(df, key, start, end)
    p = periods.select(F.col(key).alias("_k"), F.col("period_start").alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_id"))
    q = df.select(F.col(key).alias("_k"), F.col(start).cast("long").alias("_at"), F.lit(1).alias("_kind"), F.col(ordinal).cast("long").alias("_id"))
    both = last_known(p.unionByName(q), ["_k"], "_at", F.when(F.col("_kind") == 0, F.col("_at")), "_stretch", ("_kind", "_id"))
    return df.join(both.where("_kind = 1").select(F.col("_id").alias(ordinal), "_stretch"), ordinal)


def greedy_non_overlap(df: DataFrame, keys: list[str], start: str, end: str, rank: list[Column], ordinal: str) -> DataFrame:
    """Keep spans in rank order unless they overlap a kept one of the same key (one key column; ties by ordinal).

    The choice is sequential only within a connected stretch of spans; stretches are
    spread over the tasks, read as a stream in rank order, and what is kept of one is
    a map of disjoint intervals, so a span costs one binary search.
    """
    key = keys[0]
    d = _stretches(df, key, start, end, ordinal)
    rows = d.select(F.col(key).alias("k"), "_stretch", F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)], F.col(ordinal).alias("o")).alias("r"), F.col(ordinal).cast("long").alias("o"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e"))
    rows = rows.repartition("k", "_stretch").sortWithinPartitions("k", "_stretch", "r").select("k", "_stretch", "o", "s", "e")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, starts, ends = None, [], []
        for b in batches:
            kept = []
            for k, stretch, o, s, e in zip(*(c.to_pylist() for c in b.columns)):
                if (k, stretch) != at:
                    at, starts, ends = (k, stretch), [], []
                i = bisect_left(ends, s)
                if i == len(ends) or starts[i] > e:
                    starts.insert(i, s)
                    ends.insert(i, e)
                    kept.append(o)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], names=["o"])

    kept = rows.mapInArrow(run, "o long").withColumnRenamed("o", ordinal)
    return df.join(kept, ordinal, "left_semi")


def uncovered_share(coarse: DataFrame, fine: DataFrame, keys: list[str], start: str, end: str, ident: str) -> DataFrame:
    """Per coarse span the share of its pages that no fine span of the same key covers: ident, pages, uncovered, share (one key column; null and reversed spans are left out).

    By interval arithmetic, whatever the length: the covered pages up to a place are
    the lengths of the fine periods that begin by then, less what the last one has
    beyond; a coarse span takes the difference of two places.
    """
    key = keys[0]
    c = coarse.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
    period = merge_intervals(fine, key, start, end).select(F.col(key).alias("_k"), F.col("period_start").alias("_at"), F.lit(0).alias("_kind"), F.col("period_end").alias("_e"), F.lit(None).cast("long").alias("_id"), F.lit(0).alias("_side"))
    side = F.explode(F.array(F.struct((F.col(start) - 1).cast("long").alias("_at"), F.lit(-1).alias("_side")), F.struct(F.col(end).cast("long").alias("_at"), F.lit(1).alias("_side"))))
    places = c.select(F.col(key).alias("_k"), F.col(ident).cast("long").alias("_id"), side.alias("x")).select("_k", "x._at", F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_e"), "_id", "x._side")
    ties = ("_kind", "_id", "_side")
    d = running_sum(period.unionByName(places), ["_k"], "_at", F.coalesce(F.col("_e") - F.col("_at") + 1, F.lit(0)), "_sum", ties)
    d = last_known(d, ["_k"], "_at", F.col("_e"), "_last", ties).where("_kind = 1")
    upto = F.col("_sum") - F.greatest(F.coalesce(F.col("_last") - F.col("_at"), F.lit(0)), F.lit(0))
    covered = d.groupBy(F.col("_id").alias(ident)).agg(F.sum(upto * F.col("_side")).alias("_covered"))
    out = c.select(ident, (F.col(end) - F.col(start) + 1).alias("pages")).join(covered, ident)
    return out.select(ident, "pages", (F.col("pages") - F.col("_covered")).alias("uncovered"), ((F.col("pages") - F.col("_covered")) / F.col("pages")).alias("share"))


def latest(df: DataFrame, keys: list[str], at: str, ordinal: str) -> DataFrame:
    """The row of each key with the greatest time; ties go to the greatest ordinal."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(at, ordinal)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def ordered_text(df: DataFrame, keys: list[str], order: list[Column], text: str, sep: str, name: str = "text") -> DataFrame:
    """Texts of a key joined in order."""
    items = F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(text).alias("t"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(items, lambda x: x.t), sep).alias(name))


def most_common(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """The n most frequent values of each key with counts; ties by value."""
    c = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("times"))
    return top_n(c, keys, [F.desc("times"), F.col(value)], n)


def pareto(df: DataFrame, ident: str, score: str, costs: list[str]) -> DataFrame:
    """Rows of an evaluation summary that no other row beats: at least as good in score and all costs, better in one. Only equal or better scores meet, by a range condition in one join."""
    b = df.select(F.col(score).alias("_s"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(costs)])
    as_good = reduce(lambda x, y: x & y, [F.col(f"_{i}") <= F.col(c) for i, c in enumerate(costs)], F.col("_s") >= F.col(score))
    better = reduce(lambda x, y: x | y, [F.col(f"_{i}") < F.col(c) for i, c in enumerate(costs)], F.col("_s") > F.col(score))
    return df.join(b, as_good & better, "left_anti")
