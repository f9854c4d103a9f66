"""References to records that are missing, deleted or arrive later."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    """A child table's fields that name a parent's key within the same scope."""

    table: str
    frame: DataFrame
    fields: tuple[str, ...]
    row_id: str = "row_id"
    scope: str = "run_id"
    at: str = "arrived_at"
    parent: str = "parent"


def _children(refs: list[Reference]) -> DataFrame:
    def one(r: Reference) -> DataFrame:
        named = F.array(*[F.struct(F.lit(f).alias("ref_field"), F.col(f).alias("key")) for f in r.fields])
        rows = r.frame.select(F.lit(r.table).alias("ref_table"), F.lit(r.parent).alias("parent"), F.col(r.row_id).alias("row_id"), F.col(r.scope).alias("scope"), F.col(r.at).alias("t"), F.explode(named).alias("x"))
        return rows.select("ref_table", "parent", "row_id", "scope", "t", "x.ref_field", "x.key").where(F.col("key").isNotNull() & (F.col("key") != ""))

    return reduce(DataFrame.unionByName, map(one, refs))


def orphan_references(parents: DataFrame | dict[str, DataFrame], refs: list[Reference], key: str, scope: str = "run_id", at: str = "arrived_at", deleted: str = "deleted_at") -> DataFrame:
    """Orphans: ref_table, row_id, ref_field, orphan_kind, arrived_at.

    missing: no parent row has that scope and key (also where the scope is null);
    late: none of them arrived at or before the referring row; deleted: all that
    did were deleted by then.  A referring row without a time counts as late if
    the parent exists and as arriving after all deletions cannot be told.

    parents: one table, or several by the names that references carry as parent.
    Parent and child keys are united in long form with a tag and grouped once by
    parent table, scope and key.
    The grouping is algebraic (partial aggregation before the shuffle), so a key
    that holds a third of all rows costs no task more; a parent's times collapse
    to the steps at which its latest deletion time grows.  Only keys that can
    have an orphan go on to the join with the referring rows, whose hot keys
    the adaptive skew join splits.  Null and empty keys are no references;
    repeated rows are judged one by one.
    """
    child = _children(refs)
    named = parents if isinstance(parents, dict) else {"parent": parents}
    par = reduce(DataFrame.unionByName, [d.select(F.lit(n).alias("parent"), F.col(scope).alias("scope"), F.col(key).alias("key"), F.col(at).alias("a"), F.col(deleted).alias("d")) for n, d in named.items()])
    par = par.where(F.col("scope").isNotNull() & F.col("key").isNotNull())
    ever = F.lit("9999-12-31").cast("timestamp")
    # one row per key and time, then only the times at which the latest deletion grows
    par = par.where(F.col("a").isNotNull()).groupBy("parent", "scope", "key", "a").agg(F.max(F.coalesce("d", ever)).alias("d")).unionByName(
        par.where(F.col("a").isNull()).select("parent", "scope", "key", F.col("a"), F.lit(None).cast("timestamp").alias("d")).distinct()
    )
    w = Window.partitionBy("parent", "scope", "key").orderBy(F.col("a").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.max("d").over(w)
    par = par.withColumn("seen", seen).where(F.col("a").isNull() | F.col("seen").isNull() | (F.col("d") > F.col("seen")))
    long = par.select("parent", "scope", "key", F.struct("a", "d").alias("step"), F.lit(None).cast("timestamp").alias("t_min"), F.lit(None).cast("timestamp").alias("t_max"), F.lit(1).alias("is_parent")).unionByName(
        child.groupBy("parent", "scope", "key").agg(F.min(F.coalesce("t", F.lit("0001-01-01").cast("timestamp"))).alias("t_min"), F.max("t").alias("t_max")).select("parent", "scope", "key", F.lit(None).cast("struct<a:timestamp,d:timestamp>").alias("step"), "t_min", "t_max", F.lit(0).alias("is_parent"))
    )
    keys = long.groupBy("parent", "scope", "key").agg(
        F.max("is_parent").alias("has_parent"), F.min("t_min").alias("t_min"), F.max("t_max").alias("t_max"),
        F.array_sort(F.filter(F.collect_list("step"), lambda x: x.a.isNotNull())).alias("steps"),
    )
    first = F.element_at(F.filter("steps", lambda x: x.a.isNotNull()), 1)
    open_ = (F.col("has_parent") == 0) | (F.size("steps") == 0) | (first.a > F.col("t_min")) | F.exists("steps", lambda x: x.d <= F.col("t_max"))
    keys = keys.where(F.col("t_min").isNotNull() & open_).select("parent", "scope", "key", "has_parent", "steps")
    hit = child.join(keys, (child.parent == keys.parent) & child.scope.eqNullSafe(keys.scope) & (child.key == keys.key), "inner").select(child["*"], "has_parent", "steps")
    past = F.filter("steps", lambda x: x.a <= F.col("t"))
    kind = (
        F.when(F.col("has_parent") == 0, "missing")
        .when(F.size(past) == 0, "late")
        .when(F.element_at(past, -1).d <= F.col("t"), "deleted")
    )
    out = hit.select("ref_table", "row_id", "ref_field", kind.alias("orphan_kind"), F.col("t").alias("arrived_at"))
    return out.where(F.col("orphan_kind").isNotNull())


def orphans_by_period(orphans: DataFrame, unit: str = "month") -> DataFrame:
    """Counts per table, field, kind and period of the referring rows' arrival."""
    return orphans.groupBy("ref_table", "ref_field", "orphan_kind", F.date_format(F.date_trunc(unit, "arrived_at"), "yyyy-MM-dd").alias("period")).agg(F.count("*").alias("orphans"))
