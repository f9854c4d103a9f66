"""Bounded repair loops and a keyed cache, each round in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.runtime import materialize


def repair_loop(df: DataFrame, faults: Callable[[DataFrame], DataFrame], repair: Callable[[DataFrame, DataFrame], DataFrame], retries: int) -> tuple[DataFrame, int, bool]:
    """Find faults and repair until there are none or the retries are used up: (rows, rounds of repair, whether clean). Each round's rows are written, so a lost executor repeats no round."""
    state = materialize(df, "loop")
    for n in range(retries + 1):
        bad = materialize(faults(state), "faults")
        if bad.isEmpty():
            return state, n, True
        if n < retries:
            state = materialize(repair(state, bad), "loop")
    return state, retries, False


def with_cache(pages: DataFrame, cache: DataFrame | None, keys: list[str], valid_if: str, compute: Callable[[DataFrame], DataFrame], value: str) -> tuple[DataFrame, DataFrame]:
    """(pages with value, the cache to keep): a cached value counts if `valid_if` (such as the image's path) is still the same; the others are computed, and only they.

    cache: keys, valid_if, value.  A key may come once; entries of other keys stay.
    """
    if cache is None:
        fresh = materialize(compute(pages), "computed")
        return fresh, fresh.select(*keys, valid_if, value)
    c = cache.select(*keys, F.col(valid_if).alias("_v"), F.col(value).alias("_x"), F.lit(1).alias("_in"))
    d = materialize(pages.join(c, keys, "left").withColumn("_hit", F.coalesce((F.col("_in") == 1) & F.col(valid_if).eqNullSafe(F.col("_v")), F.lit(False))), "looked-up")
    hit = d.where("_hit").withColumn(value, F.col("_x")).drop("_v", "_x", "_in", "_hit")
    new = materialize(compute(d.where("NOT _hit").drop("_v", "_x", "_in", "_hit")), "computed")
    rest = cache.join(pages.select(*keys).distinct(), keys, "left_anti").select(*keys, valid_if, value)
    both = hit.unionByName(new)
    return both, rest.unionByName(both.select(*keys, valid_if, value))
