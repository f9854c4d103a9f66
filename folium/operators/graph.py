"""Link graphs between numbered sections, entries or stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folium.runtime import materialize, release


def reachable(edges: DataFrame, starts: DataFrame, scope: str = "scope", src: str = "src", dst: str = "dst", wide: int = 4) -> DataFrame:
    """Nodes that can be reached from the starts of the same scope, starts included: scope, node, hops (fewest).

    Links are doubled: in round k they span 2^k steps, and one join takes all nodes
    known so far that far on, so a chain of n links takes log2(n) rounds; cycles end
    as nothing new comes.  Where branches make the doubled links more than `wide`
    times the links, single steps go on from the last nodes found (breadth first).
    Every round is written to the shared folder; no length is left out.
    """
    e = materialize(edges.select(F.col(scope).alias("scope"), F.col(src).alias("src"), F.col(dst).alias("dst")).where(F.col("src").isNotNull() & F.col("dst").isNotNull()).distinct(), "links")
    seen = materialize(starts.select(F.col(scope).alias("scope"), F.col("node"), F.lit(0).cast("long").alias("hops")).distinct(), "seen")
    few = max(1, e.count())
    jump, span = e, 1
    while True:
        on = seen.join(jump, (seen.scope == jump.scope) & (seen.node == jump.src)).select(seen.scope, jump.dst.alias("node"), (seen.hops + span).alias("hops"))
        fresh = on.join(seen.select("scope", "node"), ["scope", "node"], "left_anti").groupBy("scope", "node").agg(F.min("hops").alias("hops"))
        fresh = materialize(fresh, "fresh")
        if fresh.isEmpty():
            return seen
        known, seen = seen, materialize(seen.unionByName(fresh), "seen")
        release(known, fresh)
        a, b = jump.alias("a"), jump.alias("b")
        twice = materialize(a.join(b, (F.col("a.scope") == F.col("b.scope")) & (F.col("a.dst") == F.col("b.src"))).select("a.scope", "a.src", "b.dst").distinct(), "jumps")
        if twice.count() > wide * few:
            break
        if jump is not e:
            release(jump)
        jump, span = twice, 2 * span
    front = seen
    while True:
        step = front.join(e, (front.scope == e.scope) & (front.node == e.src)).select(front.scope, e.dst.alias("node"), (front.hops + 1).alias("hops"))
        front = materialize(step.join(seen.select("scope", "node"), ["scope", "node"], "left_anti").groupBy("scope", "node").agg(F.min("hops").alias("hops")), "frontier")
        if front.isEmpty():
            return seen
        known, seen = seen, materialize(seen.unionByName(front), "seen")
        release(known)


def dangling(edges: DataFrame, nodes: DataFrame, scope: str = "scope", dst: str = "dst") -> DataFrame:
    """Links whose target is no node of the scope."""
    return edges.join(nodes.select(F.col(scope), F.col("node").alias(dst)).distinct(), [scope, dst], "left_anti")


def unreferenced(nodes: DataFrame, edges: DataFrame, scope: str = "scope", dst: str = "dst") -> DataFrame:
    """Nodes that no link of the scope names."""
    return nodes.join(edges.select(F.col(scope), F.col(dst).alias("node")).distinct(), [scope, "node"], "left_anti")


def toposort(needs: dict[str, list[str]]) -> list[str]:
    """Stages in an order that respects their needs, ties in the order given; unknown needs and cycles are errors."""
    for k, ns in needs.items():
        for n in ns:
            if n not in needs:
                raise ValueError(f"{k} needs {n}, which is not there")
    done: list[str] = []
    left = list(needs)
    while left:
        ready = next((k for k in left if all(n in done for n in needs[k])), None)
        if ready is None:
            raise ValueError("cycle among " + ", ".join(left))
        done.append(ready)
        left.remove(ready)
    return done
