"""Connected parts of a graph and positions along its paths, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape.functions.staging import stage


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that is connected with it, for every node of `edges` (u, v).

    Star contraction: every node points its larger neighbours to its smallest one, then its
    smaller neighbours likewise, until nothing changes. Each round's edges are written, so the
    lineage stays short; a round takes a plain minimum per node, so a node of many edges is summed
    up before the shuffle. Loops make a node a part of its own; NULL ends are ignored.
    """
    known = edges.where("u is not null and v is not null")
    now = stage(known.where("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "links")
    state = None
    while (mark := _mark(now)) != state:
        state = mark
        around = now.union(now.selectExpr("v", "u"))
        nearest = around.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = around.where("v > u").join(nearest, "u").selectExpr("v as u", "m as v").distinct()
        large = stage(large.where("u <> v"), "links")
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").where("v <> m").selectExpr("greatest(v, m) as u", "least(v, m) as v")
        now = stage(small.union(nearest.selectExpr("u", "m as v")).distinct(), "links")
    # every edge leads from a node to its root
    nodes = known.selectExpr("explode(array(u, v)) as node").distinct()
    return nodes.join(now.selectExpr("u as node", "v as root"), "node", "left").selectExpr("node", "coalesce(root, node) as root")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def positions(steps: DataFrame, longest: int) -> DataFrame:
    """(at, position): how many steps lead from the start to `at`, for `steps` (at, before), where a
    start has NULL before, and paths have at most `longest` steps.

    Pointers are doubled: each round every place points to where its pointer pointed, so a path of
    n places takes log2(n) rounds of one join. Places that no start leads to are left out.
    """
    now = steps.selectExpr("at", "before", "if(before is null, 0L, 1L) as position")
    for _ in range(max(longest, 1).bit_length()):
        now = stage(now, "steps")
        far = now.selectExpr("at as before", "before as _next", "position as _more")
        now = now.join(far, "before", "left").selectExpr("at", "_next as before", "position + coalesce(_more, 0L) as position")
    return now.where("before is null").select("at", "position")
