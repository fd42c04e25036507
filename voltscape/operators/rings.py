"""Areas of nested map extracts: rings put together from the ways of a relation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape.functions.graph import connected, positions
from voltscape.functions.staging import stage
from voltscape.sources.tables import whole_ways

RESIDENTIAL = "tags['landuse'] = 'residential'"
#: A ring is made of ways of one role of one relation of one document.
OWNER = ["document", "relation", "role"]


@dataclass
class Areas:
    """`rings`: document, area (`way/id` or `relation/id`), role, ring (its smallest way) and the
    closed `coordinates`. `open`: document, relation, role, ring (the smallest way), ways, open_ends,
    branches: what could not be closed."""

    rings: DataFrame
    open: DataFrame


def members(elements: DataFrame, wanted: str) -> DataFrame:
    """(document, relation, role, way) of the relations that are `wanted`, each once; a member
    without a role is an outer one."""
    listed = elements.where(f"type = 'relation' and ({wanted})").select(
        "document", F.col("id").alias("relation"), F.inline("members")
    )
    return listed.where("type = 'way' and ref is not null").selectExpr(
        "document", "relation", "coalesce(nullif(role, ''), 'outer') as role", "ref as way"
    ).distinct()


def areas(elements: DataFrame, wanted: str = RESIDENTIAL) -> Areas:
    """The rings of all wanted areas: closed ways with the tags themselves, and the member ways of
    wanted relations.

    A closed member way is a ring. Open ones are joined where they end at the same node: ways that
    hang together (star contraction over their end nodes) are a ring if each end node joins exactly
    two of them. Such a ring is walked from its smallest way, in the direction that way is stored,
    and ways met backwards are turned round. Other parts are `open`: with ends that nothing joins
    (open_ends), as where the extract lacks a way or one of a way's nodes, or with nodes that join
    more than two ways (branches).
    """
    lines = stage(whole_ways(elements), "ways")
    own = lines.where(f"({wanted}) and closed").selectExpr(
        "document", "concat('way/', way) as area", "'outer' as role", "way as ring", "coordinates"
    )
    parts = stage(
        lines.join(members(elements, wanted), ["document", "way"]).selectExpr(
            *OWNER, "way", "closed", "size(nodes) as n", "nodes[0] as _from", "element_at(nodes, -1) as _to", "coordinates"
        ),
        "parts",
    )
    named = [*OWNER[:1], "concat('relation/', relation) as area", "role"]
    whole = parts.where("closed").selectExpr(*named, "way as ring", "coordinates")
    owner = ", ".join(OWNER)
    # ways of one place, or that end where they start without being a ring, join nothing
    edges = parts.where("not closed").selectExpr(
        *OWNER, "way", f"struct({owner}, _from as node) as u", f"struct({owner}, _to as node) as v"
    )
    edges = stage(edges, "edges")
    roots = stage(connected(edges.select("u", "v")), "roots")
    ends = edges.selectExpr("explode(array(u, v)) as node").groupBy("node").agg(F.count(F.lit(1)).alias("ends"))
    nodes = ends.join(roots, "node").groupBy("root").agg(
        F.sum(F.expr("if(ends = 1, 1L, 0L)")).alias("open_ends"), F.sum(F.expr("if(ends > 2, 1L, 0L)")).alias("branches")
    )
    ways = edges.join(roots.withColumnRenamed("node", "u"), "u")
    tied = ways.groupBy("root").agg(F.min("way").alias("ring"), F.count(F.lit(1)).alias("ways"))
    rated = stage(tied.join(nodes, "root").selectExpr(
        "root", "ring", "ways", "open_ends", "branches", "open_ends = 0 and branches = 0 and ways > 1 as whole"
    ), "rated")
    left = rated.where("not whole").select(*(F.col(f"root.{c}") for c in OWNER), "ring", "ways", "open_ends", "branches")

    # each way both ways round; the walk follows the directed cycle of the first one
    good = ways.join(rated.where("whole").select("root", "ring"), "root")
    arcs = stage(
        good.selectExpr(
            "root", "ring", "inline(array(struct(way, true as ahead, u as tail, v as tip), struct(way, false as ahead, v as tail, u as tip)))"
        ),
        "arcs",
    )
    at = "struct(root, {0}way as way, {0}ahead as ahead)"
    before = arcs.selectExpr("root", "tip as tail", "way as _way", "ahead as _ahead")
    steps = arcs.join(before, ["root", "tail"]).where("way <> _way").selectExpr(
        f"{at.format('')} as at", f"if(way = ring and ahead, null, {at.format('_')}) as before"
    )
    longest = rated.agg(F.max(F.expr("if(whole, ways, 0L)"))).first()[0] or 0
    placed = positions(steps, longest).selectExpr("at.root as root", "at.way as way", "at.ahead as ahead", "position")
    walked = placed.join(rated.select("root", "ring"), "root").selectExpr(
        *(f"root.{c} as {c}" for c in OWNER), "ring", "way", "ahead", "position"
    )
    bodies = parts.where("not closed").select(*OWNER, "way", "coordinates")
    # the last vertex of a way is the first of the next
    turned = "if(ahead, coordinates, reverse(coordinates))"
    piece = f"struct(position, slice({turned}, 1, size(coordinates) - 1) as part)"
    put = walked.join(bodies, [*OWNER, "way"]).groupBy(*OWNER, "ring").agg(
        F.expr(f"flatten(transform(array_sort(collect_list({piece})), p -> p.part))").alias("_open")
    )
    closed = put.selectExpr(*named, "ring", "concat(_open, slice(_open, 1, 1)) as coordinates")
    return Areas(own.unionByName(whole).unionByName(closed), left)
