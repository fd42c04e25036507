"""Distances from places to lines and areas of any kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions import geo, wkt
from voltscape.functions.joins import BROADCAST_ROWS, is_small, lookup_pairs, spread_join
from voltscape.functions.staging import stage
from voltscape.operators.spatial import CUT, _cell, _squared, _steps_needed, lines_within

#: Steps of cells, each half as wide as the one before, in which areas are looked up by their size.
LEVELS = 24
#: Edges of an area that share one strip of longitudes, about.
EDGES_PER_STRIP = 8


def read_shapes(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Geometry text to `kind` and `parts` (see `wkt`), both NULL where the text is none."""
    # exploded, so that the text is parsed once however often its columns are used
    parsed = F.explode(F.array(wkt.geometry(geometry))).alias("_shape")
    return df.select(*(c for c in df.columns if c != geometry), parsed).selectExpr(
        *(f"`{c}`" for c in df.columns if c != geometry), "_shape.kind as kind", "_shape.parts as parts"
    )


def _edges(areas: DataFrame, key: str) -> DataFrame:
    """Edges (x1, y1, x2, y2) of all rings of each area, unrolled to a stretch of longitudes without a
    jump: each vertex is at most half a turn from the one before, and rings from the first one."""
    ends = "slice({0}, 1, size({0}) - 1)", "slice({0}, 2, size({0}) - 1)"
    pairs = f"zip_with({ends[0].format('ring')}, {ends[1].format('ring')}, (a, b) -> struct(a, b))"
    near = "({0} + pmod({1} - {0} + 180D, 360D) - 180D)"
    rows = areas.where(f"{wkt.is_area('kind')} and size(parts) > 0").selectExpr(key, "flatten(parts) as _rings")
    rows = rows.selectExpr(key, "_rings[0][0].lon as _origin", "explode(_rings) as ring")
    rows = rows.selectExpr(key, "_origin", f"inline({pairs})")
    start = near.format("_origin", "a.lon")
    return rows.selectExpr(key, f"{start} as x1", "a.lat as y1", f"{near.format(start, 'b.lon')} as x2", "b.lat as y2")


def inside(places: DataFrame, areas: DataFrame, key: str, planar: bool = False) -> DataFrame:
    """(site_lon, site_lat, key): the distinct places inside each area of `areas` (key, kind, parts).

    A place is inside if the meridian from it to the north pole meets an odd number of edges, which
    are great circles, or straight in degrees if `planar`; with all rings of an area together,
    holes and several parts work out. An area lies on the side of its rings that holds no pole.

    An area is looked up in the at most four cells, of about its own size, that its box touches;
    a place looks into its cell of each size that occurs. Then only the edges of the strip of
    longitudes the place is in are tested, some EDGES_PER_STRIP however many the area has.
    """
    edges = stage(_edges(areas, key), "edges")
    box = edges.groupBy(key).agg(
        F.expr("min(least(x1, x2)) as _west"),
        F.expr("max(greatest(x1, x2)) as _east"),
        # a great circle rises above its ends, by less than its squared length in degrees
        F.expr("min(least(y1, y2)" + ("" if planar else " - least(pow(x2 - x1, 2), 180D)") + ") as _south"),
        F.expr("max(greatest(y1, y2)" + ("" if planar else " + least(pow(x2 - x1, 2), 180D)") + ") as _north"),
        F.count(F.lit(1)).alias("_n"),
    )
    size = "greatest(_east - _west, _north - _south, 1e-9D)"
    strips = f"greatest(cast(_n div {EDGES_PER_STRIP} as int), 1)"
    boxes = stage(
        box.selectExpr(
            "*", f"cast(least(greatest(floor(log2(360D / {size})), 0), {LEVELS}) as int) as _level", f"{strips} as _strips"
        ),
        "boxes",
    )
    levels = sorted(row._level for row in boxes.select("_level").distinct().collect())
    sites = places.selectExpr("lon as site_lon", "lat as site_lat").where("lon is not null and lat is not null").distinct()
    column = "cast(floor(({0} + 180D) / 360D * (1 << _level)) as bigint)"
    row = "cast(floor(({0} + 90D) / 360D * (1 << _level)) as bigint)"
    located = sites.selectExpr("*", f"explode(array({', '.join(map(str, levels)) or 'cast(null as int)'})) as _level").selectExpr(
        "*", f"pmod({column.format('site_lon')}, 1 << _level) as _x", f"{row.format('site_lat')} as _y"
    )
    covered = boxes.selectExpr(
        "*", f"explode(sequence({column.format('_west')}, least({column.format('_east')}, {column.format('_west')} + (1 << _level) - 1))) as _c"
    ).selectExpr("*", f"pmod(_c, 1 << _level) as _x", f"explode(sequence({row.format('_south')}, {row.format('_north')})) as _y").drop("_c")
    on = ["_level", "_x", "_y"]
    if is_small(sites, BROADCAST_ROWS // LEVELS):
        met = covered.join(F.broadcast(located), on)
    else:
        met = spread_join(located, covered, on)
    # the place's longitude on the area's stretch
    here = met.withColumn("_lon", F.expr("_west + pmod(site_lon - _west, 360D)")).where(
        "_lon <= _east and site_lat >= _south and site_lat <= _north"
    )
    strip = "cast(least(floor(({0} - _west) / nullif(_east - _west, 0D) * _strips), _strips - 1) as int)"
    asked = here.selectExpr("site_lon", "site_lat", key, "_lon", f"coalesce({strip.format('_lon')}, 0) as _strip").distinct()
    dealt = edges.where("x1 <> x2").join(boxes.select(key, "_west", "_east", "_strips"), key).selectExpr(
        key, "x1", "y1", "x2", "y2",
        f"explode(sequence({strip.format('least(x1, x2)')}, {strip.format('greatest(x1, x2)')})) as _strip",
    )
    if planar:
        above = "site_lat < y1 + (_lon - x1) / (x2 - x1) * (y2 - y1)"
    else:
        pole = geo.cross(geo.direction("x1", "y1"), geo.direction("x2", "y2"))
        dealt = dealt.selectExpr("*", *(f"{text} as {name}" for name, text in zip(geo.names("_m"), pole)))
        asked = asked.selectExpr("*", *(f"{text} as {name}" for name, text in zip(geo.names("_p"), geo.direction("site_lon", "site_lat"))))
        above = f"{geo.dot(geo.names('_m'), geo.names('_p'))} * sign(x2 - x1) < 0"
    # read twice by the join
    met = spread_join(stage(asked, "asked"), dealt, [key, "_strip"]).where(f"(x1 > _lon) <> (x2 > _lon) and {above}")
    odd = met.groupBy("site_lon", "site_lat", key).agg(F.count(F.lit(1)).alias("_n")).where("_n % 2 = 1")
    return odd.select("site_lon", "site_lat", key)


def shapes_within(places: DataFrame, shapes: DataFrame, key: str, radius_m: float = fixed.SEARCH_RADIUS_M) -> DataFrame:
    """(site_lon, site_lat, key, distance_m): the distinct places and the shapes (key, kind, parts)
    within the radius, a row for each pair.

    The distance on the sphere is 0 inside an area, else that to the nearest point, line or edge.
    Each vertex list is looked up as a line; a place inside an area, however far from its edges,
    is found by `inside`. Shapes of one key count as one.
    """
    shapes = stage(shapes.select(key, "kind", "parts"), "shapes")
    lines = shapes.where("parts is not null").selectExpr(key, "explode(flatten(parts)) as coordinates")
    near = lines_within(places, lines, radius_m).select("site_lon", "site_lat", key, "distance_m")
    within = inside(places, shapes, key).selectExpr("site_lon", "site_lat", key, "0D as distance_m")
    return near.unionByName(within).groupBy("site_lon", "site_lat", key).agg(F.min("distance_m").alias("distance_m"))


def nearest_shape(places: DataFrame, shapes: DataFrame, key: str, leaf_edges: int = 64) -> DataFrame:
    """(lon, lat, key, distance_deg): for each distinct place the nearest shape (key, kind, parts), by
    plain distance in degrees, 0 inside an area; of equally near ones the smallest key.

    Branch and bound like `nearest`, over edges: an edge belongs, at each step, to the cell of its
    middle, and a cell's box holds its edges whole, even where they reach out of the cell. A place
    keeps the cells whose box is no farther than an end of some edge of a kept cell. No search
    limit; without shapes there are no rows.
    """
    shapes = stage(shapes.select(key, "kind", "parts"), "shapes")
    lists = shapes.where("parts is not null").selectExpr(key, "explode(flatten(parts)) as _v")
    many = "greatest(size(_v) - 1, 1)"
    ends = f"zip_with(slice(_v, 1, {many}), slice(_v, least(size(_v), 2), {many}), (a, b) -> struct(a, b))"
    edges = lists.selectExpr(key, f"inline({ends})").selectExpr(
        "(a.lon + b.lon) / 2 as lon", "(a.lat + b.lat) / 2 as lat", "a.lon as x1", "a.lat as y1", "b.lon as x2", "b.lat as y2", key
    )
    edges = stage(edges.groupBy("lon", "lat", "x1", "y1", "x2", "y2").agg(F.min(key).alias(key)), "edges")
    steps, cells, count = _steps_needed(edges, leaf_edges)
    known = places.where("lon is not null and lat is not null").select("lon", "lat").distinct()
    if not steps:
        return known.selectExpr("lon", "lat", f"null as {key}", "0D as distance_deg").limit(0)
    any_cell = f"explode(sequence(0L, {CUT - 1}L))"
    found = known.selectExpr("*", f"{any_cell} as _cx").selectExpr("*", f"{any_cell} as _cy")
    box = "pow(greatest(_west - lon, lon - _east, 0D), 2) + pow(greatest(_south - lat, lat - _north, 0D), 2)"
    for step in range(1, steps + 1):
        on = ["_cx", "_cy"] if step == 1 else ["_x", "_y"]
        boxes = edges.selectExpr("x1", "y1", "x2", "y2", *_cell(step, "_cx", "_cy")).groupBy("_cx", "_cy").agg(
            F.expr("min(least(x1, x2)) as _west"),
            F.expr("max(greatest(x1, x2)) as _east"),
            F.expr("min(least(y1, y2)) as _south"),
            F.expr("max(greatest(y1, y2)) as _north"),
            F.min(F.struct(F.col("x1").alias("lon"), F.col("y1").alias("lat"))).alias("_any"),
        ).selectExpr("*", f"floor(_cx / {CUT}) as _x", f"floor(_cy / {CUT}) as _y")
        joined = lookup_pairs(found, boxes, on, right_rows=cells[step])
        found = (
            joined.selectExpr(
                "lon", "lat", "_cx as _x", "_cy as _y", f"{box} as _least",
                f"min({_squared('_any.lon', '_any.lat')}) over (partition by lon, lat) as _most",
            )
            .where("_least <= _most")
            .select("lon", "lat", "_x", "_y")
        )
    leaves = edges.selectExpr("x1", "y1", "x2", "y2", f"{key} as _key", *_cell(steps, "_x", "_y"))
    candidates = lookup_pairs(found, leaves, ["_x", "_y"], right_rows=count)
    along = "((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / nullif(pow(x2 - x1, 2) + pow(y2 - y1, 2), 0D)"
    part = candidates.withColumn("_t", F.expr(f"least(greatest(coalesce({along}, 0D), 0D), 1D)"))
    foot = _squared("(x1 + _t * (x2 - x1))", "(y1 + _t * (y2 - y1))")
    within = inside(places, shapes, key, planar=True).selectExpr("site_lon as lon", "site_lat as lat", "0D as d", f"{key} as _key")
    best = part.selectExpr("lon", "lat", f"{foot} as d", "_key").unionByName(within)
    best = best.groupBy("lon", "lat").agg(F.min(F.struct("d", "_key")).alias("_best"))
    return best.selectExpr("lon", "lat", f"_best._key as {key}", "sqrt(_best.d) as distance_deg")
