"""Distance joins and the nearest join."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions import geo
from voltscape.functions.joins import BROADCAST_ROWS, PART, is_small, lookup_pairs, spread_join, spread_sides
from voltscape.functions.staging import stage

WORLD_DEGREES = 360.0
# cells a place may be repeated over
MOST_CELLS = 9
# each step down cuts a cell into 8 x 8
CUT = 8


def one_location(stations: DataFrame) -> DataFrame:
    """(id, lon, lat), one row per station; fails if an id has two places."""
    ends = stations.groupBy("id").agg(
        F.min(F.struct("lon", "lat")).alias("_a"), F.max(F.struct("lon", "lat")).alias("_b")
    )
    checked = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(
        F.raise_error(F.concat(F.lit("station with two locations: "), F.col("id").cast("string")))
    )
    return ends.select("id", checked.alias("_p")).select("id", "_p.lon", "_p.lat")


SITE, START, END, ALONG, POLE = (geo.names(prefix) for prefix in ("_p", "_a", "_b", "_d", "_m"))
# a segment is looked up in pieces of at most this many cells
PIECE_CELLS = 2
# where pairs stay together, many places are looked up in tiles at least this many radii wide: wider ones move
# fewer rows and test more pairs
TILE_RADII = 4


def _with_vector(df: DataFrame, columns: geo.Vector, vector: geo.Vector) -> DataFrame:
    return df.selectExpr("*", *(f"{text} as {name}" for name, text in zip(columns, vector)))


def _near(
    places: DataFrame,
    rows: DataFrame,
    radius_m: float,
    cells: Callable[[DataFrame, geo.RadiusGrid, float], DataFrame],
    measured: Callable[[DataFrame], DataFrame],
    squared_chord: str,
    used: tuple[str, ...],
    together: str | None,
) -> DataFrame:
    """Pairs of a place and a row within the radius, for each row of its own.

    `cells` repeats rows for the cells of a grid they touch or, with a distance, come that close to;
    `measured` adds the columns `used`, of which `squared_chord` is made.

    Sites are repeated for every cell that may hold a partner. Few are broadcast, and the rows stay
    where they are; many are joined by cell with hot cells split. Both give the same rows.
    With `together`, many sites are placed by larger tiles instead, each in one, and all rows within
    the radius of a tile come to it as narrow as they are; hot tiles are split. The pairs are the same.
    """
    grid, cell = geo.RadiusGrid(radius_m), ["band", "col"]
    sites = places.selectExpr("lon as site_lon", "lat as site_lat").distinct()
    towards = geo.direction("site_lon", "site_lat")
    few = is_small(places, BROADCAST_ROWS // MOST_CELLS)
    if together and not few:
        tiles = geo.RadiusGrid(TILE_RADII * radius_m)
        placed = tiles.locate(sites, "site_lon", "site_lat")
        here, there = spread_sides(placed, cells(rows, tiles, radius_m), cell, [together])
        pairs = measured(there).join(_with_vector(here, SITE, towards).hint("shuffle_hash"), PART)
    else:
        covered = grid.cover(_with_vector(sites, SITE, towards), "site_lon", "site_lat")
        located = cells(measured(rows), grid, 0.0)
        pairs = located.join(F.broadcast(covered), cell) if few else spread_join(covered, located, cell)
        pairs = pairs.withColumn(PART, F.lit(0))
    limit = geo.chord_of(radius_m) ** 2
    close = pairs.withColumn("_chord2", F.expr(squared_chord)).where(F.col("_chord2") <= limit)
    unused = (*cell, "_chord2", *SITE, *used, *(() if together else (PART,)))
    return close.withColumn("distance_m", F.expr(geo.arc_m("_chord2"))).drop(*unused)


def points_within(
    places: DataFrame, points: DataFrame, radius_m: float = fixed.SEARCH_RADIUS_M, together: str | None = None
) -> DataFrame:
    """Distinct places (`site_lon`, `site_lat`) with the points within the radius.

    `points` needs lon and lat; its other columns are kept and `distance_m` is added; equal rows
    of `points` are points of their own. The distance test is part of the join.

    With `together`, a column of `points`, the pairs have PART: those of a place and a value of that
    column are in one part, so counts of its values per place and part add up. If the places are
    many, pairs are placed by PART, and grouping by it and more moves none of them.
    """

    def cells(rows: DataFrame, grid: geo.RadiusGrid, within_m: float) -> DataFrame:
        if not within_m:
            return grid.locate(rows, "lon", "lat")
        known = rows.where("lon is not null and lat is not null")
        return grid.touch(known, "lon", "lat", "lon", "lat", 0.0, within_m)

    def measured(rows: DataFrame) -> DataFrame:
        return _with_vector(rows, START, geo.direction("lon", "lat"))

    gap = geo.minus(SITE, START)
    return _near(places, points, radius_m, cells, measured, geo.dot(gap, gap), ("lon", "lat", *START), together)


def lines_within(
    places: DataFrame, lines: DataFrame, radius_m: float = fixed.SEARCH_RADIUS_M, together: str | None = None
) -> DataFrame:
    """Distinct places with the line segments within the radius.

    `lines` needs `coordinates` (array of lon, lat); its other columns are kept and
    `distance_m` to one segment is added, so the least value per line is the line's distance;
    a segment may come out several times. Long segments are cut along the great circle into
    pieces of about two cells; a piece only decides in which cells the segment is looked up,
    the distance is always measured to the whole segment. `together` as in `points_within`.
    """
    kept = [c for c in lines.columns if c != "coordinates"]
    # a line of one vertex is a segment of length 0
    many = "greatest(size(coordinates) - 1, 1)"
    starts, ends = f"slice(coordinates, 1, {many})", f"slice(coordinates, least(size(coordinates), 2), {many})"
    segment = f"explode(zip_with({starts}, {ends}, (a, b) -> named_struct('a', a, 'b', b))) as s"
    segments = lines.where("size(coordinates) > 0").selectExpr(*kept, segment)
    segments = segments.selectExpr(*kept, "s.a.lon as _x1", "s.a.lat as _y1", "s.b.lon as _x2", "s.b.lat as _y2")

    def along(rows: DataFrame) -> DataFrame:
        rows = _with_vector(rows, START, geo.direction("_x1", "_y1"))
        rows = _with_vector(rows, END, geo.direction("_x2", "_y2"))
        rows = _with_vector(rows, ALONG, geo.minus(END, START)).drop(*END)
        return rows.withColumn("_length2", F.expr(geo.dot(ALONG, ALONG)))

    def measured(rows: DataFrame) -> DataFrame:
        # |start x along|, from lengths alone
        normal = "nullif(sqrt(_length2 - _length2 * _length2 / 4), 0D)"
        return _with_vector(along(rows), POLE, tuple(f"{c} / {normal}" for c in geo.cross(START, ALONG)))

    def cells(rows: DataFrame, grid: geo.RadiusGrid, within_m: float) -> DataFrame:
        vectors = rows if "_length2" in rows.columns else along(rows)
        longest = PIECE_CELLS * grid.radius_m
        # equal steps along the chord are longer on the sphere halfway
        slack = "sqrt(greatest(1 - _length2 / 4, 1e-6D))"
        pieces = f"cast(greatest(ceil({geo.arc_m('_length2')} / ({longest!r}D * {slack})), 1) as int)"
        cut = vectors.withColumn("_n", F.expr(pieces)).withColumn("_i", F.expr("explode(sequence(0, _n - 1))"))
        first, last = (
            tuple(f"({a} + {d} * ({step}) / _n)" for a, d in zip(START, ALONG)) for step in ("_i", "_i + 1")
        )
        cut = cut.selectExpr(
            "*",
            f"{geo.lon_of(first)} as _lon1",
            f"{geo.lat_of(first)} as _lat1",
            f"{geo.lon_of(last)} as _lon2",
            f"{geo.lat_of(last)} as _lat2",
        )
        touched = grid.touch(cut, "_lon1", "_lat1", "_lon2", "_lat2", longest, within_m)
        return touched.select(*rows.columns, "band", "col")

    used = ("_x1", "_y1", "_x2", "_y2", *START, *ALONG, "_length2", *POLE)
    chord2 = geo.squared_chord_to_segment(geo.minus(SITE, START), ALONG, "_length2", POLE)
    return _near(places, segments, radius_m, cells, measured, chord2, used, together)


# ---------------------------------------------------------------- nearest


def nearest(places: DataFrame, points: DataFrame, key: str, value: str, leaf_points: int = 64) -> DataFrame:
    """For each distinct place the nearest point, by plain distance in degrees.

    Returns (lon, lat, `key`, `value`, `distance_deg`); of points equally near the one with
    the smallest `key` wins. No search limit.

    Points are counted into nested cells, each step eight times finer per side. Every place
    walks down from the whole world: it keeps the cells that could still hold its nearest
    point - those whose bounding box is no farther than the nearest known point of any kept
    cell - and looks only into their occupied children. So a place follows a few cells per
    step however dense the points are, and a full cell far away is dropped unopened.
    """
    # every step reads the points: once from their source, then from here
    sites = stage(points.groupBy("lon", "lat").agg(F.min(F.struct(key, value)).alias("_payload")), "sites")
    steps, cell_counts, site_count = _steps_needed(sites, leaf_points)
    known = places.where("lon is not null and lat is not null").select("lon", "lat").distinct()
    if not steps:
        return known.selectExpr("lon", "lat", *(f"null as {c}" for c in (key, value)), "0D as distance_deg").limit(0)
    # the first step may lead to any of its cells
    any_cell = f"explode(sequence(0L, {CUT - 1}L))"
    found = known.selectExpr("*", f"{any_cell} as _cx").selectExpr("*", f"{any_cell} as _cy")
    squared_box = (
        "pow(greatest(_west - lon, lon - _east, 0D), 2) + pow(greatest(_south - lat, lat - _north, 0D), 2)"
    )
    for step in range(1, steps + 1):
        # at most 64 cells lie under one cell of the step before
        on = ["_cx", "_cy"] if step == 1 else ["_x", "_y"]
        joined = lookup_pairs(found, _cells(sites, step), on, right_rows=cell_counts[step])
        found = (
            joined.selectExpr(
                "lon", "lat", "_cx as _x", "_cy as _y",
                f"{squared_box} as _least",
                f"min({_squared('_any.lon', '_any.lat')}) over (partition by lon, lat) as _most",
            )
            .where("_least <= _most")
            .select("lon", "lat", "_x", "_y")
        )
    leaves = sites.selectExpr("lon as _plon", "lat as _plat", "_payload", *_cell(steps, "_x", "_y"))
    candidates = lookup_pairs(found, leaves, ["_x", "_y"], right_rows=site_count)
    best = candidates.groupBy("lon", "lat").agg(
        F.expr(f"min(struct({_squared('_plon', '_plat')} as d, _payload as p))").alias("_best")
    )
    return best.selectExpr(
        "lon", "lat", f"_best.p.{key} as {key}", f"_best.p.{value} as {value}", "sqrt(_best.d) as distance_deg"
    )


def _squared(lon: str, lat: str) -> str:
    return f"(pow(lon - {lon}, 2) + pow(lat - {lat}, 2))"


def _cell(step: int, x: str, y: str) -> list[str]:
    # points on or beyond the edge of the world belong to its outermost cells
    size, last = WORLD_DEGREES / CUT**step, CUT**step - 1
    return [
        f"least(greatest(floor(({c} + {shift}D) / {size!r}D), 0L), {last}L) as {name}"
        for c, shift, name in (("lon", 180, x), ("lat", 90, y))
    ]


def _cells(sites: DataFrame, step: int) -> DataFrame:
    """Occupied cells of one step with their parent, bounding box and one of their points."""
    cells = sites.selectExpr("lon", "lat", *_cell(step, "_cx", "_cy"))
    return (
        cells.groupBy("_cx", "_cy")
        .agg(
            F.min("lon").alias("_west"),
            F.max("lon").alias("_east"),
            F.min("lat").alias("_south"),
            F.max("lat").alias("_north"),
            F.min(F.struct("lon", "lat")).alias("_any"),
        )
        .selectExpr("*", f"floor(_cx / {CUT}) as _x", f"floor(_cy / {CUT}) as _y")
    )


def _steps_needed(sites: DataFrame, leaf_points: int, most: int = 9) -> tuple[int, dict[int, int], int]:
    """First step whose fullest cell holds at most `leaf_points` points (at most `most`),
    the number of occupied cells per step and of points."""
    levels = ", ".join(
        f"struct({step} as step, {', '.join(_cell(step, 'x', 'y'))})" for step in range(1, most + 1)
    )
    per_step = (
        sites.selectExpr(f"inline(array({levels}))")
        .groupBy("step", "x", "y")
        .count()
        .groupBy("step")
        .agg(F.max("count").alias("fullest"), F.count(F.lit(1)).alias("cells"), F.sum("count").alias("points"))
        .collect()
    )
    enough = (row.step for row in per_step if row.fullest <= leaf_points)
    steps = min(enough, default=most) if per_step else 0
    return steps, {row.step: row.cells for row in per_step}, max((row.points for row in per_step), default=0)
