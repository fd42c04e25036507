"""Points, lines and cells on the sphere, as column expressions (degrees in, metres out)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: radius of the sphere the warehouse measures on.
EARTH_RADIUS_M = 6371010.0

NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
POINT = rf"^\s*POINT\s*\(\s*({NUMBER}\s+{NUMBER})\s*\)\s*$"


# ---------------------------------------------------------------- text to geometry


def with_point(df: DataFrame, wkt: str, lon: str, lat: str) -> DataFrame:
    """`df` with the place of `POINT (x y)` text in two columns, NULL for anything else.

    One expression finds both numbers, and as it is exploded, plans that use the columns several
    times don't repeat it.
    """
    numbers = F.split(F.regexp_extract(wkt, POINT, 1), r"\s+")
    found = df.select(*(F.col(f"`{c}`") for c in df.columns if c not in (lon, lat)), F.explode(F.array(numbers)).alias("_xy"))
    place = {lon: F.get("_xy", F.lit(0)).try_cast("double"), lat: F.get("_xy", F.lit(1)).try_cast("double")}
    return found.withColumns(place).drop("_xy")


def _coordinates(text: Column) -> Column:
    """`x y, x y, ...` to an array of (lon, lat)."""

    def vertex(pair: Column) -> Column:
        numbers = F.split(F.trim(pair), r"\s+")
        return F.struct(
            F.try_element_at(numbers, F.lit(1)).try_cast("double").alias("lon"),
            F.try_element_at(numbers, F.lit(2)).try_cast("double").alias("lat"),
        )

    return F.transform(F.split(text, ","), vertex)


def line_coordinates(wkt: Column) -> Column:
    """Vertices of `LINESTRING (x y, ...)` text; NULL for anything else."""
    body = F.regexp_extract(wkt, r"^\s*LINESTRING\s*\(([^()]*)\)\s*$", 1)
    return F.when(body != "", _coordinates(body))


def ring_edges(rings: Column) -> Column:
    """Edges (x1, y1, x2, y2) of all rings of one geometry."""

    def edges(ring: Column) -> Column:
        starts = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
        ends = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
        return F.zip_with(
            starts,
            ends,
            lambda a, b: F.struct(
                a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
            ),
        )

    return F.flatten(F.transform(rings, edges))


# ---------------------------------------------------------------- directions and distances
#
# A place is a unit vector. Differences of near vectors keep their digits, the formulas stay
# short, and the sines are taken once per row, before a join, instead of once per pair.
# Formulas are SQL text over column names, which Spark parses in one go.

Vector = tuple[str, str, str]


def names(prefix: str) -> Vector:
    return f"{prefix}x", f"{prefix}y", f"{prefix}z"


def direction(lon: str, lat: str) -> Vector:
    """Unit vector of a place."""
    return (
        f"cos(radians({lat})) * cos(radians({lon}))",
        f"cos(radians({lat})) * sin(radians({lon}))",
        f"sin(radians({lat}))",
    )


def lon_of(v: Vector) -> str:
    return f"degrees(atan2({v[1]}, {v[0]}))"


def lat_of(v: Vector) -> str:
    return f"degrees(atan2({v[2]}, sqrt(({v[0]}) * ({v[0]}) + ({v[1]}) * ({v[1]}))))"


def minus(a: Vector, b: Vector) -> Vector:
    return tuple(f"({x} - {y})" for x, y in zip(a, b))


def dot(a: Vector, b: Vector) -> str:
    return "(" + " + ".join(f"{x} * {y}" for x, y in zip(a, b)) + ")"


def cross(a: Vector, b: Vector) -> Vector:
    return tuple(f"({a[j]} * {b[k]} - {a[k]} * {b[j]})" for j, k in ((1, 2), (2, 0), (0, 1)))


def chord_of(metres: float) -> float:
    """Length of the straight line between unit vectors that far apart."""
    return 2 * math.sin(metres / EARTH_RADIUS_M / 2)


def arc_m(squared_chord: str) -> str:
    """Distance on the sphere from the squared straight-line distance of unit vectors."""
    return f"{2 * EARTH_RADIUS_M!r}D * asin(least(sqrt({squared_chord}) / 2, 1D))"


def squared_chord_to_segment(to_start: Vector, along: Vector, length2: str, pole: Vector) -> str:
    """Squared chord from a place to a great-circle segment.

    `to_start` is place - start and `along` is end - start, both of unit vectors, `length2`
    the squared length of `along`, and `pole` the unit normal of the circle (NULL if start and
    end coincide). Where the foot of the perpendicular lies within the segment, the sine of
    the angle across is the part of `to_start` along the pole; otherwise the nearer end counts.
    """
    start2, forward, sine = dot(to_start, to_start), dot(along, to_start), dot(pole, to_start)
    end2 = f"({start2} - 2 * {forward} + {length2})"
    between = (
        f"{length2} > 0 and {forward} >= {length2} * {start2} / 4 and {length2} - {forward} >= {length2} * {end2} / 4"
    )
    # sin^2 of an angle to its squared chord, 2 - 2 cos, without losing digits near 0
    across = f"2 * {sine} * {sine} / (1 + sqrt(1 - least({sine} * {sine}, 1D)))"
    return f"case when {between} then {across} else least({start2}, {end2}) end"


# ---------------------------------------------------------------- cells for a search radius


@dataclass(frozen=True)
class RadiusGrid:
    """Cells such that points within `radius_m` of each other lie in touching cells.

    Latitude is cut into bands one radius high. Each band is cut into equal columns at
    least as wide as the largest longitude difference two points within the radius can have
    when one of them is in that band. Near a pole the band is a single cell.
    """

    radius_m: float

    @property
    def height(self) -> float:
        return math.degrees(self.radius_m / EARTH_RADIUS_M) * (1 + 1e-9)

    def band(self, lat: str) -> str:
        return f"floor(({lat} + 90D) / {self.height!r}D)"

    def columns(self, band: str) -> str:
        """How many columns the band has."""
        # the partner of a point in this band may lie one band closer to the pole
        reach = f"greatest(abs(({band} - 1) * {self.height!r}D - 90D), abs(({band} + 2) * {self.height!r}D - 90D))"
        sine = f"({math.sin(self.radius_m / EARTH_RADIUS_M)!r}D / cos(radians(least({reach}, 90D))))"
        width = f"(degrees(asin({sine})) * {1 + 1e-9!r}D)"
        return (
            f"case when {reach} >= 90D or {sine} >= 1D then cast(1 as bigint) "
            f"else greatest(floor(360D / {width}), cast(1 as bigint)) end"
        )

    def _with_columns(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_count", F.expr(self.columns("band")))

    def locate(self, df: DataFrame, lon: str, lat: str) -> DataFrame:
        """Add the cell (`band`, `col`) of each row's point."""
        banded = self._with_columns(df.withColumn("band", F.expr(self.band(lat))))
        column = F.expr(f"pmod(floor(({lon} + 180D) / 360D * _count), _count)")
        return banded.withColumn("col", column).drop("_count")

    def cover(self, df: DataFrame, lon: str, lat: str) -> DataFrame:
        """Repeat each row for the cells (`band`, `col`) that hold every point within the radius."""
        around = f"explode(sequence({self.band(lat)} - 1, {self.band(lat)} + 1))"
        banded = self._with_columns(df.withColumn("band", F.expr(around)))
        own = banded.withColumn("_own", F.expr(f"floor(({lon} + 180D) / 360D * _count)"))
        touching = ", ".join(f"pmod(_own + {step}, _count)" for step in (-1, 0, 1))
        return own.withColumn("col", F.expr(f"explode(array_distinct(array({touching})))")).drop("_count", "_own")

    def touch(
        self, df: DataFrame, lon1: str, lat1: str, lon2: str, lat2: str, arc_m: float, within_m: float = 0.0
    ) -> DataFrame:
        """Repeat each row for the cells that the great circle between two points, at most
        `arc_m` apart, touches, or that hold a place within `within_m`, at most the radius, of it.

        The box around the points is padded by that and a metre, and by what the arc may rise
        above its ends. It takes the shorter way round, so it may pass the antimeridian.
        """
        pad = math.degrees((within_m + 1.0) / EARTH_RADIUS_M)
        # over an arc s the circle rises by about s^2 tan(lat) / 8, next to a pole by up to twice that, and never by
        # more than s / 2
        rise, most = math.degrees((arc_m / EARTH_RADIUS_M) ** 2 / 3.8), math.degrees(arc_m / EARTH_RADIUS_M / 2)
        steepest = f"tan(radians(least(greatest(abs({lat1}), abs({lat2})), 89.999D)))"
        pad_lat = f"({pad!r}D + least({rise!r}D * {steepest}, {most!r}D))"
        low, high = (
            self.band(f"greatest({end}({lat1}, {lat2}) {sign} {pad_lat}, -90D)")
            for end, sign in (("least", "-"), ("greatest", "+"))
        )
        turn = f"(pmod({lon2} - {lon1} + 540D, 360D) - 180D)"
        boxed = df.selectExpr(
            "*",
            f"{lon1} + least({turn}, 0D) as _west",
            f"{lon1} + greatest({turn}, 0D) as _east",
            f"explode(sequence({low}, {high})) as band",
        )
        # the padding in degrees of longitude, at the narrowest the band can be
        pad_lon = f"{360.0 * pad / self.height!r}D / _count"
        ranged = self._with_columns(boxed).selectExpr(
            "*",
            f"floor((_west - {pad_lon} + 180D) / 360D * _count) as _first",
            f"floor((_east + {pad_lon} + 180D) / 360D * _count) as _last",
        )
        columns = F.expr("explode(sequence(_first, least(_last, _first + _count - 1)))")
        return (
            ranged.withColumn("_c", columns)
            .withColumn("col", F.expr("pmod(_c, _count)"))
            .drop("_west", "_east", "_count", "_first", "_last", "_c")
        )
