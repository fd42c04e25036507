"""Geography functions for SQL text: `st_geogpoint`, `st_geogfromtext`, `st_geogfromgeojson`,
`st_distance`, `st_dwithin` and `st_within`, as SQL functions of the session, without Python."""

from __future__ import annotations

from pyspark.sql import SparkSession

from voltscape.functions import geo, wkt

_P, _A, _B = (tuple(f"{v}.{c}" for c in "xyz") for v in "pab")
_EDGE, _POLE = tuple(f"e.d{c}" for c in "xyz"), tuple(f"e.n{c}" for c in "xyz")


def _place(lon: str, lat: str) -> str:
    x, y, z = geo.direction(lon, lat)
    return f"named_struct('x', {x}, 'y', {y}, 'z', {z}, 'lon', {lon})"


def _edges(lists: str) -> str:
    """Edges of the vertex lists as (a, b); a list of one vertex is an edge of no length."""
    many = "greatest(size(v) - 1, 1)"
    pairs = f"zip_with(slice(v, 1, {many}), slice(v, least(size(v), 2), {many}), (s, t) -> named_struct('a', {_place('s.lon', 's.lat')}, 'b', {_place('t.lon', 't.lat')}))"
    return f"flatten(transform({lists}, v -> {pairs}))"


#: Edges of GeoJSON are straight in degrees: pieces this long stay within two metres of that.
STRAIGHT_DEGREES = 0.1


def _straight(shape: str) -> str:
    """The geometry with its edges cut into pieces, so that great circles between the vertices follow
    the straight lines in degrees. An edge of over half a turn stays as it is."""
    west, north = "(get(v, i + 1).lon - v[i].lon)", "(get(v, i + 1).lat - v[i].lat)"
    many = f"if(abs({west}) > 180, 1, cast(greatest(ceil(greatest(abs({west}), abs({north})) / {STRAIGHT_DEGREES}D), 1) as int))"
    vertex = f"named_struct('lon', v[i].lon + {west} * k / n, 'lat', v[i].lat + {north} * k / n)"
    pieces = wkt.let("n", many, f"transform(sequence(0, n - 1), k -> {vertex})")
    cut = f"flatten(transform(sequence(0, size(v) - 1), i -> if(i = size(v) - 1, array(v[i]), {pieces})))"
    lists = f"transform(g.parts, p -> transform(p, v -> if(size(v) > 1, {cut}, v)))"
    made = f"if(g is null, null, named_struct('kind', g.kind, 'parts', {lists}))"
    return f"cast({wkt.let('g', shape, made)} as {wkt.TYPE})"


_SPOT = wkt.let("o", "at.parts[0][0][0]", _place("o.lon", "o.lat"))


def _gap() -> str:
    """Squared chord from place `p` to edge `e` of a and b, through the edge's direction and pole."""
    a, b = (tuple(f"e.{v}.{c}" for c in "xyz") for v in "ab")
    along = geo.minus(b, a)
    length2 = geo.dot(along, along)
    pole = geo.cross(a, along)
    made = "named_struct(" + ", ".join(
        [*(f"'d{c}', {t}" for c, t in zip("xyz", along)), f"'l', {length2}", "'n0', nullif(sqrt({0} - {0} * {0} / 4), 0D)".format(length2)]
        + [f"'m{c}', {t}" for c, t in zip("xyz", pole)] + [f"'s{c}', {t}" for c, t in zip("xyz", geo.minus(_P, a))]
    ) + ")"
    text = geo.squared_chord_to_segment(
        tuple(f"q.s{c}" for c in "xyz"), tuple(f"q.d{c}" for c in "xyz"), "q.l", tuple(f"(q.m{c} / q.n0)" for c in "xyz")
    )
    return wkt.let("q", made, text)


def _inside() -> str:
    """Whether `at`, a point, lies inside the area `shape`: the meridian from it to the north pole
    meets an odd number of edges."""
    west, east = (f"(pmod(e.{v}.lon - p.lon + 540D, 360D) - 180D)" for v in "ab")
    pole = geo.dot(geo.cross(*(tuple(f"e.{v}.{c}" for c in "xyz") for v in "ab")), _P)
    meets = f"({west} > 0) <> ({east} > 0) and abs({west} - {east}) < 180 and {pole} * sign({east} - {west}) < 0"
    count = f"size(filter({_edges('flatten(shape.parts)')}, e -> {meets})) % 2 = 1"
    return f"{wkt.is_area('shape.kind')} and {wkt.let('p', _SPOT, count)}"


def _functions() -> dict[str, str]:
    least = wkt.let("p", _SPOT, f"array_min(transform({_edges('flatten(shape.parts)')}, e -> {_gap()}))")
    return {
        "st_geogpoint(lon double, lat double)": (
            f"returns {wkt.TYPE} return if(lon is null or lat is null, null, "
            "named_struct('kind', 'POINT', 'parts', array(array(array(named_struct('lon', lon, 'lat', lat))))))"
        ),
        "st_geogfromtext(text string)": f"returns {wkt.TYPE} return {wkt.geometry_sql('text')}",
        "st_geogfromgeojson(text string)": f"returns {wkt.TYPE} return {_straight(wkt.geojson_sql('text'))}",
        f"st_point_within(at {wkt.TYPE}, shape {wkt.TYPE})": f"returns boolean return {_inside()}",
        f"st_point_distance(at {wkt.TYPE}, shape {wkt.TYPE})": (
            f"returns double return if(st_point_within(at, shape), 0D, {geo.arc_m(least)})"
        ),
        f"st_within(a {wkt.TYPE}, b {wkt.TYPE})": (
            "returns boolean return case when a is null or b is null then null when a.kind = 'POINT' and size(a.parts) = 1 "
            "then st_point_within(a, b) else raise_error('st_within tests a point')  end"
        ),
        f"st_distance(a {wkt.TYPE}, b {wkt.TYPE})": (
            "returns double return case when a is null or b is null or size(a.parts) = 0 or size(b.parts) = 0 then null "
            "when a.kind = 'POINT' then st_point_distance(a, b) when b.kind = 'POINT' then st_point_distance(b, a) "
            "else raise_error('st_distance measures from a point') end"
        ),
        f"st_dwithin(a {wkt.TYPE}, b {wkt.TYPE}, metres double)": "returns boolean return st_distance(a, b) <= metres",
    }


def register(spark: SparkSession) -> None:
    """Make the functions known to the session's SQL text.

    Geometries are structs (see `wkt`); edges are great circles, those of GeoJSON straight in degrees. Distances are metres on the sphere, from a point to a
    point, a line or an area, 0 inside it. What does not depend on a row, such as a boundary given
    as a parameter, is worked out once. NULL or empty geometries give NULL. For joins of two large
    tables use `points_within`, `shapes_within` or `inside`, which look partners up by cell: a
    condition in SQL text would meet all pairs.
    """
    for signature, body in _functions().items():
        spark.sql(f"create or replace temporary function {signature} {body}")
