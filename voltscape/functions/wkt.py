"""Geometry text of any kind, as SQL expressions.

A geometry is a struct of its `kind` and its `parts`: an array of parts (points, lines or areas),
each an array of vertex lists (one for a point or line; the outer ring and the holes for an area),
each an array of (lon, lat).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltscape.functions.geo import NUMBER

KINDS = ("POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON")
AREAS = ("POLYGON", "MULTIPOLYGON")
PARTS = "array<array<array<struct<lon: double, lat: double>>>>"
TYPE = f"struct<kind: string, parts: {PARTS}>"
_HEAD = rf"(?i)^({'|'.join(KINDS)})(?: ?(ZM|Z|M))?(?: ?(EMPTY)$| ?(?=\())"
_BETWEEN = {1: ",", 2: r"\),\(", 3: r"\)\),\(\("}


def quoted(text: str) -> str:
    """SQL text literal that is taken as it stands."""
    return "r'" + text + "'"


def let(name: str, value: str, use: str) -> str:
    """`use`, in which `name` stands for `value`, computed once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def is_area(kind: str) -> str:
    return f"{kind} in ({', '.join(map(repr, AREAS))})"


def _inside(text: str, depth: int) -> str:
    """What stands between `depth` opening and closing brackets; NULL without them."""
    return (
        f"if(startswith({text}, '{'(' * depth}') and endswith({text}, '{')' * depth}') and length({text}) > {2 * depth}, "
        f"substr({text}, {depth + 1}, length({text}) - {2 * depth}), null)"
    )


def _vertex(text: str, ordinates: str) -> str:
    """(lon, lat) of `x y`, with z and m if the text has them; NULL for anything else."""
    fits = f"size(n) between 2 and 4 and ({ordinates} = 0 or size(n) = {ordinates})"
    plain = f"forall(n, x -> rlike(x, {quoted(f'^{NUMBER}$')}))"
    pair = "named_struct('lon', try_cast(n[0] as double), 'lat', try_cast(get(n, 1) as double))"
    return let("n", f"split(trim({text}), ' ')", f"if({fits} and {plain}, {pair}, null)")


def geometry_sql(text: str) -> str:
    """`POINT`, `LINESTRING`, `POLYGON` and their `MULTI` forms, with `Z`, `M` or `ZM`, or `EMPTY`
    (no parts). Brackets split the text level by level; whatever they leave must be numbers, so
    text with brackets out of place, other words, or too few or too many numbers is NULL. So are a
    point of several vertices, a line of one, and a ring that has under four or is not closed.

    Each step sees the one before as a value, not as text to be worked out for every vertex.
    """
    spaced = f"trim(regexp_replace({text}, {quoted(chr(92) + 's+')}, ' '))"
    tidy = f"regexp_replace({spaced}, {quoted(' ?([(),]) ?')}, '$1')"
    mark = f"upper(regexp_extract(t, {quoted(_HEAD)}, 2))"
    head = (
        f"named_struct('kind', upper(regexp_extract(t, {quoted(_HEAD)}, 1)), "
        f"'ordinates', case when {mark} = 'ZM' then 4 when {mark} <> '' then 3 else 0 end, "
        f"'empty', regexp_extract(t, {quoted(_HEAD)}, 3) <> '', 'body', regexp_replace(t, {quoted(_HEAD)}, ''))"
    )
    body = {depth: _inside("h.body", depth) for depth in (1, 2, 3)}
    texts = (
        f"case when h.kind = 'MULTIPOLYGON' then split({body[3]}, {quoted(_BETWEEN[3])}) when h.kind = 'POLYGON' then array({body[2]}) "
        f"when h.kind = 'MULTILINESTRING' or h.kind = 'MULTIPOINT' and startswith(h.body, '((') then split({body[2]}, {quoted(_BETWEEN[2])}) "
        f"when h.kind = 'MULTIPOINT' then split({body[1]}, {quoted(_BETWEEN[1])}) when h.kind <> '' then array({body[1]}) end"
    )
    lists = f"transform({texts}, p -> if({is_area('h.kind')}, split(p, {quoted(_BETWEEN[2])}), array(p)))"
    split = f"named_struct('kind', h.kind, 'ordinates', h.ordinates, 'parts', if(h.empty, cast(array() as array<array<string>>), {lists}))"
    vertices = f"transform(s.parts, p -> transform(p, v -> transform(split(v, ','), w -> {_vertex('w', 's.ordinates')})))"
    size = (
        f"case when {is_area('s.kind')} then size(v) >= 4 and v[0] = element_at(v, -1) "
        "when endswith(s.kind, 'POINT') then size(v) = 1 else size(v) > 1 end"
    )
    sound = f"forall(g, p -> p is not null and forall(p, v -> v is not null and forall(v, w -> w is not null) and {size}))"
    found = let("g", vertices, f"if({sound}, named_struct('kind', s.kind, 'parts', g), null)")
    return f"cast({let('s', let('h', let('t', tidy, head), split), found)} as {TYPE})"


def geometry(column: str) -> Column:
    """Column `column` as a geometry."""
    return F.expr(geometry_sql(f"`{column}`"))


# fixed values: the names of GeoJSON's geometries, in the order of KINDS
_JSON_KINDS = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon")


def geojson_sql(text: str) -> str:
    """Geometry of a GeoJSON document: that of its first feature if it is a collection, of the feature,
    or the document itself. NULL if it holds none of the known kinds, or positions that are none."""
    kind = "get_json_object(d, '$.type')"
    first = f"case when {kind} = 'FeatureCollection' then get_json_object(d, '$.features[0].geometry') when {kind} = 'Feature' then get_json_object(d, '$.geometry') else d end"
    depths = {"Point": 0, "LineString": 1, "MultiPoint": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}
    arms = []
    for name, plain in zip(_JSON_KINDS, KINDS):
        shape = "array<" * (depths[name] + 1) + "double" + ">" * (depths[name] + 1)
        read = f"from_json(get_json_object(j, '$.coordinates'), '{shape}')"
        nested = {
            "Point": f"array(array(array({read})))",
            "LineString": f"array(array({read}))",
            "MultiPoint": f"transform({read}, p -> array(array(p)))",
            "Polygon": f"array({read})",
            "MultiLineString": f"transform({read}, p -> array(p))",
            "MultiPolygon": read,
        }[name]
        pairs = f"transform({nested}, p -> transform(p, v -> transform(v, w -> named_struct('lon', get(w, 0), 'lat', get(w, 1)))))"
        arms.append(f"when get_json_object(j, '$.type') = '{name}' then named_struct('kind', '{plain}', 'parts', {pairs})")
    sound = "forall(g.parts, p -> p is not null and forall(p, v -> v is not null and forall(v, w -> w.lon is not null and w.lat is not null)))"
    found = let("j", let("d", text, first), f"case {' '.join(arms)} end")
    return f"cast({let('g', found, f'if({sound}, g, null)')} as {TYPE})"


def vertex_lists(shape: str) -> str:
    """All vertex lists of a geometry."""
    return f"flatten({shape}.parts)"


def rings(shape: str) -> str:
    """All rings of an area, holes included; NULL for other kinds."""
    return f"if({is_area(f'{shape}.kind')}, {vertex_lists(shape)}, null)"
