"""Geometry text: all kinds, odd spacing, text that is none."""

import random

import pytest

from voltscape.functions import wkt

GOOD = {
    "POINT (1 2)": ("POINT", [[[(1, 2)]]]),
    " point( -1e1   .5 ) ": ("POINT", [[[(-10, 0.5)]]]),
    "POINT Z (1 2 3)": ("POINT", [[[(1, 2)]]]),
    "POINTZM(1 2 3 4)": ("POINT", [[[(1, 2)]]]),
    "POINT (1 2 3)": ("POINT", [[[(1, 2)]]]),
    "POINT EMPTY": ("POINT", []),
    "LINESTRING(1 2,3 4 , 5 6)": ("LINESTRING", [[[(1, 2), (3, 4), (5, 6)]]]),
    "LINESTRING M EMPTY": ("LINESTRING", []),
    "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1,\n2 1, 2 2, 1 1))": ("POLYGON", [[[(0, 0), (4, 0), (4, 4), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]]]),
    "MULTIPOINT (1 2, 3 4)": ("MULTIPOINT", [[[(1, 2)]], [[(3, 4)]]]),
    "MULTIPOINT ((1 2), (3 4))": ("MULTIPOINT", [[[(1, 2)]], [[(3, 4)]]]),
    "MULTILINESTRING ((1 2, 3 4), (5 6, 7 8))": ("MULTILINESTRING", [[[(1, 2), (3, 4)]], [[(5, 6), (7, 8)]]]),
    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 9 5, 9 9, 5 5), (6 6, 7 6, 7 7, 6 6)))": (
        "MULTIPOLYGON",
        [[[(0, 0), (1, 0), (1, 1), (0, 0)]], [[(5, 5), (9, 5), (9, 9), (5, 5)], [(6, 6), (7, 6), (7, 7), (6, 6)]]],
    ),
    "MULTIPOLYGON Z EMPTY": ("MULTIPOLYGON", []),
}
BAD = [
    None, "", "POINT", "POINT ()", "POINT (1)", "POINT (1 2, 3 4)", "POINT (1 2 3 4 5)", "POINT Z (1 2)", "POINT M (1 2 3 4)",
    "POINT (a b)", "POINT (1 NaN)", "POINT (1d 2)", "POINT (1 2", "POINT 1 2)", "POINT ((1 2))", "POINT (1 2) x", "x POINT (1 2)",
    "LINESTRING (1 2)", "LINESTRING (1 2),(3 4)", "LINESTRING ((1 2, 3 4))", "LINESTRING (1 2,, 3 4)", "LINESTRING (1 2, 3 4,)",
    "POLYGON ((0 0, 1 0, 0 0))", "POLYGON ((0 0, 1 0, 1 1, 0 1))", "POLYGON (0 0, 1 0, 1 1, 0 0)", "POLYGON (((0 0, 1 0, 1 1, 0 0)))",
    "POLYGON ((0 0, 1 0, 1 1, 0 0), ())", "MULTIPOINT ((1 2), 3 4)", "MULTIPOLYGON ((0 0, 1 0, 1 1, 0 0))",
    "MULTILINESTRING ((1 2, 3 4), (5 6))", "GEOMETRYCOLLECTION (POINT (1 2))", "EMPTY", "POINT EMPTY (1 2)", "CIRCLE (1 2)",
]


def parsed(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", wkt.geometry("t").alias("g")).orderBy("i").collect()
    return [None if r.g is None else (r.g.kind, [[[tuple(v) for v in ring] for ring in part] for part in r.g.parts]) for r in rows]


def test_good_text(spark):
    assert dict(zip(GOOD, parsed(spark, list(GOOD)))) == GOOD


def test_bad_text_is_null(spark):
    assert [t for t, g in zip(BAD, parsed(spark, BAD)) if g is not None] == []


@pytest.mark.parametrize("vertices", [5, 20_000])
def test_what_is_written_is_read(spark, vertices):
    draw = random.Random(vertices)

    def listed(n):
        return [(draw.uniform(-180, 180), draw.uniform(-90, 90)) for _ in range(n)]

    def ring(n):
        found = listed(n)
        return [*found, found[0]]

    areas = [[ring(vertices), ring(3)], [ring(4)]]
    text = ", ".join("(" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in own) + ")" for own in part) + ")" for part in areas)
    line = listed(vertices)
    texts = [f"MULTIPOLYGON ({text})", "LINESTRING (" + ",".join(f"{x!r} {y!r}" for x, y in line) + ")"]
    assert parsed(spark, texts) == [("MULTIPOLYGON", areas), ("LINESTRING", [[line]])]


def test_rings_of_areas_only(spark):
    frame = spark.createDataFrame([("POLYGON ((0 0, 4 0, 4 4, 0 0))",), ("LINESTRING (1 2, 3 4)",)], "t string")
    shape = frame.select(wkt.geometry("t").alias("g"))
    assert [r.n for r in shape.selectExpr(f"size({wkt.vertex_lists('g')}) as n").collect()] == [1, 1]
    assert [r.r is None for r in shape.selectExpr(f"{wkt.rings('g')} as r").collect()] == [False, True]
