"""Geography functions in SQL text."""

import json

import pytest
from pyspark.errors import PySparkException
from test_shapes import distance, some_shapes, text

import random

from voltscape.functions import geography


@pytest.fixture(scope="module")
def sql(spark):
    geography.register(spark)

    def first(query, **parameters):
        return spark.sql(f"select {query} as x", args=parameters or None).first().x

    return first


def test_distance_to_any_kind(spark, sql):
    draw = random.Random(5)
    found = some_shapes(draw, 179.99, 60.0, 0.03, 0.02, 25)
    places = [((179.99 + draw.uniform(-0.1, 0.1) + 180) % 360 - 180, 60 + draw.uniform(-0.03, 0.03)) for _ in range(20)]
    spark.createDataFrame([(k, text(s)) for k, s in found.items()], "k int, t string").createOrReplaceTempView("some_shapes")
    hits = 0
    for p in places:
        rows = spark.sql(
            "select k, st_distance(st_geogpoint(:x, :y), st_geogfromtext(t)) as d, st_distance(st_geogfromtext(t), st_geogpoint(:x, :y)) as e, "
            "st_dwithin(st_geogpoint(:x, :y), st_geogfromtext(t), 500D) as near, st_within(st_geogpoint(:x, :y), st_geogfromtext(t)) as i from some_shapes",
            args={"x": p[0], "y": p[1]},
        ).collect()
        for r in rows:
            wanted = distance(p, found[r.k])
            assert abs(r.d - wanted) < 1e-4 and r.d == r.e and r.near == (wanted <= 500)
            assert r.i == (wanted == 0 and "POLYGON" in found[r.k][0])
            hits += r.i
    assert hits > 5


def test_geojson(sql):
    ring = [[0, 0], [4, 0], [4, 4], [0, 0]]
    shapes = {
        "Point": [1, 2], "LineString": [[1, 2], [3, 4, 9]], "Polygon": [ring], "MultiPoint": [[1, 2]],
        "MultiLineString": [[[1, 2], [3, 4]]], "MultiPolygon": [[ring], [ring]],
    }
    for kind, coordinates in shapes.items():
        geometry = {"type": kind, "coordinates": coordinates}
        feature = {"type": "Feature", "geometry": geometry}
        for document in (geometry, feature, {"type": "FeatureCollection", "features": [feature, {}]}):
            found = sql("st_geogfromgeojson(:d)", d=json.dumps(document))
            assert found.kind == kind.upper()
            assert len(found.parts) == (2 if kind == "MultiPolygon" else 1)
    for bad in ('{"type": "Polygon"}', '{"type": "Polygon", "coordinates": [[[1]]]}', "x", '{"type": "FeatureCollection", "features": []}'):
        assert sql("st_geogfromgeojson(:d)", d=bad) is None


def test_edges_of_geojson_are_straight_in_degrees(sql):
    # the great circle from (0, 60) to (40, 60) rises to 61.5 degrees
    ring = [[0, 60], [0, 50], [40, 50], [40, 60], [0, 60]]
    document = json.dumps({"type": "Polygon", "coordinates": [ring]})
    text = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in ring) + "))"
    for lat, straight, circle in ((59.9999, True, True), (60.0001, False, True), (61.0, False, True), (62.0, False, False)):
        assert sql("st_within(st_geogpoint(20D, :y), st_geogfromgeojson(:d))", y=lat, d=document) == straight
        assert sql("st_within(st_geogpoint(20D, :y), st_geogfromtext(:t))", y=lat, t=text) == circle


def test_nulls_and_what_is_not_measured(sql):
    assert sql("st_distance(st_geogpoint(1D, null), st_geogpoint(1D, 2D))") is None
    assert sql("st_within(st_geogfromtext('x'), st_geogpoint(1D, 2D))") is None
    assert sql("st_distance(st_geogfromtext('POINT EMPTY'), st_geogpoint(1D, 2D))") is None
    with pytest.raises(PySparkException):
        sql("st_distance(st_geogfromtext('LINESTRING (1 2, 3 4)'), st_geogfromtext('LINESTRING (1 2, 3 4)'))")
