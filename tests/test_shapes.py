"""Distances to shapes of any kind against brute force: holes, parts, the antimeridian, odd places."""

import math
import random

import pytest
from pyspark.sql import functions as F

from voltscape.functions import geo
from voltscape.operators import shapes
from voltscape.sources import derived

RADIUS = geo.EARTH_RADIUS_M


def vector(lon, lat):
    a, b = math.radians(lon), math.radians(lat)
    return (math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b))


def cross(a, b):
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def angle(a, b):
    n = cross(a, b)
    return math.atan2(math.sqrt(dot(n, n)), dot(a, b))


def to_segment(p, a, b):
    n = cross(a, b)
    length = math.sqrt(dot(n, n))
    if length > 1e-15:
        n = tuple(x / length for x in n)
        if dot(cross(n, a), p) >= 0 and dot(cross(b, n), p) >= 0:
            return abs(math.asin(max(-1.0, min(1.0, dot(n, p)))))
    return min(angle(p, a), angle(p, b))


def winds(p, rings):
    """Turns of the rings around the place, as the sum of the angles its edges take up."""
    total = 0.0
    for ring in rings:
        for a, b in zip(ring, ring[1:]):
            va, vb = vector(*a), vector(*b)
            ta = tuple(x - dot(va, p) * y for x, y in zip(va, p))
            tb = tuple(x - dot(vb, p) * y for x, y in zip(vb, p))
            total += math.atan2(dot(cross(ta, tb), p), dot(ta, tb))
    return round(total / (2 * math.pi)) % 2 == 1


def distance(place, shape):
    kind, parts = shape
    p, lists = vector(*place), [ring for part in parts for ring in part]
    if kind.endswith("POLYGON") and winds(p, lists):
        return 0.0
    gaps = [to_segment(p, vector(*a), vector(*b)) for own in lists for a, b in zip(own, own[1:] or own)]
    return RADIUS * min(gaps, default=math.inf)


def blob(draw, x, y, size, n):
    """A star-shaped closed ring."""
    turns = sorted(draw.uniform(0, 2 * math.pi) for _ in range(n))
    found = []
    for t in turns:
        r = size * draw.uniform(0.6, 1)
        found.append(((x + r * math.cos(t) + 180) % 360 - 180, y + r * math.sin(t) / 2))
    return [*found, found[0]]


def text(shape):
    kind, parts = shape

    def listed(own):
        return "(" + ", ".join(f"{x!r} {y!r}" for x, y in own) + ")"

    if kind == "MULTIPOLYGON":
        return f"{kind} ({', '.join('(' + ', '.join(map(listed, part)) + ')' for part in parts)})"
    if kind == "POLYGON":
        return f"{kind} ({', '.join(map(listed, parts[0]))})"
    return f"{kind} {listed(parts[0][0])}"


def some_shapes(draw, x, y, spread, size, n):
    found = {}
    for k in range(n):
        cx, cy = x + draw.uniform(-spread, spread), y + draw.uniform(-spread, spread) / 2
        outer = blob(draw, cx, cy, size, draw.choice([3, 12, 60]))
        if k % 5 == 0:
            found[k] = ("POLYGON", [[outer]])
        elif k % 5 == 1:
            found[k] = ("POLYGON", [[outer, blob(draw, cx, cy, size * 0.4, 9)]])
        elif k % 5 == 2:
            found[k] = ("MULTIPOLYGON", [[outer], [blob(draw, cx + 2 * size, cy, size * 0.5, 7)]])
        elif k % 5 == 3:
            found[k] = ("LINESTRING", [[outer[:-1]]])
        else:
            found[k] = ("POINT", [[[outer[0]]]])
    return found


def frame(spark, found):
    rows = [(k, text(s)) for k, s in found.items()] + [(900, "POLYGON EMPTY"), (901, "no shape"), (902, None)]
    return shapes.read_shapes(spark.createDataFrame(rows, "key long, geometry string"))


def places_of(spark, places):
    return spark.createDataFrame([*places, places[0], (None, None)], "lon double, lat double")


@pytest.mark.parametrize(("x", "y"), [(10.0, 60.0), (179.999, -20.0)])
@pytest.mark.parametrize("small", [True, False])
def test_shapes_within(spark, monkeypatch, x, y, small):
    if not small:
        monkeypatch.setattr(shapes, "BROADCAST_ROWS", 0)
        monkeypatch.setattr("voltscape.operators.spatial.BROADCAST_ROWS", 0)
    draw = random.Random(f"{x}{y}")
    found = some_shapes(draw, x, y, 0.03, 0.01, 40) | {50: ("POLYGON", [[blob(draw, x, y, 4.0, 25)]])}
    places = [((x + draw.uniform(-0.05, 0.05) + 180) % 360 - 180, y + draw.uniform(-0.02, 0.02)) for _ in range(60)]
    got = {
        ((r.site_lon, r.site_lat), r.key): r.distance_m
        for r in shapes.shapes_within(places_of(spark, places), frame(spark, found), "key", 500.0).collect()
    }
    wanted = {(p, k): d for p in places for k, s in found.items() if (d := distance(p, s)) <= 500}
    assert got.keys() == wanted.keys()
    assert all(abs(got[k] - wanted[k]) < 1e-4 for k in wanted)
    assert sum(d == 0 for d in wanted.values()) > 60 and sum(d > 0 for d in wanted.values()) > 60


def planar(place, shape):
    kind, parts = shape
    lists = [ring for part in parts for ring in part]
    odd, least = False, math.inf
    for own in lists:
        for (x1, y1), (x2, y2) in zip(own, own[1:] or own):
            if kind.endswith("POLYGON") and (x1 > place[0]) != (x2 > place[0]):
                odd ^= place[1] < y1 + (place[0] - x1) / (x2 - x1) * (y2 - y1)
            size = (x2 - x1) ** 2 + (y2 - y1) ** 2
            t = max(0.0, min(1.0, ((place[0] - x1) * (x2 - x1) + (place[1] - y1) * (y2 - y1)) / size)) if size else 0.0
            least = min(least, math.hypot(place[0] - x1 - t * (x2 - x1), place[1] - y1 - t * (y2 - y1)))
    return 0.0 if odd else least


@pytest.mark.parametrize("leaf", [2, 64])
def test_nearest_shape(spark, leaf):
    draw = random.Random(leaf)
    found = some_shapes(draw, 12.0, 62.0, 3.0, 0.2, 60) | some_shapes(draw, 100.0, 0.0, 1.0, 5.0, 3)
    found |= {1000 + k: s for k, s in list(found.items())[:10]}  # ties go to the smaller key
    places = [(12 + draw.uniform(-5, 5), 62 + draw.uniform(-2, 2)) for _ in range(50)] + [(-170.0, -80.0), (100.0, 0.1)]
    got = {
        (r.lon, r.lat): (r.key, r.distance_deg)
        for r in shapes.nearest_shape(places_of(spark, places), frame(spark, found), "key", leaf).collect()
    }
    assert got.keys() == set(places)
    for p in places:
        gap, key = min((planar(p, s), k) for k, s in found.items())
        assert got[p][0] == key and abs(got[p][1] - gap) < 1e-9
    assert any(d == 0 for _, d in got.values())


def test_nothing_near(spark):
    none = frame(spark, {})
    places = places_of(spark, [(1.0, 2.0)])
    assert shapes.shapes_within(places, none, "key").count() == 0
    assert shapes.nearest_shape(places, none, "key").count() == 0
    assert shapes.inside(places, none, "key").count() == 0
    some = frame(spark, {1: ("POINT", [[[(1.0, 2.0)]]])})
    assert shapes.nearest_shape(places.where(F.lit(False)), some, "key").count() == 0


def test_no_cross_join_and_few_edges_per_place(spark):
    """A place meets the edges of its strip, not all of the area's."""
    draw = random.Random(3)
    ring = blob(draw, 0.0, 0.0, 1.0, 4000)
    areas = frame(spark, {1: ("POLYGON", [[ring]])})
    plan = shapes.inside(places_of(spark, [(0.1, 0.1)]), areas, "key")._jdf.queryExecution().executedPlan().toString()
    assert "Nested" not in plan and "Cartesian" not in plan


def test_texts_are_made_and_read_by_several_tasks(spark, tmp_path, monkeypatch):
    spark.range(1, 61).selectExpr("nullif(id, 7) as s_suppkey").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    parts = "nullif(id, 7) as p_partkey", "'LARGE' as p_type", "1 as p_size", "'part' as p_name"
    spark.range(1, 61).selectExpr(*parts).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))

    def inputs():
        return derived.Inputs(spark, str(tmp_path))

    def rows(df):
        return sorted(map(repr, df.collect()))

    before = rows(inputs().trails), rows(inputs().shapes)
    monkeypatch.setattr(derived, "VERTICES_PER_TASK", 1_000)
    monkeypatch.setattr(derived, "TEXTS_PER_TASK", 10)
    after = inputs()
    # 59 trails of 6,050 vertices, 60 points of interest
    assert after.trails.rdd.getNumPartitions() == 7 and after.shapes.rdd.getNumPartitions() == 6
    assert (rows(after.trails), rows(after.shapes)) == before
