"""Distance joins, the nearest join and point in polygon against brute force."""

import math
import random
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from voltscape.functions import geo, joins
from voltscape.operators import spatial
from voltscape.operators.proximity import poi_proximity, road_proximity
from voltscape.operators.stations import within_boundary
from voltscape.sources import tables

R = geo.EARTH_RADIUS_M


def haversine(lon1, lat1, lon2, lat2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    a += math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(a))


def vector(lon, lat):
    lon, lat = math.radians(lon), math.radians(lat)
    return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)


def segment_brute(lon, lat, a, b, steps=4000):
    """Least distance to many points of the great circle between a and b."""
    va, vb = vector(*a), vector(*b)
    best = math.inf
    for i in range(steps + 1):
        x, y, z = (p + (q - p) * i / steps for p, q in zip(va, vb))
        best = min(best, haversine(lon, lat, math.degrees(math.atan2(y, x)), math.degrees(math.atan2(z, math.hypot(x, y)))))
    return best


def cloud(seed, centres, n, spread):
    rng = random.Random(seed)
    points = []
    for _ in range(n):
        lon, lat = rng.choice(centres)
        lat = max(-89.999, min(89.999, lat + rng.uniform(-spread, spread)))
        lon += rng.uniform(-spread, spread) / max(math.cos(math.radians(lat)), 0.01)
        points.append(((lon + 180) % 360 - 180, lat))
    return points


CENTRES = [(10.0, 60.0), (179.999, -17.0), (0.0, 0.0), (25.0, 84.9), (-60.0, -45.0), (100.0, 89.95)]


@pytest.mark.parametrize("few", [True, False])
@pytest.mark.parametrize("radius", [500.0, 3000.0])
def test_points_within_finds_every_pair(spark, monkeypatch, few, radius):
    monkeypatch.setattr(spatial, "is_small", lambda df, n=0: few)
    places = cloud(1, CENTRES, 150, 0.02)
    points = cloud(2, CENTRES, 400, 0.02)
    sites = spark.createDataFrame(places, "lon double, lat double")
    pois = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "poi_id bigint, lon double, lat double")
    pairs = spatial.points_within(sites, pois, radius)
    found = {(r.site_lon, r.site_lat, r.poi_id): r.distance_m for r in pairs.collect()}
    wanted = {
        (a[0], a[1], i): d for a in places for i, p in enumerate(points) if (d := haversine(*a, *p)) <= radius
    }
    assert set(found) == set(wanted) and len(wanted) > 100
    assert all(abs(found[k] - wanted[k]) < 1e-5 for k in wanted)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


@pytest.mark.parametrize("few", [True, False])
def test_lines_within_measures_whole_segments(spark, monkeypatch, few):
    monkeypatch.setattr(spatial, "is_small", lambda df, n=0: few)
    centres = CENTRES[:-1]
    places = cloud(3, centres, 60, 0.02)
    rng = random.Random(4)
    lines = []
    for i, (lon, lat) in enumerate(cloud(5, centres, 60, 0.02)):
        # some segments are a hundred times longer than the radius, one line is a point
        reach = 0.6 if i % 7 == 0 else 0.01
        line = [(lon, lat)]
        for _ in range(0 if i == 3 else 2):
            lon = (lon + rng.uniform(-reach, reach) + 180) % 360 - 180
            lat = max(-89.0, min(89.0, lat + rng.uniform(-reach, reach) / 3))
            line.append((lon, lat))
        lines.append(line)
    sites = spark.createDataFrame(places, "lon double, lat double")
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "road_id bigint, coordinates array<struct<lon:double,lat:double>>")
    pairs = spatial.lines_within(sites, frame, 500.0).groupBy("site_lon", "site_lat", "road_id").agg(F.min("distance_m").alias("d"))
    found = {(r.site_lon, r.site_lat, r.road_id): r.d for r in pairs.collect()}
    wanted = {}
    for a in places:
        for i, line in enumerate(lines):
            ends = list(zip(line, line[1:])) or [(line[0], line[0])]
            near = [e for e in ends if min(haversine(*a, *e[0]), haversine(*a, *e[1])) < 500 + haversine(*e[0], *e[1])]
            if near:
                wanted[(*a, i)] = min(segment_brute(*a, *e) for e in near)
    # brute force steps along the line, so it may be a little too long
    assert {k for k, d in wanted.items() if d <= 499} <= set(found) <= {k for k, d in wanted.items() if d <= 501}
    assert len(found) > 20
    assert all(-0.001 <= wanted[k] - found[k] < 5 for k in found)


@pytest.mark.parametrize("small", [True, False])
def test_nearest_equals_brute_force(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    rng = random.Random(6)
    # a dense town, a few far points, equal distances and copies
    points = [(rng.gauss(10, 0.01), rng.gauss(60, 0.01)) for _ in range(600)]
    points += [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(20)] + [(0.0, 1.0), (0.0, -1.0), (0.0, 1.0), (180.0, 90.0), (-200.0, -95.0)]
    frame = spark.createDataFrame([(len(points) - i, float(i), *p) for i, p in enumerate(points)], "k bigint, v double, lon double, lat double")
    places = [(0.0, 0.0), (10.0, 60.0), (10.4, 60.2), (-170.0, -80.0), (179.9, 89.9), (180.0, 88.0), (-190.0, -90.0)]
    places += [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(40)]
    places += [(rng.gauss(10, 0.02), rng.gauss(60, 0.02)) for _ in range(60)]
    sites = spark.createDataFrame([*places, places[0], (None, 1.0)], "lon double, lat double")
    found = {(r.lon, r.lat): (r.k, r.v) for r in spatial.nearest(sites, frame, "k", "v", leaf_points=8).collect()}
    assert len(found) == len(set(places))
    for place in places:
        order = [((place[0] - p[0]) ** 2 + (place[1] - p[1]) ** 2, len(points) - i, float(i)) for i, p in enumerate(points)]
        assert found[place] == min(order)[1:]


def test_nearest_without_points(spark):
    none = spark.createDataFrame([], "k bigint, v double, lon double, lat double")
    assert spatial.nearest(spark.createDataFrame([(1.0, 2.0)], "lon double, lat double"), none, "k", "v").count() == 0


def test_boundary_with_hole_and_parts(spark):
    document = """{"type": "FeatureCollection", "features": [
      {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [
        [[[0,0],[10,0],[10,10],[0,10],[0,0]], [[4,4],[6,4],[6,6],[4,6],[4,4]]], [[[20,0],[22,0],[21,3],[20,0]]]]}},
      {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[50,50],[51,50],[51,51],[50,50]]]}}]}"""
    edges = tables.boundary_edges(spark.createDataFrame([(document,)], "value string"), "value")
    assert edges.count() == 11
    rows = [(1, 5.0, 1.0), (2, 5.0, 5.0), (3, 21.0, 1.0), (4, 50.6, 50.2), (5, 11.0, 5.0), (6, 5.0, 1.0), (7, None, 1.0)]
    points = spark.createDataFrame(rows, "id int, lon double, lat double")
    assert sorted(r.id for r in within_boundary(points, edges).collect()) == [1, 3, 6]


@pytest.mark.parametrize("wrap", ["%s", '{"type": "Feature", "geometry": %s}'])
def test_boundary_shapes(spark, tmp_path, wrap):
    path = tmp_path / "b.geojson"
    path.write_text(wrap % '{"type": "Polygon",\n "coordinates": [[[0,0],[2,0],[2,2],[0,2],[0,0]]]}')
    edges = tables.read_boundary(spark, str(path))
    assert sorted(tuple(e) for e in edges.collect())[0] == (0.0, 0.0, 2.0, 0.0) and edges.count() == 4


@pytest.mark.parametrize("document", ['{"type": "FeatureCollection", "features": []}', '{"type": "Feature"}', '{"type": "Point", "coordinates": [1, 2]}'])
def test_boundary_without_polygon_is_an_error(spark, document):
    with pytest.raises(Exception, match="no polygon"):
        tables.boundary_edges(spark.createDataFrame([(document,)], "value string"), "value").collect()


STATIONS = [(1, 10.0, 60.0), (2, 10.0, 60.0), (3, 50.0, 10.0)]


def test_poi_proximity_counts_classes_and_keeps_lonely_stations(spark):
    stations = spark.createDataFrame(STATIONS, "id bigint, lon double, lat double")
    pois = spark.createDataFrame(
        [(1, "cafe", "A", 10.001, 60.0), (1, "cafe", "A", 10.001, 60.0), (2, "bar", None, 10.002, 60.0), (3, "mill", "M", 10.003, 60.0),
         (4, "odd", "O", 10.004, 60.0), (5, "cafe", "far", 10.5, 60.0)],
        "id bigint, fclass string, name string, lon double, lat double",
    )
    categories = spark.createDataFrame([("Food", ["cafe", "bar"]), ("Fun", ["bar"]), (None, ["odd"])], "superclass string, subclass array<string>")
    rows = {(r.id, r.superclass): r for r in poi_proximity(stations, pois, categories).collect()}
    assert {k: r.poi_count for k, r in rows.items()} == {
        (i, c): n for i in (1, 2) for c, n in (("Food", 2), ("Fun", 1), (None, 2))
    } | {(3, None): 0}
    assert rows[(1, "Food")].poi_names == ["A"] and rows[(1, "Fun")].poi_names is None
    assert rows[(1, None)].poi_names == ["M", "O"]
    assert rows[(1, "Food")].closest_distance_meters == pytest.approx(haversine(10, 60, 10.001, 60))
    assert rows[(3, None)].closest_distance_meters is None


def test_station_with_two_locations_is_an_error(spark):
    stations = spark.createDataFrame([(1, 10.0, 60.0), (1, 11.0, 60.0)], "id bigint, lon double, lat double")
    roads = spark.createDataFrame([], "id bigint, class string, name string, coordinates array<struct<lon:double,lat:double>>")
    with pytest.raises(Exception, match="two locations"):
        road_proximity(stations, roads).collect()


def test_spread_join_splits_hot_keys_without_loss(spark):
    left = spark.range(300).selectExpr("if(id < 200, 0, id) as k", "id as l")
    right = spark.range(300).selectExpr("if(id < 120, 0, id) as k", "id as r")
    plain = left.join(right, "k")
    for limits in ({"rows_per_task": 16}, {"pairs_per_task": 100}, {"rows_per_task": 50, "pairs_per_task": 1}, {}):
        spread = joins.spread_join(left, right, ["k"], **limits)
        assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain.collect()))
        assert spread.columns == ["k", "l", "r"]


def test_spread_join_broadcasts_no_side_by_its_estimate(spark):
    left = spark.range(100).selectExpr("id as k", "id as l")
    # 80 bytes by estimate, however many rows they become
    right = spark.range(10).selectExpr("id as k", "explode(sequence(0, 1000)) as r")
    spread = joins.spread_join(left, right, ["k"])
    assert "SortMergeJoin [k" in spread._jdf.queryExecution().executedPlan().toString()
    assert spread.count() == 10_010


def test_dealt_rows_follow_their_weight(spark):
    rows = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(100)], "k long, w int").coalesce(1)
    for weight, parts in (("1", 10), ("w", 24), ("0", 1)):
        spread = joins.dealt(rows, weight, per_task=10)
        assert spread.rdd.getNumPartitions() == parts
        assert sorted(r.k for r in spread.collect()) == list(range(100))
    none = rows.where("k < 0")
    assert joins.dealt(none, "w", per_task=10).count() == 0


def test_lookup_pairs_equals_join(spark):
    left = spark.range(300).selectExpr("if(id < 200, 0, id) as k", "id as l")
    right = spark.range(300).selectExpr("id as k", "id * 2 as r")
    for known in (300, joins.BROADCAST_ROWS + 1):
        looked = joins.lookup_pairs(left, right, ["k"], right_rows=known)
        assert sorted(map(tuple, looked.collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_repeated_rows_give_the_same_pairs_on_both_paths(spark, monkeypatch):
    sites = spark.createDataFrame([(10.0, 60.0), (10.0, 60.0), (10.001, 60.0)], "lon double, lat double")
    pois = spark.createDataFrame([(1, 10.0, 60.001)] * 3 + [(2, 10.002, 60.0)], "poi_id bigint, lon double, lat double")
    lines = spark.createDataFrame(
        [(1, [(10.0, 60.0), (10.01, 60.0), (10.01, 60.01)])] * 2, "road_id bigint, coordinates array<struct<lon: double, lat: double>>"
    )
    found = {}
    for few in (True, False):
        monkeypatch.setattr(spatial, "is_small", lambda df, n=0, few=few: few)
        pairs = spatial.points_within(sites, pois).select("site_lon", "poi_id").collect()
        roads = spatial.lines_within(sites, lines).selectExpr("site_lon", "road_id", "round(distance_m, 3) as d").collect()
        found[few] = sorted(map(tuple, pairs)), sorted(map(tuple, roads))
    assert found[True] == found[False] and len(found[True][0]) == 8


def _around(spark, monkeypatch, few, limits, frame, *rest):
    monkeypatch.setattr(spatial, "is_small", lambda df, n=0: few)
    monkeypatch.setattr(spatial, "spread_sides", partial(joins.spread_sides, **limits))
    rows = (road_proximity if len(rest) == 1 else poi_proximity)(frame, *rest).collect()
    return sorted((tuple(r)[:5] + (round(r[5] or 0, 6), r[6]) for r in [(*r[:3], str(r[3]), r[4], r[5], r[6]) for r in rows]), key=str)


def test_proximity_is_the_same_whole_and_in_parts(spark, monkeypatch):
    rng = random.Random(11)
    centres = [(10.0, 60.0), (179.999, -17.0)]
    places = [(i, *p) for i, p in enumerate(cloud(12, centres, 60, 0.01))]
    stations = spark.createDataFrame([*places, (100, *places[0][1:]), (101, None, 60.0), (102, None, None), (103, 50.0, 10.0)], "id bigint, lon double, lat double")
    roads = []
    for i, (lon, lat) in enumerate(cloud(13, centres, 200, 0.01)):
        # ids repeat or are missing, lines have several segments near one place, some no vertex
        line = [(lon + k * 0.001, lat + (k % 2) * 0.001) for k in range(i % 5)]
        roads.append((None if i % 17 == 0 else i // 2, rng.choice(["a", "b", None]), rng.choice(["n", "m", None]), [*line, (None, lat)] if i % 13 == 0 else line))
    lines = spark.createDataFrame(roads, "id bigint, class string, name string, coordinates array<struct<lon:double,lat:double>>")
    points = [(None if i % 17 == 0 else i // 2, rng.choice(["x", "y", "z"]), rng.choice(["n", "m", None]), *p) for i, p in enumerate(cloud(14, centres, 300, 0.01))]
    pois = spark.createDataFrame([*points, (900, "x", "n", None, 60.0), (901, "x", "n", 10.0, None)], "id bigint, fclass string, name string, lon double, lat double")
    categories = spark.createDataFrame([("X", ["x", "y"]), ("Y", ["y"])], "superclass string, subclass array<string>")
    for rest in ((lines,), (pois, categories)):
        whole = _around(spark, monkeypatch, True, {}, stations, *rest)
        assert len(whole) > 100 and any(r[6] and len(r[6]) > 1 for r in whole)
        for limits in ({}, {"rows_per_task": 3, "pairs_per_task": 20}):
            assert _around(spark, monkeypatch, False, limits, stations, *rest) == whole


def test_pairs_are_not_moved_to_be_counted(spark, monkeypatch):
    monkeypatch.setattr(spatial, "is_small", lambda df, n=0: False)
    stations = spark.createDataFrame(STATIONS, "id bigint, lon double, lat double")
    roads = spark.createDataFrame([(1, "a", "n", [(10.0, 60.0), (10.01, 60.0)])], "id bigint, class string, name string, coordinates array<struct<lon:double,lat:double>>")
    plan = road_proximity(stations, roads, names=False)._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\((.*)", plan)
    assert moved and not any("road_id" in keys for keys in moved)
    # rows meet by part only, and are moved before they are repeated for cells or measured
    assert "ShuffledHashJoin [_part" in plan and not any("_chord2" in keys or "band" in keys for keys in moved)


def test_few_keys_drop_other_rows_and_parts_add_up(spark):
    left = spark.range(300).selectExpr("if(id < 200, 0, id) as k", "id as l")
    right = spark.range(600).selectExpr("if(id < 240, 0, id - 100) as k", "id div 3 as r")
    wanted = {r.l: r.n for r in left.join(right, "k").groupBy("l").agg(F.count_distinct("r").alias("n")).collect()}
    for limits in ({}, {"rows_per_task": 50, "pairs_per_task": 100}):
        for most in (500, 1):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(joins, "BROADCAST_ROWS", most)
                here, there = joins.spread_sides(left, right, ["k"], ["r"], **limits)
            met = here.join(there, joins.PART)
            parts = met.groupBy(joins.PART, "l").agg(F.count_distinct("r").alias("n"))
            found = {r.l: r.n for r in parts.groupBy("l").agg(F.sum("n").alias("n")).collect()}
            assert found == wanted
            if most == 500:
                assert there.select("r").distinct().count() == 114
            assert limits or met.groupBy(joins.PART).count().count() == 101


@pytest.mark.parametrize("few", [True, False])
def test_lines_over_the_pole(spark, monkeypatch, few):
    monkeypatch.setattr(spatial, "is_small", lambda df, n=0: few)
    rng = random.Random(15)
    # up to some 10 km from the pole, lines of up to 20 km that pass beside or over it
    places = [(rng.uniform(-180, 180), 90 - abs(rng.gauss(0, 0.03))) for _ in range(80)] + [(0.0, 90.0), (12.0, 89.9999)]
    lines = [[(rng.uniform(-180, 180), 90 - rng.uniform(0.001, 0.09)) for _ in range(2)] for _ in range(30)]
    lines += [[(10.0, 89.93), (-170.0, 89.93)], [(0.0, 89.95), (179.0, 89.95)], [(30.0, 89.9955), (-150.0, 89.9955)]]
    sites = spark.createDataFrame(places, "lon double, lat double")
    frame = spark.createDataFrame(list(enumerate(lines)), "road_id bigint, coordinates array<struct<lon:double,lat:double>>")
    pairs = spatial.lines_within(sites, frame, 500.0, together="road_id")
    found = {(r.site_lon, r.site_lat, r.road_id) for r in pairs.collect()}
    near = {(*a, i): segment_brute(*a, *line, steps=600) for a in places for i, line in enumerate(lines)}
    assert {k for k, d in near.items() if d <= 499} <= found <= {k for k, d in near.items() if d <= 501}
    assert len(found) > 100
