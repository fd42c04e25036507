"""Sources, pivots, cleaning and derived columns on small literal frames."""

import json
import os

import pytest
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions import geo, staging, wkt
from voltscape.operators import cleaning, features, pivots, rings, scoring
from voltscape.sources import tables


def test_point_text(spark):
    texts = ["POINT(10.5 66.1)", "POINT (10.5 66.1)", " POINT ( -1e1 .5 ) ", "POINT EMPTY", "LINESTRING (1 2, 3 4)", None, "POINT (x y)"]
    frame = spark.createDataFrame([(t,) for t in texts], "geometry string")
    got = [(r.lng, r.lat) for r in features.coordinates(frame).collect()]
    assert got == [(10.5, 66.1), (10.5, 66.1), (-10.0, 0.5), *[(None, None)] * 4]
    assert tables.read_points(frame, "geometry").first().lon == 10.5


def test_line_and_polygon_text(spark):
    frame = spark.createDataFrame(
        [("LINESTRING (1 2, 3 4,5.5 -6)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))"), ("POINT (1 2)", "POLYGON EMPTY")],
        "line string, polygon string",
    )
    rows = frame.select(
        geo.line_coordinates(F.col("line")).alias("l"),
        wkt.geometry("polygon").alias("g"),
    ).selectExpr("l", f"{wkt.rings('g')} as p").withColumn("e", geo.ring_edges(F.col("p"))).collect()
    assert [tuple(v) for v in rows[0].l] == [(1.0, 2.0), (3.0, 4.0), (5.5, -6.0)]
    assert [len(r) for r in rows[0].p] == [4, 4] and len(rows[0].e) == 6
    assert tuple(rows[0].e[3]) == (1.0, 1.0, 2.0, 1.0)
    assert rows[1].l is None and rows[1].p == []


def test_query_binds_only_used_parameters(spark):
    frame = spark.range(5)
    assert tables.query(spark, "select id from {t} where id > :low", {"low": 2, "unused": None}, t=frame).count() == 2
    assert tables.query(spark, "select id from {t}", {"unused": "x"}, t=frame).count() == 5


def test_csv_keeps_types_and_nested_columns(spark, tmp_path):
    frame = spark.sql("select 1L as id, date'2024-01-02' as d, cast(null as string) as s, array(named_struct('a', 1, 'b', 'x,\"y')) as n")
    tables.write_csv(frame, str(tmp_path / "c"))
    read = tables.read_csv(spark, str(tmp_path / "c"), "id bigint, d date, s string, n string")
    back = read.withColumn("n", F.from_json("n", frame.schema["n"].dataType))
    assert back.collect() == frame.collect()


def test_replace_table(spark):
    tables.replace_table(spark.range(3), "replaced")
    again = tables.replace_table(spark.range(5).withColumn("x", F.lit(1)), "replaced")
    assert again.count() == 5 and again.columns == ["id", "x"]


def test_stage_uses_the_shared_folder(spark):
    staged = staging.stage(spark.range(3), "three")
    assert staged.count() == 3
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]


def test_map_extracts(spark, tmp_path):
    nodes = [{"type": "node", "id": i, "lat": 60.0 + i, "lon": 10.0} for i in range(5)]
    tag = {"landuse": "residential"}
    one = {
        "version": 0.6,
        "elements": [
            *nodes,
            {"type": "way", "id": 1, "nodes": [0, 1, 2, 0], "tags": tag},
            {"type": "way", "id": 2, "nodes": [3, 4]},
            {"type": "way", "id": 3, "nodes": [4, 3, 1, 4]},
            {"type": "relation", "id": 9, "tags": {**tag, "type": "multipolygon"},
             "members": [{"type": "way", "ref": 2, "role": "outer"}, {"type": "way", "ref": 3, "role": "inner"}]},
        ],
    }
    (tmp_path / "a.json").write_text(json.dumps(one))
    (tmp_path / "b.json").write_text(json.dumps({"version": 0.6, "elements": []}))
    elements = tables.read_extracts(spark, str(tmp_path))
    assert elements.count() == 9
    lines = {r.way: r for r in tables.way_lines(elements).collect()}
    assert [p.lat for p in lines[3].coordinates] == [64.0, 63.0, 61.0, 64.0]
    assert (lines[1].closed, lines[2].closed) == (True, False)
    found = rings.areas(elements)
    whole = sorted((r.area, r.role, len(r.coordinates)) for r in found.rings.collect())
    assert whole == [("relation/9", "inner", 4), ("way/1", "outer", 4)]
    assert [(r.relation, r.role, r.ring, r.open_ends) for r in found.open.collect()] == [(9, "outer", 2, 2)]


def counts(spark):
    return spark.createDataFrame(
        [(1, "Cafe and restaurant", 2, 50.0), (1, "Hobby", 1, 0.0), (1, None, 3, 5.0), (2, None, 0, None)],
        "id bigint, superclass string, poi_count bigint, closest_distance_meters double",
    )


def test_poi_features(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    rows = {r.id: r.asDict() for r in pivots.poi_features(counts(spark), ids).collect()}
    assert rows[1] == {"id": 1, "cafe_and_restaurant_count": 2.0, "hobby_count": 1.0, "cafe_and_restaurant_dist": 50.0, "hobby_dist": 0.0}
    assert rows[2]["hobby_dist"] == 1000.0 and rows[3]["cafe_and_restaurant_count"] == 0.0


def roads(spark, extra=()):
    return spark.createDataFrame(
        [(1, "motorway", 2, 30.0), (1, "track", 1, 0.0), (2, None, 0, None), *extra],
        "id bigint, type_road string, roads_count bigint, closest_distance_meters double",
    )


def test_road_features(spark):
    rows = {r.id: r.asDict() for r in pivots.road_features(roads(spark)).collect()}
    assert rows[1]["road_distance_motorway"] == 30.0 and rows[1]["road_count_motorway"] == 2.0
    # found at exactly 0 m counts as absent, and so does a missing class
    assert rows[1]["road_distance_track"] == 1000.0 and rows[1]["road_count_track"] == 1.0
    assert rows[2]["road_distance_service"] == 1000.0 and rows[2]["road_count_living_street"] == 0.0
    assert {f"road_distance_{c}" for c in fixed.ROAD_CLASSES + fixed.CHECKED_ROAD_CLASSES} <= set(rows[1])


def test_road_features_refuse_repeated_classes(spark):
    with pytest.raises(Exception, match="several rows"):
        pivots.road_features(roads(spark, [(1, "motorway", 1, 3.0)])).collect()


def test_poi_features_accept_any_class_name(spark):
    names = ["Food & drink", "24h-shop", "Café", "O'Neill", "tick`ed", "a.b"]
    counts = spark.createDataFrame(
        [(1, name, k + 1, 10.0 * k) for k, name in enumerate(names)],
        "id bigint, superclass string, poi_count bigint, closest_distance_meters double",
    )
    rows = {r.id: r.asDict() for r in pivots.poi_features(counts, spark.range(1, 3)).collect()}
    for k, name in enumerate(names):
        column = name.lower().replace(" ", "_")
        assert rows[1][f"{column}_count"] == k + 1.0 and rows[1][f"{column}_dist"] == 10.0 * k
        assert rows[2][f"{column}_count"] == 0.0 and rows[2][f"{column}_dist"] == 1000.0


def test_poi_features_refuse_names_that_become_equal(spark):
    counts = spark.createDataFrame(
        [(1, "Home shop", 1, 1.0), (1, "home_shop", 1, 1.0)],
        "id bigint, superclass string, poi_count bigint, closest_distance_meters double",
    )
    with pytest.raises(ValueError, match="home_shop"):
        pivots.poi_features(counts, spark.range(1, 2))


def test_poi_features_have_one_row_per_id_and_any_number_of_classes(spark):
    counts = spark.range(600).selectExpr(
        "id % 2 as id", "concat('c', id) as superclass", "1L as poi_count", "2.0D as closest_distance_meters"
    )
    found = pivots.poi_features(counts, spark.createDataFrame([(0,), (0,), (1,)], "id bigint"))
    assert found.count() == 2 and len(found.columns) == 1201
    assert pivots.poi_features(counts.limit(0), spark.range(2)).count() == 2


def test_one_row_per_id(spark):
    frame = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 2), (2, None, 3)], "id bigint, `a b` string, c int")
    assert sorted(map(tuple, cleaning.one_row_per_id(frame).collect())) == [(1, "a", 2), (2, None, 3)]


def test_performance_rank_keeps_rows_without_a_value(spark):
    frame = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 7.0), (4, None)], "id bigint, percentage_average double")
    ranks = {r.id: r.score_performance for r in scoring.performance_rank(frame).collect()}
    assert ranks == {1: 4, 2: 4, 3: 2, 4: None}


def test_staged_folders_can_be_cleared(spark):
    staged = staging.stage(spark.range(3), "cleared")
    folder = staged.inputFiles()[0].removeprefix("file:").rpartition("/")[0]
    assert os.path.isdir(folder)
    assert staging.clear(spark) >= 1 and not os.path.exists(folder)
    assert staging.clear(spark) == 0


def test_with_signal_drops_all_rows_of_an_id(spark):
    frame = spark.createDataFrame([(1, 0, None), (1, 5, 1), (2, 1, None), (3, None, None)], "id int, a int, b int")
    assert [r.id for r in cleaning.with_signal(frame, ["a", "b"]).collect()] == [2]


def test_merge_takes_road_side_and_poi_operator(spark):
    road = spark.sql("select 1 as id, 'r' as operator, 'T' as title, 'x' as address, 7.0D as road_distance_trunk, 2.0D as road_count_residential")
    poi = spark.sql("select 1 as id, 'p' as operator, 'other' as title, 3.0D as grocery_count, 4.0D as grocery_dist")
    merged = cleaning.merge_features(road, poi).first().asDict()
    assert merged == {"id": 1, "station_name": "T", "trunk_dist": 7.0, "road_count_residential": 2.0, "operator": "p", "supermarket_count": 3.0, "grocery_dist": 4.0}


def test_complete_rows(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "id int, s string")
    assert [r.id for r in cleaning.complete_rows(frame).collect()] == [1]


def test_time_spent_counts_only_present_columns(spark):
    frame = spark.sql("select 2.0D as grocery_count, 1.0D as cafe_and_restaurant_count, 0.0D as hobby_count")
    assert features.time_spent(frame).first().total_time_spent == 97.5
    assert features.time_spent(frame.withColumnRenamed("grocery_count", "supermarket_count")).first().total_time_spent == 67.5


def test_poi_groups_and_presence(spark):
    frame = spark.sql("select 1.0D as shopping_center_count, 2.0D as food_count")
    row = features.poi_presence(features.poi_groups(frame)).first()
    assert (row.Supermarket, row.Shopping, row.Restaurant, row.Hotel) == (1.0, 1.0, 2.0, 0)
    assert (row.poi_categories_present, row.poi_categories_present_str) == (3, "3/6")


def test_nearest_major_road(spark):
    frame = spark.sql("select * from values (5.0D, 5.0D, 9.0D), (null, 8.0D, 3.0D) as t(motorway_dist, trunk_dist, primary_dist)")
    rows = [(r.nearest_major_road_dist, r.nearest_major_road_type) for r in features.nearest_major_road(frame).collect()]
    assert rows == [(5.0, "motorway"), (3.0, "primary")]


def flags(spark, **values):
    base = {f"poi_count_{c}": 0 for c in fixed.POI_CLASSES} | {"poi_distance_shopping_center": 900.0} | values
    return spark.createDataFrame([tuple(base.values())], list(base))


def test_local_center(spark):
    enough = {"poi_count_shopping_center": 1, "poi_count_service": 10, "poi_count_food": 6, "poi_count_home": 4, "poi_count_beauty": 1}
    row = features.segment_stations(flags(spark, **enough)).first()
    assert (row.shop_count, row.is_local_center, row.near_shops, row.distance_to_shopping_center) == (10, 1, 0, 900.0)
    for missing in enough:
        assert features.segment_stations(flags(spark, **{**enough, missing: 0})).first().is_local_center == 0


def test_near_shops(spark):
    frame = spark.sql(
        "select * from values ('a', 1, 900D), ('a', 9, 900D), ('b', 0, 499D), ('b', 0, 500D), ('c', 0, cast(null as double))"
        " as t(city, shop_count, distance_to_shopping_center)"
    )
    got = {(r.city, r.shop_count, r.distance_to_shopping_center): r.is_near_shops for r in features.near_shops(frame, "city").collect()}
    assert got == {("a", 1, 900.0): 0, ("a", 9, 900.0): 1, ("b", 0, 499.0): 1, ("b", 0, 500.0): 0, ("c", 0, None): 0}


@pytest.mark.parametrize(
    "motorway, residential, count, wanted",
    [(99.9, None, None, (1, 1, 0)), (100.0, 50.0, 1, (0, 1, 0)), (200.0, None, None, (0, 0, 0)), (None, 349.0, 1, (0, 0, 1)), (None, 349.0, 0, (0, 0, 0)), (None, 350.0, 1, (0, 0, 0))],
)
def test_road_context(spark, motorway, residential, count, wanted):
    frame = spark.createDataFrame([(motorway, residential, count)], "road_distance_motorway double, road_distance_residential double, road_count_residential bigint")
    row = features.road_context(frame).first()
    assert (row.is_motorway, row.is_highway_area, row.is_residential_area) == wanted
