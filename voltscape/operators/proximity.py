"""What lies around each station: points of interest and roads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions.joins import PART, is_small
from voltscape.operators.spatial import lines_within, one_location, points_within


def superclasses(categories: DataFrame) -> DataFrame:
    """(superclass, fclass) pairs of the category arrays, each once."""
    return categories.select("superclass", F.explode("subclass").alias("fclass")).distinct()


def classify(pois: DataFrame, categories: DataFrame) -> DataFrame:
    """POIs with their superclass; several if several match, NULL if none does."""
    classes = superclasses(categories)
    return pois.join(F.broadcast(classes) if is_small(classes) else classes, "fclass", "left")


def poi_proximity(
    stations: DataFrame,
    pois: DataFrame,
    categories: DataFrame,
    radius_m: float = fixed.SEARCH_RADIUS_M,
    names: bool = True,
) -> DataFrame:
    """Per station and superclass: number of POIs in the radius and the least distance.

    With `names`, also their different names (NULL if none has one). Stations without POIs
    keep one row with NULL superclass, count 0 and NULL distance. `stations` is read several
    times: write it first if it is costly.
    """
    columns = ["poi_id", "superclass", "lon", "lat", *(["name"] if names else [])]
    named = classify(pois.withColumnRenamed("id", "poi_id"), categories).select(*columns)
    pairs = points_within(stations, named, radius_m, together="poi_id")
    return _per_station(stations, pairs, "superclass", "poi_id", "poi_count", "poi_names" if names else None)


def road_proximity(
    stations: DataFrame, roads: DataFrame, radius_m: float = fixed.SEARCH_RADIUS_M, names: bool = True
) -> DataFrame:
    """Per station and road class: number of roads in the radius and the least distance.

    `roads` has id, class, name and `coordinates`. Stations without roads keep one row with
    NULL class, count 0 and NULL distance. `stations` is read several times: write it first if
    it is costly.
    """
    kept = ["class", *(["name"] if names else []), "coordinates"]
    lines = roads.select(F.col("id").alias("road_id"), *kept)
    pairs = lines_within(stations, lines, radius_m, together="road_id").withColumnRenamed("class", "type_road")
    return _per_station(stations, pairs, "type_road", "road_id", "roads_count", "roads_names" if names else None)


def roads_of(roads: DataFrame, country: str) -> DataFrame:
    return roads.where(F.col("country") == country)


def _per_station(
    stations: DataFrame, pairs: DataFrame, group: str, key: str, count: str, names: str | None
) -> DataFrame:
    """Aggregate per place, then give every station the rows of its place.

    Pairs are aggregated in the part they are found in, where all of a place and a `key` are, so
    not the pairs are moved but a row per place, class and part.
    """
    place, distance = ["site_lon", "site_lat", group], "closest_distance_meters"
    inner = [F.count_distinct(key).alias(count), F.min("distance_m").alias(distance)]
    outer = [F.sum(count).alias(count), F.min(distance).alias(distance)]
    if names:
        # different names in order; it is the value of one result row, and copies never enter it
        found = F.sort_array(F.array_distinct(F.flatten(F.collect_list(names))))
        inner.append(F.collect_set("name").alias(names))
        outer.append(F.when(F.size(found) > 0, found).alias(names))
    around = pairs.groupBy(PART, *place).agg(*inner).groupBy(*place).agg(*outer)
    around = around.withColumnsRenamed({"site_lon": "lon", "site_lat": "lat"})
    # one row per station on the left, one per place and class on the right
    joined = one_location(stations).join(around, ["lon", "lat"], "left")
    columns = ["id", "lon", "lat", group, *(c for c in around.columns if c not in ("lon", "lat", group))]
    return joined.select(*columns).withColumn(count, F.coalesce(count, F.lit(0)))
