"""Columns derived from one row of the wide table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions.geo import with_point
from voltscape.functions.joins import lookup_join
from voltscape.functions.numeric import flag, row_sum
from voltscape.operators.cleaning import ensure_columns


def time_spent(df: DataFrame) -> DataFrame:
    """`total_time_spent`: minutes per visit, summed over the classes that are near."""
    minutes = [
        F.when(F.col(column) > 0, F.lit(float(spent))).otherwise(0.0)
        for column, spent in fixed.MINUTES_PER_VISIT.items()
        if column in df.columns
    ]
    return df.withColumn("total_time_spent", row_sum(minutes).cast("double"))


def coordinates(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """`lng` and `lat` of point text; NULL if the text is no point."""
    return with_point(df, geometry, "lng", "lat")


def poi_groups(df: DataFrame) -> DataFrame:
    """The six group sums; absent classes count 0."""
    needed = [f"{name}_count" for members in fixed.POI_GROUPS.values() for name in members]
    full = ensure_columns(df, list(dict.fromkeys(needed)))
    sums = {
        group: reduce(Column.__add__, (F.col(f"{name}_count") for name in members))
        for group, members in fixed.POI_GROUPS.items()
    }
    return full.withColumns(sums)


def poi_presence(df: DataFrame) -> DataFrame:
    """How many of the groups are present, as a number and as text."""
    groups = list(fixed.POI_GROUPS)
    full = ensure_columns(df, groups)
    present = row_sum([flag(F.col(group) > 0) for group in groups]).cast("int")
    text = F.concat(F.col("poi_categories_present").cast("string"), F.lit(f"/{len(groups)}"))
    return full.withColumn("poi_categories_present", present).withColumn("poi_categories_present_str", text)


def nearest_major_road(df: DataFrame) -> DataFrame:
    """Least distance to a major road and its class; the first listed wins ties."""
    columns = [f"{name}_dist" for name in fixed.MAJOR_ROADS]
    full = ensure_columns(df, columns)
    least = F.least(*columns)
    kind = F.coalesce(*(F.when(F.col(c) == least, c.removesuffix("_dist")) for c in columns))
    return full.withColumns({"nearest_major_road_dist": least, "nearest_major_road_type": kind})


# ---------------------------------------------------------------- station context


def shop_count(df: DataFrame) -> DataFrame:
    """`shop_count` over the shop classes, and the distance to a shopping center."""
    shops = row_sum([F.col(f"poi_count_{name}") for name in fixed.SHOP_CLASSES])
    return df.withColumns(
        {"shop_count": shops, "distance_to_shopping_center": F.col("poi_distance_shopping_center")}
    )


def local_center(
    df: DataFrame, least_services: int = 10, least_shops: int = 10, least_classes: int = 5
) -> DataFrame:
    """`is_local_center`: a shopping center, enough services and shops, and enough classes."""

    def count(name: str) -> Column:
        column = f"poi_count_{name}"
        return F.coalesce(F.col(column), F.lit(0)) if column in df.columns else F.lit(0)

    classes = row_sum([flag(count(name) > 0) for name in fixed.POI_CLASSES])
    center = (
        (count("shopping_center") != 0)
        & (count("service") >= least_services)
        & (F.col("shop_count") >= least_shops)
        & (classes >= least_classes)
    )
    return df.withColumn("is_local_center", flag(center))


def segment_stations(df: DataFrame) -> DataFrame:
    """Shop count and local-center flag; `near_shops` is always 0 here."""
    return local_center(shop_count(df)).withColumn("near_shops", F.lit(0))


def near_shops(
    stations: DataFrame, city: str, least_share: float = 0.2, center_within_m: float = 500.0
) -> DataFrame:
    """`is_near_shops`: a large enough share of the city's shops, or a center close by.

    The share is 0 where the city has none.
    """
    totals = stations.groupBy(city).agg(F.sum("shop_count").alias("_city_shops"))
    share = F.when(F.col("_city_shops") > 0, F.try_divide(F.col("shop_count"), F.col("_city_shops"))).otherwise(0.0)
    near = (share > least_share) | (F.col("distance_to_shopping_center") < center_within_m)
    # a city with very many stations is spread over tasks
    known = lookup_join(stations.where(F.col(city).isNotNull()), totals.where(F.col(city).isNotNull()), [city])
    unknown = stations.where(F.col(city).isNull()).withColumn("_city_shops", F.lit(None).cast("bigint"))
    joined = known.unionByName(unknown)
    return joined.withColumn("is_near_shops", flag(near)).drop("_city_shops")


def road_context(df: DataFrame) -> DataFrame:
    """Motorway, highway-area and residential flags. Distance 0 means no such road."""
    measured = ["motorway", "primary", "secondary", "residential"]
    columns = [f"road_{measure}_{name}" for name in measured for measure in ("distance", "count")]
    full = ensure_columns(df, columns).fillna(0, subset=columns)

    def distance(name: str) -> Column:
        return F.col(f"road_distance_{name}")

    def within(name: str, metres: float) -> Column:
        return (distance(name) > 0) & (distance(name) < metres)

    def absent(name: str) -> Column:
        return (distance(name) == 0) & (F.col(f"road_count_{name}") == 0)

    through = ["motorway", "primary", "secondary"]
    highway = reduce(Column.__or__, (within(name, 200) for name in through))
    quiet = reduce(Column.__and__, (absent(name) for name in through))
    residential = within("residential", 350) & (F.col("road_count_residential") >= 1) & quiet
    return full.withColumns(
        {
            "is_motorway": flag(within("motorway", 100)),
            "is_highway_area": flag(highway),
            "is_residential_area": flag(residential),
        }
    )
