"""The scored wide table, from usage, stations, surroundings and population."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from voltscape.functions.calendar import DayWindow
from voltscape.functions.numeric import round_half_even
from voltscape.functions.staging import stage
from voltscape.operators import cleaning, features, pivots, scoring
from voltscape.operators.proximity import poi_proximity, road_proximity
from voltscape.operators.spatial import nearest
from voltscape.operators.usage import utilization_summary
from voltscape.plans.station_profile import static_with_usage, station_static


@dataclass(frozen=True)
class Surroundings:
    pois: DataFrame
    categories: DataFrame
    roads: DataFrame
    population: DataFrame


def station_base(
    usage: DataFrame, stations: DataFrame, all_stations: DataFrame, window: DayWindow
) -> DataFrame:
    """Usage summary and description per station; the summary's spans serve both, so the
    fact is scanned once."""
    summary = stage(utilization_summary(usage, stations, window), "summary")
    return static_with_usage(summary, station_static(summary, stations, all_stations))


def station_with_poi(base: DataFrame, poi_counts: DataFrame, classes: list[str] | None = None) -> DataFrame:
    found = pivots.poi_features(poi_counts, base, classes)
    return base.join(found, "id", "left")


def station_with_road(base: DataFrame, road_counts: DataFrame, classes: list[str] | None = None) -> DataFrame:
    return base.join(pivots.road_features(road_counts, classes), "id", "left")


def with_population(df: DataFrame, population: DataFrame) -> DataFrame:
    """`population` of the nearest population point."""
    found = nearest(df, population, "pop_key", "population").select("lon", "lat", "population")
    return df.join(found, ["lon", "lat"], "left").select(*df.columns, "population")


def merged_features(
    usage: DataFrame,
    stations: DataFrame,
    all_stations: DataFrame,
    window: DayWindow,
    around: Surroundings,
) -> DataFrame:
    """Cleaned POI and road tables, merged.

    The station base and the two proximity tables each feed several steps, so they are
    written once.
    """
    base = stage(station_base(usage, stations, all_stations, window), "base")
    near = base.select("id", "lon", "lat")
    poi_counts = stage(poi_proximity(near, around.pois, around.categories, names=False), "poi")
    road_counts = stage(road_proximity(near, around.roads, names=False), "road")
    segmented = cleaning.with_pois(station_with_poi(base, poi_counts))
    roads = cleaning.with_roads(station_with_road(base, road_counts))
    return cleaning.merge_features(roads, segmented)


def scored(df: DataFrame) -> DataFrame:
    """Score, performance rank and bin rank."""
    scored_rows = scoring.feature_score(df, scoring.feature_thresholds(df))
    return scoring.occupation_rank(scoring.performance_rank(scored_rows))


def derived(df: DataFrame) -> DataFrame:
    """Group sums, presence and nearest major road; rounding comes last."""
    full = features.nearest_major_road(features.poi_presence(features.poi_groups(cleaning.fill_counts(df))))
    rounded = [
        *cleaning.columns_ending(full, "_dist", "_count"), "total_time_spent", "population", "good_feature_score"
    ]
    return cleaning.rounded(full, rounded, round_half_even)


def final_features(
    usage: DataFrame,
    stations: DataFrame,
    all_stations: DataFrame,
    window: DayWindow,
    around: Surroundings,
) -> DataFrame:
    """The whole chain, one row per id. Bins come before incomplete rows go, and a station listed
    under several addresses becomes one row before anything is ranked or scored; scores come
    before the group sums."""
    merged = stage(merged_features(usage, stations, all_stations, window, around), "merged")
    complete = cleaning.complete_rows(scoring.occupation_bins(merged))
    single = cleaning.one_row_per_id(with_population(complete, around.population))
    enriched = stage(features.time_spent(single), "enriched")
    return derived(scored(enriched)).withColumnRenamed("lon", "lng")
