"""Static station description and the joined per-station tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def station_static(spans: DataFrame, stations: DataFrame, all_stations: DataFrame) -> DataFrame:
    """Description of every station that has a span, and the span's length.

    Address, title and country come from the unfiltered station table; rows that agree on
    them collapse before the join.
    """
    own = stations.groupBy("id", "capacity_kw").agg(
        F.max("operator").alias("operator"), F.max(F.struct("lon", "lat")).alias("_place")
    )
    described = all_stations.select("id", "address", "title", "country_name").distinct()
    days = spans.select("id", "calendar_day_count").distinct()
    return own.join(days, "id").join(described, "id").select(
        "id",
        "operator",
        "capacity_kw",
        "address",
        "title",
        "country_name",
        "calendar_day_count",
        F.col("_place.lon").alias("lon"),
        F.col("_place.lat").alias("lat"),
    )


def static_with_usage(summary: DataFrame, static: DataFrame) -> DataFrame:
    """Usage summary with the station's description; the span length is in both, so kept once."""
    return summary.join(static.drop("calendar_day_count"), "id", "left")
