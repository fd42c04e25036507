"""From the hourly fact to stations and days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltscape.functions.calendar import DayWindow, local_day
from voltscape.functions.joins import is_small, lookup_join
from voltscape.functions.numeric import round_half_up, safe_divide


def in_window(usage: DataFrame, window: DayWindow) -> DataFrame:
    """Usage rows of the window, with their `day`."""
    return usage.where(window.contains(F.col("hour"))).withColumn("day", local_day(F.col("hour"), window.zone))


def usage_of(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """Usage rows of `stations` in the window, with their `day`; no other columns of theirs.

    A station that occurs twice repeats its usage rows, as the inner join does.
    """
    return lookup_join(in_window(usage, window), stations.select("id"), ["id"])


def _per_station(
    usage: DataFrame, stations: DataFrame, attached: DataFrame, window: DayWindow, keys: list[str], *measures: Column
) -> DataFrame:
    """Aggregate usage by `keys` and join the few columns of `attached`, made from `stations`.

    Aggregating first means a hot station is a few rows per task before it is shuffled and
    at most one row per day when it is joined. If the stations are few, the usage rows of
    all other stations are dropped at the scan.
    """
    rows = in_window(usage, window)
    if is_small(stations.select("id")):
        attached = F.broadcast(attached)
        rows = rows.join(F.broadcast(stations.select("id")), "id", "left_semi")
    return rows.groupBy(*keys).agg(*measures).join(attached, "id")


def copies_per_id(stations: DataFrame) -> DataFrame:
    """How often the inner join repeats each station's usage."""
    return stations.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))


def station_span(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """First and last day with usage, and the calendar days from one to the other."""
    first, last = F.min("day").alias("start_day"), F.max("day").alias("end_day")
    spans = _per_station(usage, stations, copies_per_id(stations), window, ["id"], first, last)
    return spans.select("id", "start_day", "end_day", calendar_days().alias("calendar_day_count"))


def calendar_days() -> Column:
    return (F.datediff("end_day", "start_day") + 1).cast("bigint")


def stations_with_usage(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """Stations that have at least one usage row in the window."""
    seen = in_window(usage, window).select("id").distinct()
    return stations.join(seen, "id", "left_semi").select(*stations.columns)


def active_stations(
    usage: DataFrame, stations: DataFrame, window: DayWindow, more_than_days: int
) -> DataFrame:
    """Stations with usage on more than `more_than_days` different days."""
    days = _per_station(
        usage, stations, copies_per_id(stations), window, ["id"], F.count_distinct("day").alias("active_days_count")
    )
    kept = days.where(F.col("active_days_count") > more_than_days).select("id")
    return stations.join(kept, "id", "left_semi").select("id", "capacity_kw", "size_total", "lon", "lat")


def daily_utilization(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """Per station and day: share of the day in use and minutes per outlet.

    The size is the one recorded with the usage, and nothing is rounded.
    """
    daily = _per_station(
        usage,
        stations,
        copies_per_id(stations),
        window,
        ["id", "day"],
        F.sum("charging_duration").alias("minutes"),
        F.max("size_total").alias("size_total"),
    )
    minutes = F.col("minutes") * F.col("copies")
    return daily.select(
        "id",
        "day",
        "size_total",
        (safe_divide(minutes, F.col("size_total") * 24 * 60) * 100).alias("daily_utilization"),
        safe_divide(minutes, F.col("size_total")).alias("daily_avg_minutes"),
    )


def utilization_summary(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """Per station: span, active days and averages over the calendar days of the span.

    Days without usage count as zero.
    """
    totals = (
        daily_utilization(usage, stations, window)
        .groupBy("id")
        .agg(
            F.min("day").alias("start_day"),
            F.max("day").alias("end_day"),
            F.sum("daily_utilization").alias("_percent"),
            F.sum("daily_avg_minutes").alias("_minutes"),
            F.count(F.lit(1)).alias("active_days_count"),
            F.max("size_total").alias("size_total"),
        )
        .withColumn("calendar_day_count", calendar_days())
    )
    return stations.select("id").join(totals, "id").select(
        "id",
        "size_total",
        "start_day",
        "end_day",
        "calendar_day_count",
        "active_days_count",
        safe_divide(F.col("_percent"), F.col("calendar_day_count")).alias("percentage_average"),
        safe_divide(F.col("_minutes"), F.col("calendar_day_count")).alias("average_daily_minutes"),
    )


def daily_utilization_local(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """Per station, local day and station-side size: minutes and the two rounded measures.

    The result is placed by station id, so every roll-up by station and period, and every
    join of those roll-ups by station, runs without moving rows again.
    """
    same_id = Window.partitionBy("id")
    sizes = (
        stations.groupBy("id", "size_total")
        .agg(F.count(F.lit(1)).alias("_same"))
        .withColumn("copies", F.col("_same") * F.sum("_same").over(same_id))
        .drop("_same")
    )
    minutes = F.sum("charging_duration").alias("minutes")
    daily = (
        _per_station(usage, stations, sizes, window, ["id", "day"], minutes)
        .select("id", "day", "size_total", (F.col("minutes") * F.col("copies")).alias("minutes_charged_day"))
        .repartition("id")
    )
    per_outlet = F.col("minutes_charged_day")
    return daily.select(
        "*",
        round_half_up(safe_divide(per_outlet, F.col("size_total") * 24 * 60) * 100).alias("daily_utilization_pct"),
        round_half_up(safe_divide(per_outlet, F.col("size_total"))).alias("daily_avg_minutes"),
    )


def hourly_detail(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """Usage rows with the station's description and calendar columns."""
    described = stations.select("id", "operator", "lon", "lat", "title", "size_total")
    rows = in_window(usage, window).select("id", "hour", "charging_duration", "capacity_kw", "day")
    return lookup_join(rows, described, ["id"]).select(
        "id",
        "hour",
        "charging_duration",
        "capacity_kw",
        "operator",
        "lon",
        "lat",
        "title",
        "day",
        F.date_format("day", "yyyy-MM").alias("month"),
        F.hour("hour").alias("hour_of_day"),
        "size_total",
    )
