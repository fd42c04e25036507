"""The station time-series profile."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltscape.functions.calendar import DayWindow
from voltscape.operators import rollups, series
from voltscape.operators.usage import daily_utilization_local


def station_timeseries(usage: DataFrame, stations: DataFrame, window: DayWindow) -> DataFrame:
    """Per station: local summary, monthly, seasonal and weekly series, peak month and season.

    One shuffle places the daily table by station; all roll-ups and the joins below read
    that placement, and the fact is scanned once.
    """
    daily = daily_utilization_local(usage, stations, window)
    monthly = rollups.monthly_utilization(daily)
    months = series.monthly_series(monthly)
    peaks = series.peak_month(rollups.month_of_year_utilization(monthly))
    seasons = series.season_series(rollups.season_totals(monthly))
    weeks = series.weekly_series(rollups.weekly_utilization(daily))
    return (
        rollups.local_summary(daily)
        .join(months, "id", "left")
        .join(peaks.drop("month_util"), "id", "left")
        .join(seasons, "id", "left")
        .join(weeks, "id", "left")
    )
