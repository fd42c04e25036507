"""Usage windows, days, duplicates and the profile's nested series."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from voltscape import registry
from voltscape.functions import joins
from voltscape.functions.calendar import DayWindow, last_day_of_previous_month, local_day
from voltscape.functions.numeric import round_half_even, round_half_up, safe_divide
from voltscape.operators import rollups, series, usage
from voltscape.operators.stations import NORWAY, SWITZERLAND, StationFilter, eligible
from voltscape.plans.timeseries import station_timeseries

USAGE = "id bigint, hour timestamp, charging_duration double, size_total bigint, capacity_kw bigint"
STATION = (
    "id bigint, source string, is_approved boolean, capacity_kw bigint, country_name string, size_total bigint, "
    "operator string, title string, address string, lon double, lat double"
)


def at(text):
    return F.lit(text).cast("timestamp")


def usage_rows(spark, rows):
    frame = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in rows], "id bigint, h string, d double, s bigint")
    return frame.selectExpr(
        "id", "cast(concat(h, 'Z') as timestamp) as hour", "d as charging_duration", "s as size_total", "50L as capacity_kw"
    )


def station_rows(spark, rows):
    return spark.createDataFrame(
        [(i, "nobil", True, 50, "Norway", size, "Mer", f"t{i}", "a", 10.0, 60.0) for i, size in rows], STATION
    )


def test_last_day_of_previous_month():
    assert last_day_of_previous_month(date(2024, 3, 31)) == date(2024, 2, 29)
    assert last_day_of_previous_month(date(2025, 1, 1)) == date(2024, 12, 31)


def test_local_day_passes_midnight_and_daylight_saving(spark):
    frame = spark.range(1).select(
        local_day(at("2024-10-26T22:30:00Z"), "Europe/Oslo").alias("summer"),
        local_day(at("2024-12-26T22:30:00Z"), "Europe/Oslo").alias("winter"),
        local_day(at("2024-10-26T22:30:00Z")).alias("utc"),
    )
    assert tuple(frame.first()) == (date(2024, 10, 27), date(2024, 12, 26), date(2024, 10, 26))


def test_window_includes_both_ends_in_its_zone(spark):
    rows = usage_rows(
        spark,
        [(1, "2024-01-01T00:00:00", 1.0, 1), (1, "2024-01-31T23:00:00", 2.0, 1), (1, "2024-02-01T00:00:00", 4.0, 1),
         (1, "2023-12-31T23:00:00", 8.0, 1)],
    )
    utc = usage.in_window(rows, DayWindow(date(2024, 1, 1), date(2024, 1, 31)))
    assert utc.agg(F.sum("charging_duration")).first()[0] == 3.0
    oslo = usage.in_window(rows, DayWindow(date(2024, 1, 1), date(2024, 1, 31), "Europe/Oslo"))
    # 23:00 UTC is midnight in Oslo
    assert oslo.agg(F.sum("charging_duration")).first()[0] == 9.0


def test_window_reaches_the_scan(spark, tmp_path):
    usage_rows(spark, [(1, "2024-01-01T00:00:00", 1.0, 1)]).write.parquet(str(tmp_path / "u"))
    rows = spark.read.parquet(str(tmp_path / "u"))
    stations = station_rows(spark, [(1, 2)])
    for zone in ("UTC", "Europe/Oslo"):
        window = DayWindow(date(2024, 1, 1), date(2024, 1, 31), zone)
        plan = plan_of(usage.daily_utilization(rows, stations, window))
        scan = next(line for line in plan.splitlines() if "parquet" in line and "charging_duration" in line)
        assert "GreaterThanOrEqual(hour" in scan and "LessThan(hour" in scan
        assert "capacity_kw" not in scan


@pytest.mark.parametrize(
    "name", ["usage_window", "usage_window_local", "hourly_detail", "daily_utilization", "station_timeseries", "station_span"]
)
def test_registered_windows_reach_the_scan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(registry.run(name, spark, "/root/testdata/sf0.001"))
    scans = [line for line in plan.splitlines() if "parquet" in line and ("orders" in line or "events" in line)]
    assert scans and all("GreaterThanOrEqual(" in line and "LessThan(" in line for line in scans)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rounding_and_division(spark):
    row = spark.range(1).select(
        round_half_up(F.lit(1.005)).alias("up"),
        round_half_up(F.lit(0.1 + 0.2 - 0.295)).alias("noise"),
        round_half_even(F.lit(0.125)).alias("even"),
        safe_divide(F.lit(1), F.lit(0)).alias("zero"),
        safe_divide(F.lit(1), F.lit(None)).alias("null"),
    ).first()
    assert tuple(row) == (1.01, 0.01, 0.12, None, None)


def test_filters(spark):
    rows = [
        (1, "nobil", True, 50, "Norway"), (2, "nobil", True, 49, "Norway"), (3, "nobil", False, 99, "Norway"),
        (4, "sw", True, 100, "Switzerland"), (5, "sw", True, 101, "Switzerland"), (6, None, True, 200, "Norway"),
    ]
    frame = spark.createDataFrame(rows, "id bigint, source string, is_approved boolean, capacity_kw bigint, country_name string")
    ids = lambda rule: sorted(r.id for r in eligible(frame, rule).collect())
    assert ids(NORWAY) == [1]
    assert ids(SWITZERLAND) == [5]
    assert ids(StationFilter(approved_only=False)) == [1, 2, 3, 4, 5, 6]


def test_summary_counts_idle_days_and_divides_by_size(spark):
    rows = usage_rows(spark, [(1, "2024-01-01T05:00:00", 144.0, 2), (1, "2024-01-01T06:00:00", 144.0, 2), (1, "2024-01-04T06:00:00", 288.0, 2)])
    window = DayWindow(date(2024, 1, 1), date(2024, 1, 31))
    row = usage.utilization_summary(rows, station_rows(spark, [(1, 4)]), window).first()
    assert (row.calendar_day_count, row.active_days_count, row.size_total) == (4, 2, 2)
    assert row.percentage_average == pytest.approx(5.0) and row.average_daily_minutes == pytest.approx(72.0)


@pytest.mark.parametrize("few", [True, False])
def test_repeated_station_repeats_usage(spark, monkeypatch, few):
    """A station listed twice counts its usage twice, broadcast or not."""
    monkeypatch.setattr(usage, "is_small", lambda df, n=0: few)
    monkeypatch.setattr(joins, "is_small", lambda df, n=0: few)
    rows = usage_rows(spark, [(1, "2024-01-01T05:00:00", 72.0, 1), (2, "2024-01-01T05:00:00", 72.0, 1)])
    stations = station_rows(spark, [(1, 1), (1, 1), (2, 1)])
    window = DayWindow(date(2024, 1, 1), date(2024, 1, 31))
    summary = usage.utilization_summary(rows, stations, window).collect()
    assert sorted((r.id, r.percentage_average) for r in summary) == [(1, 10.0), (1, 10.0), (2, 5.0)]
    daily = usage.daily_utilization_local(rows, stations, window).collect()
    # both joins of the local table repeat, so two copies make four
    assert sorted((r.id, r.minutes_charged_day) for r in daily) == [(1, 288.0), (2, 72.0)]
    assert usage.usage_of(rows, stations, window).count() == 3
    assert usage.hourly_detail(rows, stations, window).count() == 3


def test_active_days_is_a_strict_limit(spark):
    rows = usage_rows(spark, [(i, f"2024-01-0{d}T05:00:00", 1.0, 1) for i, n in ((1, 2), (2, 3)) for d in range(1, n + 1)])
    window = DayWindow(date(2024, 1, 1), date(2024, 1, 31))
    kept = usage.active_stations(rows, station_rows(spark, [(1, 1), (2, 1)]), window, 2)
    assert [r.id for r in kept.collect()] == [2]


def test_profile_series_are_ordered_and_complete(spark):
    days = ["2023-11-15", "2023-12-15", "2024-01-15", "2024-07-15", "2024-07-16"]
    rows = usage_rows(spark, [(1, f"{d}T05:00:00", 144.0 * (k + 1), 1) for k, d in enumerate(days)] + [(2, "2024-02-01T05:00:00", 5.0, 1)])
    window = DayWindow(date(2023, 1, 1), date(2024, 12, 31), "Europe/Oslo")
    found = {r.id: r for r in station_timeseries(rows, station_rows(spark, [(1, 1), (2, 0)]), window).collect()}
    one = found[1]
    assert [m.month_start for m in one.monthly_perf] == [date(2023, 11, 1), date(2023, 12, 1), date(2024, 1, 1), date(2024, 7, 1)]
    assert one.active_months == ["Nov", "Dec", "Jan", "Jul"]
    assert one.peak_month == "Jul" and one.peak_season == "Summer"
    assert [s.season for s in one.season_perf] == ["Winter", "Summer", "Fall"]
    assert [w.week_start for w in one.weekly_perf] == [date(2023, 11, 13), date(2023, 12, 11), date(2024, 1, 15), date(2024, 7, 15)]
    assert one.weekly_perf[-1].total_minutes_week == 144.0 * 9
    assert (one.calendar_day_count, one.active_days_count, one.diff_day) == (245, 5, 240)
    two = found[2]
    # size 0: utilization 0, activity unknown, no active month
    assert two.monthly_perf[0].avg_utilization_pct == 0.0 and two.monthly_perf[0].active_flag is None
    assert two.active_months is None and two.percentage_average is None and two.peak_month == "Feb"


def test_peaks_break_ties(spark):
    months = spark.createDataFrame([(1, 5, 1.0), (1, 3, 1.0), (1, 9, 0.5)], "id bigint, month_num int, month_avg_utilization_pct double")
    assert series.peak_month(months).first().peak_month == "Mar"
    seasons = spark.createDataFrame(
        [(1, "Winter", 0.1, 2.0), (1, "Fall", 0.1, 2.0), (1, "Spring", 0.1, 1.0)],
        "id bigint, season string, season_share_avg double, season_avg_utilization_pct double",
    )
    assert series.season_series(seasons).first().peak_season == "Fall"


def test_monthly_minutes_add_up_to_daily_minutes(spark):
    rows = usage_rows(spark, [(i % 3, f"2024-0{1 + i % 9}-1{i % 7}T0{i % 10}:00:00", float(i), 1 + i % 3) for i in range(200)])
    daily = usage.daily_utilization_local(rows, station_rows(spark, [(0, 1), (1, 2), (2, 3)]), DayWindow(date(2024, 1, 1), date(2024, 12, 31), "Europe/Oslo"))
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert total(rollups.monthly_utilization(daily), "minutes_in_month") == pytest.approx(total(daily, "minutes_charged_day"))
    shares = rollups.month_shares(rollups.monthly_utilization(daily)).groupBy("id", "yr").agg(F.sum("month_share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in shares)


def test_profile_scans_the_fact_once(spark, tmp_path):
    usage_rows(spark, [(1, "2024-01-01T00:00:00", 1.0, 1)]).write.parquet(str(tmp_path / "fact"))
    rows = spark.read.parquet(str(tmp_path / "fact"))
    profile = station_timeseries(rows, station_rows(spark, [(1, 2)]), DayWindow(date(2024, 1, 1), date(2024, 1, 31), "Europe/Oslo"))
    profile.collect()
    final = plan_of(profile).split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1
    assert "Python" not in final


def test_hour_zone_of_detail(spark):
    rows = usage_rows(spark, [(1, "2024-01-31T23:00:00", 1.0, 1)])
    row = usage.hourly_detail(rows, station_rows(spark, [(1, 2)]), DayWindow(date(2024, 1, 1), date(2024, 1, 31))).first()
    assert (row.day, row.month, row.hour_of_day, row.size_total) == (date(2024, 1, 31), "2024-01", 23, 2)
    assert isinstance(row.hour, datetime)
