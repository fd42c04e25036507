"""Every operator as a query over one folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltscape import fixed_values as fixed
from voltscape.functions import geography
from voltscape.functions.calendar import DayWindow
from voltscape.functions.staging import fresh_path, stage
from voltscape.operators import cleaning, features, pivots, quality, rings, rollups, scoring, series, split, usage
from voltscape.operators import stations as st
from voltscape.operators.proximity import poi_proximity, road_proximity, roads_of
from voltscape.operators.shapes import nearest_shape, shapes_within
from voltscape.operators.spatial import lines_within, nearest, points_within
from voltscape.plans import feature_table, station_profile
from voltscape.plans.timeseries import station_timeseries
from voltscape.session import pin
from voltscape.sources import layouts, tables
from voltscape.sources.derived import Inputs

# The order table runs from 1995 to August 2001, the events cover January 2024.
LONG_AS_OF = date(2001, 9, 15)
LONG = DayWindow.until_last_month(date(1995, 1, 1), LONG_AS_OF)
LONG_LOCAL = DayWindow.until_last_month(date(1995, 1, 1), LONG_AS_OF, fixed.LOCAL_ZONE)
LATE = DayWindow.until_last_month(date(1998, 3, 1), LONG_AS_OF)
SHORT_AS_OF = date(2024, 2, 15)
SHORT = DayWindow.until_last_month(date(2024, 1, 1), SHORT_AS_OF)
SHORT_LOCAL = DayWindow.until_last_month(date(2024, 1, 1), SHORT_AS_OF, fixed.LOCAL_ZONE)
# Stations that were in use of late have a road table of their own.
RECENT = DayWindow.until_last_month(date(2001, 1, 1), LONG_AS_OF)
HOURLY = DayWindow(date(2024, 1, 5), date(2024, 1, 25))
# Days of the short month that count as active.
ACTIVE_DAYS = 15
DAILY_BUCKETS = 8
SEED = 42


# through decimals, so that the last bits of a sum of doubles decide no tie
SIX = "cast(round(cast({} as decimal(38,10)), 6) as double)"


def report(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and doubles to six digits, so results compare exactly."""

    whole = (T.IntegerType, T.ShortType, T.ByteType)

    def plain(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, whole):
            return f"cast({name} as bigint) as {name}"
        if isinstance(field.dataType, T.DoubleType):
            return f"{SIX.format(name)} as {name}"
        return name

    return df.selectExpr(*map(plain, df.schema.fields))


def norway(i: Inputs) -> DataFrame:
    return st.eligible(i.stations, st.NORWAY)


# ---------------------------------------------------------------- sources and filters


def station_scan(i: Inputs) -> DataFrame:
    return tables.query(
        i.spark,
        "select id, capacity_kw, size_total, operator, lon, lat from {stations} "
        "where source = :source and capacity_kw >= :capacity",
        {"source": fixed.SOURCE_NORWAY, "capacity": fixed.MIN_CAPACITY_NORWAY_KW, "boundary": None},
        stations=i.stations,
    )


def population_scan(i: Inputs) -> DataFrame:
    return tables.population_points(i.population, fixed.POPULATION_NEWER_THAN)


def road_scan(i: Inputs) -> DataFrame:
    rows = roads_of(i.roads, fixed.ROAD_COUNTRY_SWITZERLAND)
    return rows.select("id", "class", "name", F.posexplode("coordinates").alias("position", "p")).select(
        "id", "class", "name", "position", "p.lon", "p.lat"
    )


def wkt_points(i: Inputs) -> DataFrame:
    text = F.format_string("POINT (%.6f %.6f)", "lon", "lat")
    return features.coordinates(i.pois.select("id", text.alias("geometry"))).drop("geometry")


def wkt_lines(i: Inputs) -> DataFrame:
    vertices = F.transform("coordinates", lambda c: F.format_string("%.6f %.6f", c["lon"], c["lat"]))
    text = F.concat(F.lit("LINESTRING ("), F.array_join(vertices, ", "), F.lit(")"))
    lines = tables.read_lines(i.roads.select("id", text.alias("geometry")), "geometry")
    return lines.select("id", F.posexplode("coordinates").alias("position", "p")).select(
        "id", "position", "p.lon", "p.lat"
    )


def wkt_shapes(i: Inputs) -> DataFrame:
    """Every vertex of every shape; text that is no geometry has one row without any."""
    parts = i.shapes.select("id", "kind", F.posexplode_outer("parts").alias("part", "_part"))
    lists = parts.select("id", "kind", "part", F.posexplode_outer("_part").alias("ring", "_ring"))
    return lists.select("id", "kind", "part", "ring", F.posexplode_outer("_ring").alias("position", "p")).select(
        "id", "kind", "part", "ring", "position", "p.lon", "p.lat"
    )


def csv_roundtrip(i: Inputs) -> DataFrame:
    monthly = rollups.monthly_utilization(usage.daily_utilization_local(i.usage_long(LONG_LOCAL), norway(i), LONG_LOCAL))
    frame = series.monthly_series(monthly)
    path = fresh_path(i.spark, "csv")
    tables.write_csv(frame, path)
    perf = frame.schema["monthly_perf"].dataType
    months = frame.schema["active_months"].dataType
    read = tables.read_csv(i.spark, path, "id bigint, monthly_perf string, active_months string")
    return read.select(
        "id",
        F.array_join(F.from_json("active_months", months), ",").alias("active_months"),
        F.explode(F.from_json("monthly_perf", perf)).alias("p"),
    ).select("id", "active_months", "p.month_start", "p.avg_utilization_pct", "p.active_flag")


def csv_quarantine(i: Inputs) -> DataFrame:
    """Records that fit, and those put aside as text."""
    rows, bad = tables.read_csv_checked(
        i.spark, i.csv_lines(), "id bigint, balance double, day date, note string", header=False, multi_line=True, required=["id"]
    )
    return rows.withColumn("record", F.lit(None).cast("string")).unionByName(bad.select("record"), allowMissingColumns=True)


def table_name(i: Inputs, name: str) -> str:
    """A catalog name of this application's own."""
    return f"{name}_{i.spark.sparkContext.applicationId.replace('-', '_')}"


def road_tables(i: Inputs) -> DataFrame:
    """The chain of road tables, each replaced from the one before: raw text rows, rows of one
    country with lines (which replace the raw table they read), and what lies near the stations."""
    raw, near = table_name(i, "roads"), table_name(i, "roads_near")
    for _ in range(2):
        tables.replace_table(i.road_texts, raw)
        swiss = roads_of(i.spark.table(raw), fixed.ROAD_COUNTRY_SWITZERLAND)
        tables.replace_table(tables.read_lines(swiss, "geometry").drop("geometry"), raw)
        rule = st.SWITZERLAND_UNAPPROVED
        active = usage.active_stations(i.usage_short(SHORT), st.eligible(i.stations, rule), SHORT, ACTIVE_DAYS)
        tables.replace_table(road_proximity(stage(active, "active"), i.spark.table(raw), names=False), near)
    return metres(i.spark.table(near))


def station_in_boundary(i: Inputs) -> DataFrame:
    return st.within_boundary(i.stations, i.boundary).select("id", "lon", "lat")


def station_filter_region(i: Inputs) -> DataFrame:
    return st.eligible(i.stations, st.NORWAY, i.boundary).select("id", "capacity_kw", "operator")


def station_filter_sql(i: Inputs) -> DataFrame:
    """The filter by region as SQL text, with the boundary as a parameter."""
    geography.register(i.spark)
    return tables.query(
        i.spark,
        "select id, capacity_kw, operator from {stations} where source = :source and is_approved and capacity_kw >= :capacity "
        "and country_name = :country and st_within(st_geogpoint(lon, lat), st_geogfromgeojson(:boundary))",
        {
            "source": fixed.SOURCE_NORWAY,
            "capacity": fixed.MIN_CAPACITY_NORWAY_KW,
            "country": fixed.COUNTRY_NORWAY,
            "boundary": i.boundary_text,
        },
        stations=i.stations,
    )


def station_filter_country(i: Inputs) -> DataFrame:
    return norway(i).select("id", "capacity_kw", "operator")


def station_filter_source(i: Inputs) -> DataFrame:
    approved = st.eligible(i.stations, st.SWITZERLAND).select("id")
    return st.eligible(i.stations, st.SWITZERLAND_UNAPPROVED).join(
        approved.withColumn("approved", F.lit(True)), "id", "left"
    ).select("id", "capacity_kw", F.coalesce("approved", F.lit(False)).alias("approved"))


def operator_match(i: Inputs) -> DataFrame:
    return split.operator_matches(i.stations).select("id", "operator")


# ---------------------------------------------------------------- usage


def usage_window(i: Inputs) -> DataFrame:
    return usage.usage_of(i.usage_long(LATE), norway(i), LATE).select("id", "day", "charging_duration")


def usage_partitioned(i: Inputs) -> DataFrame:
    """The same from the fact stored by month and station group."""
    path = fresh_path(i.spark, "usage")
    layouts.write_usage(i.usage_long(LONG), path)
    rows = layouts.read_usage(i.spark, path, LATE, norway(i))
    return usage.usage_of(rows, norway(i), LATE).select("id", "day", "charging_duration")


def bucketed_summary(i: Inputs) -> DataFrame:
    """A profile of two tables saved by station: days and mean use, joined where they lie."""
    daily = layouts.save_bucketed(
        usage.daily_utilization(i.usage_short(SHORT), norway(i), SHORT), table_name(i, "daily"), "id", DAILY_BUCKETS
    )
    known = layouts.save_bucketed(norway(i).select("id", "operator", "title"), table_name(i, "known"), "id", DAILY_BUCKETS)
    days = daily.groupBy("id").agg(F.count(F.lit(1)).alias("days"), F.avg("daily_utilization").alias("mean_utilization"))
    return known.join(days, "id").select("id", "operator", "title", "days", "mean_utilization")


def usage_window_local(i: Inputs) -> DataFrame:
    return usage.usage_of(i.usage_short(SHORT_LOCAL), norway(i), SHORT_LOCAL).select("id", "hour", "day", "charging_duration")


def hourly_detail(i: Inputs) -> DataFrame:
    return usage.hourly_detail(i.usage_short(HOURLY), norway(i), HOURLY).orderBy("id", "hour")


def station_span(i: Inputs) -> DataFrame:
    return usage.station_span(i.usage_long(LONG), norway(i), LONG)


def active_stations(i: Inputs) -> DataFrame:
    rule = st.SWITZERLAND_UNAPPROVED
    return usage.active_stations(i.usage_short(SHORT), st.eligible(i.stations, rule), SHORT, ACTIVE_DAYS)


def daily_utilization(i: Inputs) -> DataFrame:
    return usage.daily_utilization(i.usage_short(SHORT), norway(i), SHORT)


def summary_of(i: Inputs) -> DataFrame:
    return usage.utilization_summary(i.usage_long(LONG), norway(i), LONG)


def utilization_summary(i: Inputs) -> DataFrame:
    return summary_of(i).orderBy(F.desc("percentage_average"))


def daily_of(i: Inputs) -> DataFrame:
    return usage.daily_utilization_local(i.usage_long(LONG_LOCAL), norway(i), LONG_LOCAL)


def daily_utilization_local(i: Inputs) -> DataFrame:
    return usage.daily_utilization_local(i.usage_short(SHORT_LOCAL), norway(i), SHORT_LOCAL)


def monthly_of(i: Inputs) -> DataFrame:
    return rollups.monthly_utilization(daily_of(i))


def weekly_utilization(i: Inputs) -> DataFrame:
    return rollups.weekly_utilization(daily_of(i))


def month_of_year(i: Inputs) -> DataFrame:
    return rollups.month_of_year_utilization(monthly_of(i))


def month_share(i: Inputs) -> DataFrame:
    return rollups.month_shares(monthly_of(i)).select("id", "month_start", "yr", "month_of_year", "month_share")


def month_share_average(i: Inputs) -> DataFrame:
    return rollups.month_share_averages(monthly_of(i))


def season_totals(i: Inputs) -> DataFrame:
    return rollups.season_totals(monthly_of(i))


def peak_month(i: Inputs) -> DataFrame:
    months = series.peak_month(month_of_year(i))
    return months.select("id", "peak_month", F.posexplode("month_util").alias("position", "m")).select(
        "id", "peak_month", "position", "m.*"
    )


def peak_season(i: Inputs) -> DataFrame:
    return series.season_series(season_totals(i)).select("id", "peak_season")


def timeseries_months(i: Inputs) -> DataFrame:
    months = series.monthly_series(monthly_of(i))
    return months.select(
        "id", F.array_join("active_months", ",").alias("active_months"), F.posexplode("monthly_perf").alias("position", "p")
    ).select("id", "active_months", "position", "p.*")


def timeseries_seasons(i: Inputs) -> DataFrame:
    seasons = series.season_series(season_totals(i))
    return seasons.select("id", F.posexplode("season_perf").alias("position", "p")).select("id", "position", "p.*")


def timeseries_weeks(i: Inputs) -> DataFrame:
    weeks = series.weekly_series(weekly_utilization(i))
    return weeks.select("id", F.posexplode("weekly_perf").alias("position", "p")).select("id", "position", "p.*")


def timeseries(i: Inputs) -> DataFrame:
    profile = station_timeseries(i.usage_long(LONG_LOCAL), norway(i), LONG_LOCAL)
    return profile.select(
        "id",
        "size_total",
        "start_day",
        "end_day",
        "calendar_day_count",
        "active_days_count",
        "diff_day",
        "percentage_average",
        "average_daily_minutes",
        F.size("monthly_perf").alias("months"),
        F.array_join("active_months", ",").alias("active_months"),
        "peak_month",
        F.size("season_perf").alias("seasons"),
        "peak_season",
        F.size("weekly_perf").alias("weeks"),
    ).orderBy("start_day")


def static_of(i: Inputs) -> DataFrame:
    spans = usage.station_span(i.usage_long(LONG), norway(i), LONG)
    return station_profile.station_static(spans, norway(i), i.all_stations)


def station_static(i: Inputs) -> DataFrame:
    return static_of(i).orderBy(F.desc("calendar_day_count"))


def base_of(i: Inputs) -> DataFrame:
    return feature_table.station_base(i.usage_long(LONG), norway(i), i.all_stations, LONG)


# ---------------------------------------------------------------- surroundings


def poi_within_500m(i: Inputs) -> DataFrame:
    points = i.pois.select(F.col("id").alias("poi_id"), "lon", "lat")
    pairs = points_within(i.stations, points).select("site_lon", "site_lat", "poi_id", "distance_m")
    here = i.stations.select("id", F.col("lon").alias("site_lon"), F.col("lat").alias("site_lat"))
    millimetres = "cast(floor(distance_m * 1e3D + 0.5D) as double) / 1e3D as distance_m"
    return here.join(pairs, ["site_lon", "site_lat"], "left").selectExpr("id", "poi_id", millimetres)


def at_stations(stations: DataFrame, found: DataFrame, *columns: str) -> DataFrame:
    """The stations with what was found at their places, distances to the millimetre."""
    here = stations.select("id", F.col("lon").alias("site_lon"), F.col("lat").alias("site_lat"))
    return here.join(found, ["site_lon", "site_lat"]).selectExpr(
        "id", *columns, "cast(floor(distance_m * 1e3D + 0.5D) as double) / 1e3D as distance_m"
    )


def shapes_within_500m(i: Inputs) -> DataFrame:
    shapes = i.shapes.withColumnRenamed("id", "shape_id")
    return at_stations(i.stations, shapes_within(i.stations, shapes, "shape_id"), "shape_id")


def nearest_shapes(i: Inputs) -> DataFrame:
    found = nearest_shape(i.stations, i.shapes.withColumnRenamed("id", "shape_id"), "shape_id")
    return i.stations.select("id", "lon", "lat").join(found, ["lon", "lat"], "left").select("id", "shape_id", "distance_deg")


def trails_within_500m(i: Inputs) -> DataFrame:
    # read twice by the join: the text is parsed once
    lines = stage(i.trails.withColumnRenamed("id", "trail_id"), "trails")
    pairs = lines_within(i.far_stations, lines).groupBy("site_lon", "site_lat", "trail_id").agg(F.min("distance_m").alias("distance_m"))
    return at_stations(i.far_stations, pairs, "trail_id")


def metres(df: DataFrame) -> DataFrame:
    """Distances to the millimetre: the last bits depend on the sine in use."""
    columns = [c for c in df.columns if c.endswith("_dist") or c.startswith(("road_distance_", "closest_distance"))]
    return df.withColumns({c: F.expr(f"cast(floor(`{c}` * 1e3D + 0.5D) as double) / 1e3D") for c in columns})


def poi_counts(i: Inputs, names: bool = False) -> DataFrame:
    near = stage(usage.stations_with_usage(i.usage_long(LONG), norway(i), LONG), "near")
    return poi_proximity(near, i.pois, i.categories, names=names)


def poi_superclass(i: Inputs) -> DataFrame:
    found = metres(poi_counts(i, names=True))
    joined = found.withColumn("poi_names", F.array_join("poi_names", "|"))
    return joined.orderBy("id", F.desc("poi_count"))


def road_counts(i: Inputs, names: bool = False) -> DataFrame:
    near = stage(usage.stations_with_usage(i.usage_long(LONG), norway(i), LONG), "near")
    return road_proximity(near, i.roads, names=names)


def road_within_500m(i: Inputs) -> DataFrame:
    rule = st.SWITZERLAND_UNAPPROVED
    active = stage(
        usage.active_stations(i.usage_short(SHORT), st.eligible(i.stations, rule), SHORT, ACTIVE_DAYS), "active"
    )
    found = metres(road_proximity(active, roads_of(i.roads, fixed.ROAD_COUNTRY_SWITZERLAND)))
    return found.withColumn("roads_names", F.array_join("roads_names", "|")).orderBy("id", F.desc("roads_count"))


def poi_features(i: Inputs) -> DataFrame:
    return pivots.poi_features(stage(poi_counts(i), "poi"), summary_of(i))


def road_features(i: Inputs) -> DataFrame:
    return pivots.road_features(stage(road_counts(i), "road"))


def with_poi(i: Inputs) -> DataFrame:
    return feature_table.station_with_poi(base_of(i), stage(poi_counts(i), "poi"))


def with_road(i: Inputs) -> DataFrame:
    return feature_table.station_with_road(base_of(i), stage(road_counts(i), "road"))


def nearest_population(i: Inputs) -> DataFrame:
    found = nearest(i.stations, population_scan(i), "pop_key", "population")
    return i.stations.select("id", "lon", "lat").join(found, ["lon", "lat"], "left").select(
        "id", "pop_key", "population", "distance_deg"
    )


# ---------------------------------------------------------------- features


def clean_poi(i: Inputs) -> DataFrame:
    return cleaning.with_pois(stage(poi_features(i), "poi"))


def clean_road(i: Inputs) -> DataFrame:
    # the road table lacks stations that were not in use of late: these have no road at all and go
    recent = stage(usage.stations_with_usage(i.usage_long(RECENT), norway(i), RECENT), "near")
    known = stage(road_proximity(recent, i.roads, names=False), "road")
    joined = stage(feature_table.station_with_road(base_of(i), known), "road")
    return cleaning.with_roads(joined).select("id", "operator", *cleaning.CHECKED_ROAD_COLUMNS)


def clean_complete(i: Inputs) -> DataFrame:
    return cleaning.complete_rows(scoring.occupation_bins(stage(base_of(i), "base"))).select("id", "operator", "occupation_bin")


def merge_features(i: Inputs) -> DataFrame:
    return feature_table.merged_features(i.usage_long(LONG), norway(i), i.all_stations, LONG, surroundings(i))


def occupation_bins(i: Inputs) -> DataFrame:
    binned = scoring.occupation_bins(stage(summary_of(i), "usage"))
    return scoring.occupation_rank(binned).select(
        "id", "percentage_average", "occupation_bin", "occupation_low", "occupation_high", "occupation_rank"
    )


def time_spent(i: Inputs) -> DataFrame:
    return features.time_spent(poi_features(i)).select("id", "total_time_spent")


def poi_groups(i: Inputs) -> DataFrame:
    full = features.poi_presence(features.poi_groups(poi_features(i)))
    return full.select("id", *fixed.POI_GROUPS, "poi_categories_present", "poi_categories_present_str")


def nearest_road(i: Inputs) -> DataFrame:
    named = road_features(i).withColumnsRenamed(fixed.FEATURE_NAMES)
    return features.nearest_major_road(named).select("id", "nearest_major_road_dist", "nearest_major_road_type")


def feature_thresholds(i: Inputs) -> DataFrame:
    found = scoring.feature_thresholds(stage(with_poi(i), "poi"))
    return found.withColumn("threshold", F.expr("cast(floor(threshold * 1e3D + 0.5D) as double) / 1e3D"))


def feature_score(i: Inputs) -> DataFrame:
    frame = stage(with_poi(i), "poi")
    return scoring.feature_score(frame, scoring.feature_thresholds(frame)).select("id", "good_feature_score")


def performance_rank(i: Inputs) -> DataFrame:
    # compared to six digits, so that rounding noise makes no order
    rounded = summary_of(i).selectExpr("id", f"{SIX.format('percentage_average')} as percentage_average")
    return scoring.performance_rank(stage(rounded, "usage"))


def local_center(i: Inputs) -> DataFrame:
    return features.segment_stations(i.station_flags).select("id", "shop_count", "is_local_center", "near_shops")


def near_shops(i: Inputs) -> DataFrame:
    near = features.near_shops(features.shop_count(i.station_flags), "city")
    return near.select("id", "shop_count", "is_near_shops")


def road_context(i: Inputs) -> DataFrame:
    flags = features.road_context(pivots.road_flags(stage(road_counts(i), "road")))
    return flags.select("id", "is_motorway", "is_highway_area", "is_residential_area")


def split_assign(i: Inputs) -> DataFrame:
    order = (F.col("id") * 7919 + SEED) % 1000003
    return split.split_assign(i.stations.select("id", "operator"), i.stations, order=order)


def quality_report(i: Inputs) -> DataFrame:
    frame = features.poi_presence(features.poi_groups(poi_features(i)))
    return quality.quality_report(frame, ["poi_categories_present"], ["home_dist"])


def sample_report(i: Inputs) -> DataFrame:
    return quality.sample_rows(summary_of(i), ["start_day", "calendar_day_count"])


def residential_areas(i: Inputs) -> DataFrame:
    found = rings.areas(i.extracts).rings
    return found.select("document", "area", "role", "ring", F.posexplode("coordinates").alias("position", "p")).select(
        F.col("document").cast("bigint").alias("document"), "area", "role", "ring", "position", "p.lon", "p.lat"
    )


def incomplete_rings(i: Inputs) -> DataFrame:
    return rings.areas(i.extracts).open.withColumn("document", F.col("document").cast("bigint"))


def incomplete_ways(i: Inputs) -> DataFrame:
    found = tables.incomplete_ways(i.extracts)
    return found.select(F.col("document").cast("bigint").alias("document"), "way", "missing")


def surroundings(i: Inputs) -> feature_table.Surroundings:
    return feature_table.Surroundings(i.pois, i.categories, i.roads, population_scan(i))


def final_features(i: Inputs) -> DataFrame:
    return feature_table.final_features(i.usage_long(LONG), norway(i), i.all_stations, LONG, surroundings(i))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "station_scan": station_scan,
    "population_scan": population_scan,
    "road_scan": road_scan,
    "wkt_points": wkt_points,
    "wkt_lines": wkt_lines,
    "wkt_shapes": wkt_shapes,
    "csv_roundtrip": csv_roundtrip,
    "csv_quarantine": csv_quarantine,
    "road_tables": road_tables,
    "station_in_boundary": station_in_boundary,
    "station_filter_region": station_filter_region,
    "station_filter_sql": station_filter_sql,
    "station_filter_country": station_filter_country,
    "station_filter_source": station_filter_source,
    "operator_match": operator_match,
    "usage_window": usage_window,
    "usage_partitioned": usage_partitioned,
    "bucketed_summary": bucketed_summary,
    "usage_window_local": usage_window_local,
    "hourly_detail": hourly_detail,
    "station_span": station_span,
    "active_stations": active_stations,
    "daily_utilization": daily_utilization,
    "utilization_summary": utilization_summary,
    "daily_utilization_local": daily_utilization_local,
    "monthly_utilization": monthly_of,
    "weekly_utilization": weekly_utilization,
    "month_of_year": month_of_year,
    "month_share": month_share,
    "month_share_average": month_share_average,
    "season_totals": season_totals,
    "peak_month": peak_month,
    "peak_season": peak_season,
    "timeseries_months": timeseries_months,
    "timeseries_seasons": timeseries_seasons,
    "timeseries_weeks": timeseries_weeks,
    "station_timeseries": timeseries,
    "station_static": station_static,
    "poi_within_500m": poi_within_500m,
    "poi_superclass": poi_superclass,
    "road_within_500m": road_within_500m,
    "nearest_population": nearest_population,
    "shapes_within_500m": shapes_within_500m,
    "nearest_shape": nearest_shapes,
    "trails_within_500m": trails_within_500m,
    "poi_features": lambda i: metres(poi_features(i)),
    "road_features": lambda i: metres(road_features(i)),
    "station_with_poi": lambda i: metres(with_poi(i)),
    "station_with_road": lambda i: metres(with_road(i)),
    "clean_poi": lambda i: metres(clean_poi(i)),
    "clean_road": lambda i: metres(clean_road(i)),
    "clean_complete": clean_complete,
    "merge_features": lambda i: metres(merge_features(i)),
    "occupation_bins": occupation_bins,
    "time_spent": time_spent,
    "poi_groups": poi_groups,
    "nearest_road": lambda i: metres(nearest_road(i)),
    "feature_thresholds": feature_thresholds,
    "feature_score": feature_score,
    "performance_rank": performance_rank,
    "local_center": local_center,
    "near_shops": near_shops,
    "road_context": road_context,
    "split_assign": split_assign,
    "quality_report": quality_report,
    "sample_report": sample_report,
    "residential_areas": residential_areas,
    "incomplete_ways": incomplete_ways,
    "incomplete_rings": incomplete_rings,
    "final_features": final_features,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return report(QUERIES[name](Inputs(pin(spark), folder)))
