"""SQL that computes each registered query's result directly from the same tables.

Written as plain joins and groupings over named steps; `sql(name)` adds the steps a query
needs. Distances use the haversine formula and, for segments, cross-track distance.
"""

from __future__ import annotations

import re

from voltscape import fixed_values as fixed
from voltscape.sources import derived

ZONE = fixed.LOCAL_ZONE
RADIUS = 6371010.0


def _source(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text).replace("array(", "list_value(").strip()


def r2(x: str) -> str:
    return f"cast(round(cast({x} as decimal(38,10)), 2) as double)"


def r6(x: str) -> str:
    return f"cast(round(cast({x} as decimal(38,10)), 6) as double)"


def r3(x: str) -> str:
    return f"floor({x} * 1e3 + 0.5) / 1e3"


def local(hour: str) -> str:
    return f"cast(({hour} at time zone 'UTC') at time zone '{ZONE}' as date)"


def between(day: str, start: str, end: str) -> str:
    return f"{day} between date '{start}' and date '{end}'"


LONG = ("1995-01-01", "2001-08-31")
LATE = ("1998-03-01", "2001-08-31")
SHORT = ("2024-01-01", "2024-01-31")
RECENT = ("2001-01-01", "2001-08-31")
HOURLY = ("2024-01-05", "2024-01-25")


def angle(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"2 * asin(sqrt(least(1, pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def bearing(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"atan2(sin(radians({lon2} - {lon1})) * cos(radians({lat2})), sin(radians({lat2} - {lat1})) "
        f"+ 2 * sin(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )


def daily_utc(usage: str, window: tuple[str, str]) -> str:
    return f"""
select u.id, cast(u.hour as date) as day, max(u.size_total) as size_total,
       sum(u.charging_duration) / nullif(max(u.size_total) * 24 * 60, 0) * 100 as daily_utilization,
       sum(u.charging_duration) / nullif(max(u.size_total), 0) as daily_avg_minutes
from {usage} u join elig s on u.id = s.id
where {between('cast(u.hour as date)', *window)} group by u.id, cast(u.hour as date)"""


def daily_local(usage: str, window: tuple[str, str]) -> str:
    return f"""
select b.id, b.day, s.size_total, sum(b.charging_duration) as minutes_charged_day,
       {r2('sum(b.charging_duration) / nullif(s.size_total * 24 * 60, 0) * 100')} as daily_utilization_pct,
       {r2('sum(b.charging_duration) / nullif(s.size_total, 0)')} as daily_avg_minutes
from (select u.id, {local('u.hour')} as day, u.charging_duration from {usage} u join elig x on u.id = x.id
      where {between(local('u.hour'), *window)}) b
join elig s on b.id = s.id group by b.id, b.day, s.size_total"""


def active(rule: str) -> str:
    return f"""
select s.id, s.capacity_kw, s.size_total, s.lon, s.lat from station s join (
  select u.id, count(distinct cast(u.hour as date)) as days from usage_short u join station x on u.id = x.id
  where {rule} and {between('cast(u.hour as date)', *SHORT)} group by u.id) d on s.id = d.id
where d.days > 15 and {rule.replace('x.', 's.')}"""


SEASON = "case " + " ".join(
    f"when month(month_start) in ({', '.join(map(str, months))}) then '{name}'" for name, months in fixed.SEASONS.items()
) + " end"
SEASON_ORDER = "case season " + " ".join(f"when '{n}' then {k}" for k, n in enumerate(fixed.SEASONS)) + " end"


POI_NAMES = {
    "Cafe and restaurant": "cafe_and_restaurant", "Hobby": "hobby", "Home": "home", "Service": "service",
    "Food & drink": "food_&_drink", "24h-shop": "24h-shop",
}


def q(column: str) -> str:
    return f'"{column}"'


def poi_pivot() -> str:
    names = POI_NAMES.items()
    counts = ", ".join(f"coalesce(avg(p.poi_count) filter (where p.superclass = '{a}'), 0) as {q(b + '_count')}" for a, b in names)
    dists = ", ".join(f"coalesce(avg(p.dist) filter (where p.superclass = '{a}'), 0) as {q(b + '_dist0')}" for a, b in names)
    fixed_up = ", ".join(
        f"case when {q(b + '_count')} = 0 and {q(b + '_dist0')} = 0 then 1000 else {q(b + '_dist0')} end as {q(b + '_dist')}"
        for _, b in names
    )
    return f"""
select id, {', '.join(q(b + '_count') for _, b in names)}, {fixed_up} from (
  select s.id, {counts}, {dists} from summary s left join poi_near p on s.id = p.id group by s.id) t"""


WANTED_ROADS = sorted({*fixed.ROAD_CLASSES, *fixed.CHECKED_ROAD_CLASSES})


def road_pivot() -> str:
    dists = ", ".join(
        f"coalesce(nullif(max(dist) filter (where type_road = '{c}'), 0), 1000) as road_distance_{c}" for c in WANTED_ROADS
    )
    counts = ", ".join(
        f"cast(coalesce(max(roads_count) filter (where type_road = '{c}'), 0) as double) as road_count_{c}"
        for c in WANTED_ROADS
    )
    return f"select id, {dists}, {counts} from road_near group by id"


def segment_distance(segments: str = "road_rows") -> str:
    """Distance of s (lon, lat) to the segment of r, over the named parts."""
    return f"""
select *, {RADIUS} * case when len = 0 or along <= 0 then d1 when along >= len then d2
                          else abs(asin(sin(d1) * sin(turn))) end as dist
from (select *, atan2(sin(d1) * cos(turn), cos(d1)) as along
      from (select s.id, s.lon, s.lat, r.id as road_id, r.class, r.name,
                   {angle('x1', 'y1', 's.lon', 's.lat')} as d1, {angle('x2', 'y2', 's.lon', 's.lat')} as d2,
                   {angle('x1', 'y1', 'x2', 'y2')} as len,
                   {bearing('x1', 'y1', 's.lon', 's.lat')} - {bearing('x1', 'y1', 'x2', 'y2')} as turn
            from STATIONS s join {segments} r on s.lat between least(y1, y2) - 0.0046 and greatest(y1, y2) + 0.0046
             and s.lon between least(x1, x2) - 0.02 and greatest(x1, x2) + 0.02) a) b"""


def roads_near(stations: str, roads: str = "road_rows") -> str:
    return f"""
select s.id, s.lon, s.lat, r.class as type_road, count(distinct r.road_id) as roads_count, min(r.dist) as dist,
       string_agg(distinct r.name, '|' order by r.name) as names
from {stations} s left join (select * from ({segment_distance(roads).replace('STATIONS', stations)}) q where dist <= 500) r
  on s.id = r.id group by s.id, s.lon, s.lat, r.class"""


NEAR_LAT = "p.lat between s.lat - 0.0046 and s.lat + 0.0046"

STEPS: dict[str, str] = {
    "station": _source(derived.STATION),
    "station_all": _source(derived.LISTED_TWICE),
    "usage_long": _source(
        derived.USAGE_LONG.replace("__HOUR__", "o_orderdate + to_hours(cast(o_orderkey % 24 as int))")
    ),
    "usage_short": _source(derived.USAGE_SHORT.replace("__HOUR__", "date_trunc('hour', ts)")),
    "poi": _source(derived.POI.replace("__ANCHOR__", "p_partkey // 10")),
    "category": _source(derived.CATEGORY),
    "road_rows": _source(derived.ROAD),
    "population_all": _source(derived.POPULATION),
    "boundary": """
select * from (values (11.0, 65.2, 14.5, 65.0), (14.5, 65.0, 14.0, 67.0), (14.0, 67.0, 17.8, 68.2),
                      (17.8, 68.2, 16.0, 69.4), (16.0, 69.4, 11.0, 65.2)) as t(x1, y1, x2, y2)""",
    "flags": _source(derived.station_flags_sql()),
    "elig": "select * from station where source = 'nobil' and is_approved and capacity_kw >= 50 and country_name = 'Norway'",
    "inside": """
select s.id, s.lon, s.lat from station s join boundary b on (b.y1 > s.lat) <> (b.y2 > s.lat)
 and s.lon < (b.x2 - b.x1) / (b.y2 - b.y1) * (s.lat - b.y1) + b.x1
group by s.id, s.lon, s.lat having count(*) % 2 = 1""",
    "spans": f"""
select u.id, min(cast(u.hour as date)) as start_day, max(cast(u.hour as date)) as end_day,
       date_diff('day', min(cast(u.hour as date)), max(cast(u.hour as date))) + 1 as calendar_day_count
from usage_long u join elig s on u.id = s.id where {between('cast(u.hour as date)', *LONG)} group by u.id""",
    "daily": daily_utc("usage_long", LONG),
    "daily_short": daily_utc("usage_short", SHORT),
    "summary": """
select s.id, d.size_total, d.start_day, d.end_day, d.calendar_day_count, d.active_days_count,
       d.pct / nullif(d.calendar_day_count, 0) as percentage_average,
       d.mins / nullif(d.calendar_day_count, 0) as average_daily_minutes
from elig s join (
  select id, max(size_total) as size_total, min(day) as start_day, max(day) as end_day,
         date_diff('day', min(day), max(day)) + 1 as calendar_day_count, count(distinct day) as active_days_count,
         sum(daily_utilization) as pct, sum(daily_avg_minutes) as mins
  from daily group by id) d on s.id = d.id""",
    "daily_l": daily_local("usage_long", LONG),
    "daily_l_short": daily_local("usage_short", SHORT),
    "summary_l": f"""
select id, max(size_total) as size_total, min(day) as start_day, max(day) as end_day,
       date_diff('day', min(day), max(day)) + 1 as calendar_day_count, count(*) as active_days_count,
       date_diff('day', min(day), max(day)) + 1 - count(*) as diff_day,
       {r2("sum(daily_utilization_pct) / (date_diff('day', min(day), max(day)) + 1)")} as percentage_average,
       {r2("sum(daily_avg_minutes) / (date_diff('day', min(day), max(day)) + 1)")} as average_daily_minutes
from daily_l group by id""",
    "monthly": f"""
select id, month_start, size_total, minutes_in_month,
       {r2('''coalesce(minutes_in_month / nullif(size_total * 1440
             * date_diff('day', month_start, cast(month_start + interval 1 month as date)), 0) * 100, 0)''')} as avg_utilization_pct,
       {r2('minutes_in_month / nullif(size_total, 0)')} as total_minutes_month,
       minutes_in_month / nullif(size_total, 0) as total_minutes_month_raw
from (select id, cast(date_trunc('month', day) as date) as month_start, max(size_total) as size_total,
             sum(minutes_charged_day) as minutes_in_month from daily_l group by 1, 2) t""",
    "weekly": f"""
select id, cast(date_trunc('week', day) as date) as week_start, {r2('avg(daily_utilization_pct)')} as avg_utilization_pct,
       {r2('sum(daily_avg_minutes)')} as total_minutes_week from daily_l group by 1, 2""",
    "month_util": """
select id, month(month_start) as month_num, avg(avg_utilization_pct) as month_avg_utilization_pct
from monthly group by 1, 2""",
    "shares": """
select id, month_start, year(month_start) as yr, month(month_start) as month_of_year, avg_utilization_pct,
       minutes_in_month / nullif(sum(minutes_in_month) over (partition by id, year(month_start)), 0) as month_share
from monthly""",
    "share_avg": "select id, month_of_year, avg(month_share) as month_share_avg from shares group by 1, 2",
    "seasons": f"""
select m.id, {SEASON} as season, {r2('sum(coalesce(a.month_share_avg, 0))')} as season_share_avg,
       {r2('sum(m.avg_utilization_pct)')} as season_avg_utilization_pct
from monthly m left join share_avg a on a.id = m.id and a.month_of_year = month(m.month_start) group by 1, 2""",
    "active_m": """
select id, string_agg(strftime(month_start, '%b'), ',' order by month_start) as active_months
from monthly where total_minutes_month >= 0 group by id""",
    "peak_m": """
select id, strftime(make_date(2000, month_num, 1), '%b') as peak_month from (
  select *, row_number() over (partition by id order by month_avg_utilization_pct desc, month_num) as k from month_util) t
where k = 1""",
    "peak_s": """
select id, season as peak_season from (
  select *, row_number() over (partition by id order by season_avg_utilization_pct desc, season) as k from seasons) t
where k = 1""",
    "static": """
select s.id, max(s.operator) as operator, s.capacity_kw, st.address, st.title, st.country_name,
       p.calendar_day_count, max(s.lon) as lon, max(s.lat) as lat
from spans p join elig s on p.id = s.id join station_all st on s.id = st.id
group by s.id, s.capacity_kw, st.address, st.title, st.country_name, p.calendar_day_count""",
    "base": """
select u.*, t.operator, t.capacity_kw, t.address, t.title, t.country_name, t.lon, t.lat
from summary u left join static t on u.id = t.id""",
    "used": "select s.id, s.lon, s.lat from spans p join elig s on p.id = s.id",
    "poi_near": f"""
select s.id, s.lon, s.lat, c.superclass, count(distinct p.id) as poi_count,
       min(p.dist) as dist, string_agg(distinct p.name, '|' order by p.name) as names
from used s left join (
  select s.id as sid, p.*, {RADIUS} * {angle('s.lon', 's.lat', 'p.lon', 'p.lat')} as dist
  from used s join poi p on {NEAR_LAT} where {RADIUS} * {angle('s.lon', 's.lat', 'p.lon', 'p.lat')} <= 500) p on p.sid = s.id
left join category c on list_contains(c.subclass, p.fclass) group by s.id, s.lon, s.lat, c.superclass""",
    "road_near": roads_near("used"),
    "poi_wide": poi_pivot(),
    "road_wide": road_pivot(),
    "base_poi": "select b.*, p.* exclude (id) from base b left join poi_wide p on b.id = p.id",
    "base_road": "select b.*, r.* exclude (id) from base b left join road_wide r on b.id = r.id",
    "poi_clean": """
select * from base_poi where id not in (
  select id from base_poi where coalesce(cafe_and_restaurant_count, 0) + coalesce(hobby_count, 0)
    + coalesce(home_count, 0) + coalesce(service_count, 0) = 0)""",
    "road_clean": "select * from base_road where id not in (select id from base_road where "
    + " + ".join(f"coalesce(road_distance_{c}, 0)" for c in fixed.CHECKED_ROAD_CLASSES)
    + " = 0)",
    "pop_points": "select pop_key, population, lon, lat from population_all where last_updated > date '2019-01-01'",
    "nearest": """
select id, pop_key, population, sqrt(d2) as distance_deg from (
  select s.id, p.pop_key, p.population, pow(s.lon - p.lon, 2) + pow(s.lat - p.lat, 2) as d2,
         row_number() over (partition by s.id order by pow(s.lon - p.lon, 2) + pow(s.lat - p.lat, 2), p.pop_key) as k
  from station s left join pop_points p on true) t where k = 1""",
}


def _merged() -> str:
    kept = ["id", "size_total", "calendar_day_count", "active_days_count", "percentage_average",
            "average_daily_minutes", "capacity_kw", "title", "country_name", "lon", "lat"]
    roads = [f"road_distance_{c}" for c in WANTED_ROADS] + [f"road_count_{c}" for c in WANTED_ROADS]
    pois = [f"{c}_{m}" for m in ("count", "dist") for c in POI_NAMES.values()]
    names = fixed.FEATURE_NAMES
    left = ", ".join(f"r.{c} as {names.get(c, c)}" for c in kept + roads)
    return f"select {left}, p.operator, {', '.join(f'p.{q(c)}' for c in pois)} from road_clean r left join poi_clean p on r.id = p.id"


STEPS["merged"] = _merged()
# one document per customer: a closed way of four nodes; a relation of it and of an outer ring of
# three ways, walked from the third, -5 c - 3, in its own direction
STEPS["corners"] = "select * from (values " + ", ".join(
    f"({k}, {x}, {y})" for k, (x, y) in enumerate(derived.CORNERS)
) + ") as t(node, x, y)"
STEPS["extract_vertices"] = """
select c_custkey as c, 'way/' || c_custkey as area, 'outer' as role, c_custkey as ring, k as position, [0, 1, 2, 3, 0][k + 1] as node
from customer, range(5) t(k) where c_custkey % 3 <> 0 and c_custkey % 5 <> 0
union all
select c_custkey, 'relation/' || c_custkey, 'inner', c_custkey, k, [0, 1, 2, 3, 0][k + 1]
from customer, range(5) t(k) where c_custkey % 3 <> 1 and c_custkey % 5 <> 0
union all
select c_custkey, 'relation/' || c_custkey, 'outer', -5 * c_custkey - 3, k,
       case when c_custkey % 4 < 2 then [8, 9, 4, 5, 6, 7, 8] else [4, 9, 8, 7, 6, 5, 4] end[k + 1]
from customer, range(7) t(k) where c_custkey % 3 <> 1 and c_custkey % 7 <> 0"""
STEPS["extract_rings"] = """
select c as document, area, role, ring, position, 10 + (c % 500) / 100.0 + x as lon, 60 + (c % 700) / 100.0 + y as lat
from extract_vertices v join corners p on p.node = v.node"""


STEPS["shape_vertices"] = f"""
select p.id, t.kind, t.part, t.ring, t.position, p.lon + dx * 2 * h as lon, p.lat + dy * h as lat
from (select *, {derived.SHAPE_HEIGHT} as h from poi) p join (values {", ".join(
    f"({rest}, '{kind.removesuffix(' Z')}', {i}, {j}, {k}, {dx}, {dy})"
    for rest, (kind, parts) in derived.SHAPES.items() if rest < 5
    for i, part in enumerate(parts) for j, ring in enumerate(part) for k, (dx, dy) in enumerate(ring)
)}) as t(rest, kind, part, ring, position, dx, dy) on p.id % 6 = t.rest"""
# a point is a segment of no length
STEPS["shape_segments"] = """
select id, kind as class, null as name, lon as x1, lat as y1, coalesce(x2, lon) as x2, coalesce(y2, lat) as y2
from (select *, lead(lon) over w as x2, lead(lat) over w as y2 from shape_vertices window w as (partition by id, part, ring order by position)) t
where x2 is not null or kind = 'POINT'"""
STEPS["shape_inside"] = """
select s.id, r.id as shape_id from station s join shape_segments r on r.class like '%POLYGON' and (r.x1 > s.lon) <> (r.x2 > s.lon)
 and s.lat < r.y1 + (s.lon - r.x1) / (r.x2 - r.x1) * (r.y2 - r.y1)
group by s.id, r.id having count(*) % 2 = 1"""
STEPS["shape_near"] = f"""
select id, shape_id, min(dist) as dist from (
  select id, road_id as shape_id, dist from ({segment_distance('shape_segments').replace('STATIONS', 'station')}) q where dist <= 500
  union all select id, shape_id, 0 from shape_inside) t group by id, shape_id"""
STEPS["shape_gaps"] = """
select s.id, r.id as shape_id, s.lon - x1 as dx, s.lat - y1 as dy, x2 - x1 as wx, y2 - y1 as wy,
       least(greatest(coalesce(((s.lon - x1) * (x2 - x1) + (s.lat - y1) * (y2 - y1))
         / nullif(pow(x2 - x1, 2) + pow(y2 - y1, 2), 0), 0), 0), 1) as t
from station s, shape_segments r"""
STEPS["shape_nearest"] = """
select id, shape_id, sqrt(d2) as distance_deg from (
  select *, row_number() over (partition by id order by d2, shape_id) as k from (
    select id, shape_id, pow(dx - t * wx, 2) + pow(dy - t * wy, 2) as d2 from shape_gaps
    union all select id, shape_id, 0 from shape_inside) d) e where k = 1"""
# where the trails lie before they are moved: turning the globe changes no distance
STEPS["trail_vertices"] = f"""
select id, k, {derived.TRAIL_X} as lon, {derived.TRAIL_Y} as lat
from (select *, unnest(range(0, vertices)) as k from ({_source(derived.TRAIL)}) t) u"""
STEPS["trail_segments"] = """
select id, null as class, null as name, lon as x1, lat as y1, x2, y2
from (select *, lead(lon) over w as x2, lead(lat) over w as y2 from trail_vertices window w as (partition by id order by k)) t where x2 is not null"""
STEPS["trail_near"] = f"""
select id, road_id as trail_id, min(dist) as dist from ({segment_distance('trail_segments').replace('STATIONS', 'station')}) q
where dist <= 500 group by id, road_id"""


def bins(table: str) -> str:
    edges = ", ".join(f"case when i = 10 then m else i * (m / 10) end" for _ in (0,))
    count = " + ".join(
        f"case when {'m' if i == 10 else f'{i} * (m / 10)'} < percentage_average then 1 else 0 end" for i in range(11)
    )
    return f"""
select *, (occupation_bin - 1) * (m / 10) as occupation_low,
       case when occupation_bin = 10 then m else occupation_bin * (m / 10) end as occupation_high
from (select *, case when percentage_average > 0 then {count} end as occupation_bin
      from (select t.*, max(percentage_average) over () as m from {table} t) a) b"""


STEPS["merged_bins"] = bins("merged")
STEPS["summary_bins"] = bins("summary")
STEPS["base_bins"] = bins("base")
COMPLETE_SKIP = "occupation_bin is not null and operator is not null and percentage_average is not null"
STEPS["enriched"] = f"""
select m.* exclude (m), n.population, 67.5 * (cafe_and_restaurant_count > 0)::int + 30 * (hobby_count > 0)::int
       + 30 * (home_count > 0)::int + 30 * (service_count > 0)::int as total_time_spent
from (select * from merged_bins where {COMPLETE_SKIP}
      qualify row_number() over (partition by id order by station_name, country_name) = 1) m
left join nearest n on m.id = n.id"""

POI_METRICS = {f"{c}_count": 0.7 for c in POI_NAMES.values()} | {f"{c}_dist": 0.3 for c in POI_NAMES.values()}
BASE_METRICS = {"calendar_day_count": 0.7, "active_days_count": 0.7} | POI_METRICS
ROAD_METRICS = {
    new: (0.7 if new.endswith("_count") else 0.3) for old, new in fixed.FEATURE_NAMES.items() if old.startswith("road_")
}


def thresholds(table: str, metrics: dict[str, float]) -> str:
    return " union all ".join(
        f"select '{c}' as metric, '{'count' if p == 0.7 else 'distance'}' as kind, "
        f"quantile_cont(cast({q(c)} as double), {p}::double) as threshold from {table}"
        for c, p in metrics.items()
    )


def score(table: str, metrics: dict[str, float]) -> str:
    limits = ", ".join(f"quantile_cont(cast({q(c)} as double), {p}::double) as {q('t_' + c)}" for c, p in metrics.items())
    met = " + ".join(
        f"case when a.{q(c)} {'>=' if p == 0.7 else '<='} t.{q('t_' + c)} then 1 else 0 end" for c, p in metrics.items()
    )
    return f"""
select a.*, greatest(0, least(10, ({met}) / {float(len(metrics) + 2)} * 10)) as good_feature_score
from {table} a, (select {limits} from {table}) t"""


STEPS["enriched_scored"] = score("enriched", BASE_METRICS | ROAD_METRICS)

GROUPS = """0 as "Supermarket", hobby_count + home_count as "Shopping", service_count as "Services", 0 as "Hotel",
  cafe_and_restaurant_count as "Restaurant", 0 as "Leisure" """
PRESENT = "(hobby_count + home_count > 0)::int + (service_count > 0)::int + (cafe_and_restaurant_count > 0)::int"


def nearest_road(column: str = "{}_dist") -> str:
    d = [column.format(c) for c in fixed.MAJOR_ROADS]
    least = f"least({', '.join(d)})"
    kind = " ".join(f"when {c} = {least} then '{name}'" for c, name in zip(d, fixed.MAJOR_ROADS))
    return f"{least} as nearest_major_road_dist, case {kind} end as nearest_major_road_type"


def is_distance(column: str) -> bool:
    return column.endswith("_dist") or column.startswith(("road_distance_", "closest_distance"))


def rounded(table: str, columns: list[str]) -> str:
    """`table` with `columns` to six digits, distances to the millimetre."""
    if not columns:
        return f"select * from {table}"
    done = (f"{r3(q(c)) if is_distance(c) else r6(q(c))} as {q(c)}" for c in columns)
    return f"select * replace ({', '.join(done)}) from {table}"


FILTER = "source = 'nobil' and is_approved and capacity_kw >= 50 and country_name = 'Norway'"
POI_COLUMNS = list(POI_METRICS)
POI_DIST = [c for c in POI_COLUMNS if c.endswith("_dist")]
ROAD_DIST = [f"road_distance_{c}" for c in WANTED_ROADS]
BASE_DOUBLE = ["percentage_average", "average_daily_minutes", "lon", "lat"]
TIME = ("67.5 * (cafe_and_restaurant_count > 0)::int + 30 * (hobby_count > 0)::int "
        "+ 30 * (home_count > 0)::int + 30 * (service_count > 0)::int")
SHOPS = " + ".join(f"coalesce(poi_count_{c}, 0)" for c in fixed.SHOP_CLASSES)
KINDS = " + ".join(f"(coalesce(poi_count_{c}, 0) > 0)::int" for c in fixed.POI_CLASSES)

FINAL_DIST = [new for old, new in fixed.FEATURE_NAMES.items() if old.startswith("road_distance")] + [
    c for c in POI_COLUMNS if c.endswith("_dist")
]
FINAL_COUNT = [new for old, new in fixed.FEATURE_NAMES.items() if old.startswith("road_count")] + [
    c for c in POI_COLUMNS if c.endswith("_count")
] + ["calendar_day_count", "active_days_count"]
FINAL_ADDED = [c for c in (f"{n}_count" for members in fixed.POI_GROUPS.values() for n in members)]


def final_features() -> str:
    def half_even(c: str) -> str:
        return f"cast(round_even(cast({q(c)} as double), 2) as double)"

    added = [c for c in dict.fromkeys(FINAL_ADDED) if c not in FINAL_COUNT]
    plain = ["id", "size_total", "capacity_kw", "station_name", "country_name", "operator",
             "road_count_living_street", "road_count_residential", "occupation_bin"]
    six = ["percentage_average", "average_daily_minutes", "occupation_low", "occupation_high", "lat"]
    return f"""
select {', '.join(plain)}, {r6('lon')} as lng, {', '.join(f'{r6(c)} as {c}' for c in six)},
       printf('(%.3f, %.3f]', occupation_low, occupation_high) as occupation_rate,
       {', '.join(f'{half_even(c)} as {q(c)}' for c in FINAL_DIST + FINAL_COUNT)},
       {', '.join(f'cast(0 as double) as {c}' for c in added)},
       {half_even('population')} as population, {half_even('total_time_spent')} as total_time_spent,
       {half_even('good_feature_score')} as good_feature_score,
       count(*) over () - rank() over (order by percentage_average) + 1 as score_performance,
       dense_rank() over (order by occupation_bin desc) as occupation_rank,
       {GROUPS}, {PRESENT} as poi_categories_present, concat({PRESENT}, '/6') as poi_categories_present_str,
       {nearest_road().replace(' as nearest_major_road_dist', ' as nmr', 1).replace('least(', 'round_even(least(', 1).replace(') as nmr', '), 2) as nearest_major_road_dist', 1)}
from enriched_scored"""


# name -> (result text, double columns to compare to six digits)
RESULTS: dict[str, tuple[str, list[str]]] = {
    "station_scan": (
        "select id, capacity_kw, size_total, operator, lon, lat from station where source = 'nobil' and capacity_kw >= 50",
        ["lon", "lat"],
    ),
    "population_scan": ("select * from pop_points", ["lon", "lat"]),
    "road_scan": (
        """select id, class, name, position, lon, lat from (
             select *, 0 as position, x1 as lon, y1 as lat from road_rows
             union all select *, 1, x2, y2 from road_rows) r where country = 'Switzerland'""",
        ["lon", "lat"],
    ),
    "wkt_points": ("select id, lon as lng, lat from poi", ["lng", "lat"]),
    "wkt_lines": (
        """select id, 0 as position, x1 as lon, y1 as lat from road_rows
           union all select id, 1, x2, y2 from road_rows""",
        ["lon", "lat"],
    ),
    "wkt_shapes": (
        """select id, kind, part, ring, position, lon, lat from shape_vertices
           union all select id, null, null, null, null, null, null from poi where id % 6 = 5""",
        ["lon", "lat"],
    ),
    "csv_roundtrip": (
        """select m.id, a.active_months, m.month_start, m.avg_utilization_pct, m.total_minutes_month >= 0 as active_flag
           from monthly m left join active_m a on m.id = a.id""",
        [],
    ),
    "csv_quarantine": (
        """select c_custkey as id, c_acctbal::double as balance, date '2024-01-01' + cast(c_custkey % 9 as int) as day,
                  'say "' || c_mktsegment || case when c_custkey % 4 = 0 then '",' || chr(10) else '", ' end || 'yes' as note, null as record
           from customer where c_custkey % 10 not in (3, 5, 7, 9)
           union all
           select null, null, null, null, case c_custkey % 10 when 3 then c_custkey || ',much,2024-01-01,a' when 5 then c_custkey || ',1.5'
                  when 7 then c_custkey || ',1.5,2024-01-01,a,b' else ',1.5,2024-01-01,note ' || c_custkey end
           from customer where c_custkey % 10 in (3, 5, 7, 9)""",
        ["balance"],
    ),
    "road_tables": (
        "select id, lon, lat, type_road, roads_count, dist as closest_distance_meters from active_roads",
        ["lon", "lat", "closest_distance_meters"],
    ),
    "station_in_boundary": ("select * from inside", ["lon", "lat"]),
    "station_filter_region": (
        "select e.id, e.capacity_kw, e.operator from elig e where e.id in (select id from inside)", [],
    ),
    "station_filter_sql": (
        "select e.id, e.capacity_kw, e.operator from elig e where e.id in (select id from inside)", [],
    ),
    "station_filter_country": ("select id, capacity_kw, operator from elig", []),
    "station_filter_source": (
        "select id, capacity_kw, is_approved as approved from station where source = 'sw' and capacity_kw > 100", [],
    ),
    "operator_match": ("select id, operator from station where coalesce(operator ilike '%uno%', false)", []),
    "usage_window": (
        f"""select u.id, cast(u.hour as date) as day, u.charging_duration from usage_long u join elig s on u.id = s.id
            where {between('cast(u.hour as date)', *LATE)}""",
        ["charging_duration"],
    ),
    "usage_partitioned": (
        f"""select u.id, cast(u.hour as date) as day, u.charging_duration from usage_long u join elig s on u.id = s.id
            where {between('cast(u.hour as date)', *LATE)}""",
        ["charging_duration"],
    ),
    "bucketed_summary": (
        """select s.id, s.operator, s.title, count(*) as days, avg(d.daily_utilization) as mean_utilization
           from elig s join daily_short d on d.id = s.id group by s.id, s.operator, s.title""",
        ["mean_utilization"],
    ),
    "usage_window_local": (
        f"""select u.id, u.hour, {local('u.hour')} as day, u.charging_duration
            from usage_short u join elig s on u.id = s.id where {between(local('u.hour'), *SHORT)}""",
        ["charging_duration"],
    ),
    "hourly_detail": (
        f"""select u.id, u.hour, u.charging_duration, u.capacity_kw, s.operator, s.lon, s.lat, s.title,
                   cast(u.hour as date) as day, strftime(u.hour, '%Y-%m') as month, hour(u.hour) as hour_of_day, s.size_total
            from usage_short u join elig s on u.id = s.id where {between('cast(u.hour as date)', *HOURLY)}""",
        ["charging_duration", "lon", "lat"],
    ),
    "station_span": ("select * from spans", []),
    "active_stations": (active("x.source = 'sw' and x.capacity_kw > 100"), ["lon", "lat"]),
    "daily_utilization": ("select * from daily_short", ["daily_utilization", "daily_avg_minutes"]),
    "utilization_summary": ("select * from summary", ["percentage_average", "average_daily_minutes"]),
    "daily_utilization_local": ("select * from daily_l_short", ["minutes_charged_day"]),
    "monthly_utilization": ("select * from monthly", ["minutes_in_month", "total_minutes_month_raw"]),
    "weekly_utilization": ("select * from weekly", []),
    "month_of_year": ("select * from month_util", ["month_avg_utilization_pct"]),
    "month_share": ("select id, month_start, yr, month_of_year, month_share from shares", ["month_share"]),
    "month_share_average": ("select * from share_avg", ["month_share_avg"]),
    "season_totals": ("select * from seasons", []),
    "peak_month": (
        """select p.id, p.peak_month, row_number() over (partition by p.id order by n.month_num) - 1 as position,
                  n.month_num, n.month_avg_utilization_pct
           from peak_m p join month_util n on p.id = n.id""",
        ["month_avg_utilization_pct"],
    ),
    "peak_season": ("select * from peak_s", []),
    "timeseries_months": (
        """select m.id, a.active_months, row_number() over (partition by m.id order by m.month_start) - 1 as position,
                  m.month_start, m.avg_utilization_pct, m.total_minutes_month >= 0 as active_flag
           from monthly m left join active_m a on m.id = a.id""",
        [],
    ),
    "timeseries_seasons": (
        f"""select id, row_number() over (partition by id order by {SEASON_ORDER}) - 1 as position, season,
                   season_share_avg, season_avg_utilization_pct from seasons""",
        [],
    ),
    "timeseries_weeks": (
        """select id, row_number() over (partition by id order by week_start) - 1 as position, week_start,
                  avg_utilization_pct, total_minutes_week from weekly""",
        [],
    ),
    "station_timeseries": (
        """select u.*, m.months, a.active_months, pm.peak_month, s.seasons, ps.peak_season, w.weeks from summary_l u
           left join (select id, count(*) as months from monthly group by id) m on u.id = m.id
           left join active_m a on u.id = a.id left join peak_m pm on u.id = pm.id left join peak_s ps on u.id = ps.id
           left join (select id, count(*) as seasons from seasons group by id) s on u.id = s.id
           left join (select id, count(*) as weeks from weekly group by id) w on u.id = w.id""",
        [],
    ),
    "station_static": ("select * from static", ["lon", "lat"]),
    "poi_within_500m": (
        f"""select s.id, p.poi_id, p.distance_m from station s left join (
              select s.id as sid, p.id as poi_id,
                     {r3(f"{RADIUS} * {angle('s.lon', 's.lat', 'p.lon', 'p.lat')}")} as distance_m
              from station s join poi p on {NEAR_LAT}
              where {RADIUS} * {angle('s.lon', 's.lat', 'p.lon', 'p.lat')} <= 500) p on p.sid = s.id""",
        [],
    ),
    "poi_superclass": (
        """select id, lon, lat, superclass, poi_count, dist as closest_distance_meters, names as poi_names
           from poi_near""",
        ["lon", "lat", "closest_distance_meters"],
    ),
    "road_within_500m": (
        """select id, lon, lat, type_road, roads_count, dist as closest_distance_meters, names as roads_names
           from active_roads""",
        ["lon", "lat", "closest_distance_meters"],
    ),
    "shapes_within_500m": (f"select id, shape_id, {r3('dist')} as distance_m from shape_near", []),
    "nearest_shape": ("select s.id, n.shape_id, n.distance_deg from station s left join shape_nearest n on n.id = s.id", ["distance_deg"]),
    "trails_within_500m": (f"select id, trail_id, {r3('dist')} as distance_m from trail_near", []),
    "nearest_population": ("select * from nearest", ["distance_deg"]),
    "poi_features": ("select * from poi_wide", POI_DIST),
    "road_features": ("select * from road_wide", ROAD_DIST),
    "station_with_poi": ("select * from base_poi", BASE_DOUBLE + POI_DIST),
    "station_with_road": ("select * from base_road", BASE_DOUBLE + ROAD_DIST),
    "clean_poi": ("select w.* from poi_wide w where w.id in (select id from poi_clean)", POI_DIST),
    "clean_road": (
        "select id, operator, " + ", ".join(f"road_distance_{c}" for c in fixed.CHECKED_ROAD_CLASSES) + f" from road_clean where id in (select id from usage_long where {between('cast(hour as date)', *RECENT)})",
        [f"road_distance_{c}" for c in fixed.CHECKED_ROAD_CLASSES],
    ),
    "clean_complete": (f"select id, operator, occupation_bin from base_bins where {COMPLETE_SKIP}", []),
    "merge_features": ("select * from merged", BASE_DOUBLE + FINAL_DIST),
    "occupation_bins": (
        """select id, percentage_average, occupation_bin, occupation_low, occupation_high,
                  case when occupation_bin is not null
                       then (select count(distinct b.occupation_bin) from summary_bins b
                             where b.occupation_bin >= a.occupation_bin) end as occupation_rank
           from summary_bins a""",
        ["percentage_average", "occupation_low", "occupation_high"],
    ),
    "time_spent": (f"select id, cast({TIME} as double) as total_time_spent from poi_wide", []),
    "poi_groups": (
        f"""select id, {GROUPS}, {PRESENT} as poi_categories_present, concat({PRESENT}, '/6') as poi_categories_present_str
            from poi_wide""",
        [],
    ),
    "nearest_road": (
        f"select id, {nearest_road('road_distance_{}')} from road_wide", ["nearest_major_road_dist"],
    ),
    "feature_thresholds": (f"select metric, kind, {r3('threshold')} as threshold from ({thresholds('base_poi', BASE_METRICS)}) t", []),
    "feature_score": (
        f"select id, good_feature_score from ({score('base_poi', BASE_METRICS)}) t", ["good_feature_score"],
    ),
    "performance_rank": (
        f"""select id, p as percentage_average,
                   case when p is not null then count(*) over () - rank() over (order by p nulls last) + 1 end as score_performance
            from (select id, {r6('percentage_average')} as p from summary) t""",
        [],
    ),
    "local_center": (
        f"""select id, {SHOPS} as shop_count,
                   case when coalesce(poi_count_shopping_center, 0) <> 0 and coalesce(poi_count_service, 0) >= 10
                         and {SHOPS} >= 10 and {KINDS} >= 5 then 1 else 0 end as is_local_center, 0 as near_shops from flags""",
        [],
    ),
    "near_shops": (
        f"""select f.id, {SHOPS} as shop_count,
                   case when (case when c.total > 0 then ({SHOPS}) / c.total else 0 end) > 0.2
                          or poi_distance_shopping_center < 500 then 1 else 0 end as is_near_shops
            from flags f join (select city, sum({SHOPS}) as total from flags group by city) c on f.city = c.city""",
        [],
    ),
    "road_context": (
        """select id, (m > 0 and m < 100)::int as is_motorway,
                  ((m > 0 and m < 200) or (p > 0 and p < 200) or (s > 0 and s < 200))::int as is_highway_area,
                  (r > 0 and r < 350 and rc >= 1 and m + mc + p + pc + s + sc = 0)::int as is_residential_area
           from (select id, """
        + ", ".join(
            f"coalesce(max(dist) filter (where type_road = '{c}'), 0) as {k}, "
            f"coalesce(max(roads_count) filter (where type_road = '{c}'), 0) as {k}c"
            for c, k in (("motorway", "m"), ("primary", "p"), ("secondary", "s"), ("residential", "r"))
        )
        + " from road_near group by id) t",
        [],
    ),
    "split_assign": (
        """select id, operator, case when id in (select id from test_ids) then 'test'
                  when k <= (select cast(floor(0.15 * count(*)) as bigint) from station) then 'validation' else 'train' end as split
           from (select s.*, case when s.id not in (select id from test_ids)
                   then row_number() over (partition by s.id in (select id from test_ids)
                                           order by (s.id * 7919 + 42) % 1000003) end as k from station s) t""",
        [],
    ),
    "sample_report": ("select id, start_day, calendar_day_count from summary order by id limit 5", []),
    "quality_report": (
        f"""
        select 'ids' as "check", 'rows' as item, cast(count(*) as double) as value from poi_wide
        union all select 'ids', 'ids', cast(count(distinct id) as double) from poi_wide
        union all select 'ids', 'repeats', cast(count(*) - count(distinct id) as double) from poi_wide
        union all select 'poi_categories_present', cast({PRESENT} as varchar), cast(count(*) as double) from poi_wide group by 2
        union all select 'home_dist', 'count', cast(count(home_dist) as double) from poi_wide
        union all select 'home_dist', 'mean', avg(home_dist) from poi_wide
        union all select 'home_dist', 'std', stddev_samp(home_dist) from poi_wide
        union all select 'home_dist', 'min', min(home_dist) from poi_wide
        union all select 'home_dist', 'max', max(home_dist) from poi_wide
        union all select 'home_dist', '25%', quantile_cont(home_dist, 0.25::double) from poi_wide
        union all select 'home_dist', '50%', quantile_cont(home_dist, 0.5::double) from poi_wide
        union all select 'home_dist', '75%', quantile_cont(home_dist, 0.75::double) from poi_wide""",
        ["value"],
    ),
    "residential_areas": ("select * from extract_rings", ["lon", "lat"]),
    "incomplete_ways": ("select c_custkey as document, c_custkey as way, 1 as missing from customer where c_custkey % 5 = 0", []),
    "incomplete_rings": (
        """select c_custkey as document, c_custkey as relation, 'outer' as role, -5 * c_custkey - 2 as ring, 2 as ways,
                  2 as open_ends, 0 as branches
           from customer where c_custkey % 3 <> 1 and c_custkey % 7 = 0""",
        [],
    ),
    "final_features": (final_features(), []),
}
STEPS["active"] = active("x.source = 'sw' and x.capacity_kw > 100")
STEPS["swiss_roads"] = "select * from road_rows where country = 'Switzerland'"
STEPS["active_roads"] = roads_near("active", "swiss_roads")
STEPS["test_ids"] = """
select id from station where coalesce(operator ilike '%uno%', false) order by (id * 7919 + 42) % 1000003, id limit 56"""


def _needed(text: str, seen: dict[str, None]) -> None:
    """Put the steps that `text` uses, and theirs, into `seen` in order of definition."""
    for word in re.findall(r"[a-z_]+", text):
        if word in STEPS and word not in seen:
            _needed(STEPS[word], seen)
            seen.setdefault(word)


def sql(name: str) -> str:
    text, doubles = RESULTS[name]
    steps: dict[str, None] = {}
    _needed(text, steps)
    body = f"(\n{text.strip()}\n) as result"
    final = rounded(body, doubles)
    if not steps:
        return final
    listed = ",\n".join(f"{step} as (\n{STEPS[step].strip()}\n)" for step in steps)
    return f"with {listed}\n{final}"


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in RESULTS}
