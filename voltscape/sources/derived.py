"""The library's input relations, derived from the star-schema tables.

Each text runs in Spark and, with the marked words replaced, in the SQL oracle, so both
sides start from the same rows.
"""

from __future__ import annotations

import json
from datetime import timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltscape.fixed_values import POI_CLASSES
from voltscape.functions.calendar import DayWindow
from voltscape.functions.joins import dealt
from voltscape.functions.staging import fresh_path
from voltscape.operators.shapes import read_shapes
from voltscape.sources import tables

STATION = """
select c_custkey as id,
       case when c_mktsegment in ('BUILDING','AUTOMOBILE','MACHINERY') then 'nobil' else 'sw' end as source,
       c_custkey % 10 <> 0 as is_approved,
       22 + (c_custkey*37) % 300 as capacity_kw,
       c_custkey % 6 as size_total,
       case when n_regionkey < 3 then 'Norway' else 'Sweden' end as country_name,
       case c_custkey % 5 when 0 then 'Uno Mobility' when 1 then 'UNO charge'
                          when 3 then 'Circle' when 4 then 'Mer' end as operator,
       c_name as title, concat('Street ', cast(c_custkey % 50 as varchar(10))) as address,
       10.56e0 + ((c_custkey*7919) % 7610)/1000.0e0 as lon,
       64.92e0 + ((c_custkey*104729) % 4695)/1000.0e0 as lat
from {customer} join {nation} on c_nationkey = n_nationkey
"""

# Some stations are listed twice in the unfiltered table, under another address and title.
LISTED_TWICE = """
select * from {station}
union all
select id, 'other' as source, is_approved, capacity_kw, size_total, 'Norge' as country_name, operator,
       concat(title, ' (old)') as title, concat('Yard ', cast(id % 50 as varchar(10))) as address, lon, lat
from {station} where id % 7 = 0
"""

USAGE_LONG = """
select o_custkey as id, __HOUR__ as hour, o_totalprice/1000 as charging_duration,
       o_custkey % 6 as size_total, 22 + (o_custkey*37) % 300 as capacity_kw
from {orders}
"""

USAGE_SHORT = """
select user_id as id, __HOUR__ as hour, sum(value) as charging_duration,
       min(user_id % 6) as size_total, 22 + (user_id*37) % 300 as capacity_kw
from {events} group by 1, 2, 5
"""

POI = """
select p_partkey as id, p_type as fclass, case when p_size % 7 = 0 then null else p_name end as name,
       10.56e0 + (((__ANCHOR__)*7919) % 7610)/1000.0e0 + ((p_partkey*31) % 200 - 100)/10000.0e0 as lon,
       64.92e0 + (((__ANCHOR__)*104729) % 4695)/1000.0e0 + ((p_partkey*17) % 100 - 50)/10000.0e0 as lat
from {part}
"""

CATEGORY = """
select * from (values ('Cafe and restaurant', array('ECONOMY', 'LARGE')),
                      ('Hobby', array('LARGE')),
                      ('Home', array('MEDIUM')),
                      ('Service', array('PROMO')),
                      ('Food & drink', array('ECONOMY')),
                      ('24h-shop', array('PROMO', 'SMALL')),
                      (null, array('SMALL'))) as t(superclass, subclass)
"""

ROAD = """
select o_orderkey as id,
       case o_orderpriority when '1-URGENT' then 'motorway' when '2-HIGH' then 'trunk'
            when '3-MEDIUM' then 'primary' when '4-NOT SPECIFIED' then 'secondary' else 'residential' end as class,
       case when o_orderkey % 5 = 0 then null else concat('road ', cast(o_orderkey % 97 as varchar(10))) end as name,
       case when o_custkey % 4 = 0 then 'Switzerland' else 'Norway' end as country,
       10.56e0 + ((o_custkey*7919) % 7610)/1000.0e0 + ((o_orderkey*13) % 200 - 100)/10000.0e0 as x1,
       64.92e0 + ((o_custkey*104729) % 4695)/1000.0e0 + ((o_orderkey*29) % 100 - 50)/10000.0e0 as y1,
       10.56e0 + ((o_custkey*7919) % 7610)/1000.0e0 + ((o_orderkey*37) % 200 - 100)/10000.0e0 as x2,
       64.92e0 + ((o_custkey*104729) % 4695)/1000.0e0 + ((o_orderkey*41) % 100 - 50)/10000.0e0 as y2
from {orders}
"""

POPULATION = """
select s_suppkey as pop_key,
       10.56e0 + ((s_suppkey*6151) % 7610)/1000.0e0 as lon,
       64.92e0 + ((s_suppkey*3571) % 4695)/1000.0e0 as lat,
       cast(floor(s_acctbal*10) as bigint) as population,
       date '2018-01-01' + cast((s_suppkey*37) % 1500 as int) as last_updated
from {supplier}
"""

BOUNDARY = ((11.0, 65.2), (14.5, 65.0), (14.0, 67.0), (17.8, 68.2), (16.0, 69.4))

# A square and, around it, a hexagon: nodes 0 to 3 and 4 to 9 of each map extract.
CORNERS = (
    (0, 0), (0.01, 0), (0.01, 0.01), (0, 0.01),
    (-0.01, -0.01), (0.005, -0.02), (0.02, -0.01), (0.02, 0.02), (0.005, 0.03), (-0.01, 0.02),
)

# Shapes around the points of interest, by id modulo 6: kind, and its parts' vertex lists in widths
# and heights from the point. The last is no geometry, as its ring is open.
SHAPES = {
    0: ("POLYGON", [[[(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)], [(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5), (-0.5, -0.5)]]]),
    1: ("MULTIPOLYGON", [[[(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]], [[(2, -1), (4, -1), (4, 1), (2, -1)]]]),
    2: ("LINESTRING", [[[(-1, 0), (0, 1), (1, 0)]]]),
    3: ("POINT", [[[(0, 0)]]]),
    4: ("POLYGON Z", [[[(-1, -1), (1, -1), (0, 1), (-1, -1)]]]),
    5: ("POLYGON", [[[(-1, -1), (1, -1), (0, 1)]]]),
}
SHAPE_HEIGHT = "(103 + (id % 7) * 82) / 100000.0e0"
# Trails of 3 to 200 vertices that start at the stations, one per supplier.
TRAIL = """
select s_suppkey as id, 3 + (s_suppkey * 37) % 198 as vertices,
       10.56e0 + ((s_suppkey*7919) % 7610)/1000.0e0 as x, 64.92e0 + ((s_suppkey*104729) % 4695)/1000.0e0 as y
from {supplier}
"""
TRAIL_X, TRAIL_Y = "x + k * 0.0008e0", "y + (k % 2) * 0.0005e0 + k * 0.0001e0"
# What is added to longitudes, so that some places and trails lie on either side of the antimeridian.
FAR_EAST = 165.9
# Rows, and vertices, whose text one task makes and reads.
TEXTS_PER_TASK, VERTICES_PER_TASK = 20_000, 200_000

LONG_HOUR = "cast(o_orderdate as timestamp) + make_dt_interval(0, cast(o_orderkey % 24 as int))"
SHORT_HOUR = "date_trunc('hour', cast(ts as timestamp))"
ANCHOR = "p_partkey div 10"


def _around(df: DataFrame, column: str, window: DayWindow) -> DataFrame:
    """Rows whose stored time lies in the window, a day wider on either side: the hour is derived
    from it, and this range reaches the file scan."""
    first, last = window.start - timedelta(days=1), window.end + timedelta(days=2)
    return df.where((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(last)))


def _point_text() -> Column:
    return F.format_string("POINT (%.6f %.6f)", "lon", "lat").alias("geometry")


class Inputs:
    """The input relations over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def _derive(self, text: str, *tables: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **{name: self.table(name) for name in tables}, **frames)

    @cached_property
    def stations(self) -> DataFrame:
        return self._derive(STATION, "customer", "nation")

    @cached_property
    def all_stations(self) -> DataFrame:
        """The unfiltered station table."""
        return self._derive(LISTED_TWICE, station=self.stations)

    def usage_long(self, window: DayWindow) -> DataFrame:
        """Six and a half years, some ten rows per station: the rows a window may need."""
        rows = _around(self.table("orders"), "o_orderdate", window)
        return self._derive(USAGE_LONG.replace("__HOUR__", LONG_HOUR), orders=rows)

    def usage_short(self, window: DayWindow) -> DataFrame:
        """One month of true hours: the rows a window may need."""
        rows = _around(self.table("events"), "ts", window)
        return self._derive(USAGE_SHORT.replace("__HOUR__", SHORT_HOUR), events=rows)

    @cached_property
    def pois(self) -> DataFrame:
        """Points of interest; their places arrive as text."""
        rows = dealt(self._derive(POI.replace("__ANCHOR__", ANCHOR), "part"), per_task=TEXTS_PER_TASK)
        return tables.read_points(rows.select("id", "fclass", "name", _point_text()), "geometry").drop("geometry")

    @cached_property
    def categories(self) -> DataFrame:
        return self._derive(CATEGORY)

    @cached_property
    def road_texts(self) -> DataFrame:
        """Raw road rows with their geometry as text."""
        vertices = "transform(coordinates, c -> format_string('%.6f %.6f', c.lon, c.lat))"
        text = f"concat('LINESTRING (', array_join({vertices}, ', '), ')') as geometry"
        return self.roads.selectExpr("id", "class", "name", "country", text)

    @cached_property
    def roads(self) -> DataFrame:
        """Raw road rows; the geometry is an array of vertices."""
        rows = self._derive(ROAD, "orders")
        vertices = F.array(*(F.struct(F.col(f"x{i}").alias("lon"), F.col(f"y{i}").alias("lat")) for i in (1, 2)))
        return rows.select("id", "class", "name", "country", vertices.alias("coordinates"))

    @cached_property
    def shape_texts(self) -> DataFrame:
        """Shapes of several kinds around the points of interest, as text."""
        width, height = f"2 * {SHAPE_HEIGHT}", SHAPE_HEIGHT

        def listed(vertices: list, more: str) -> str:
            return "(" + ", ".join(f"%.6f %.6f{more}" for _ in vertices) + ")"

        arms = []
        for rest, (kind, parts) in SHAPES.items():
            more = " 7" if kind.endswith("Z") else ""
            lists = ["(" + ", ".join(listed(v, more) for v in part) + ")" for part in parts]
            body = f"({', '.join(lists)})" if kind.startswith("MULTI") else lists[0]
            body = body[1:-1] if kind in ("LINESTRING", "POINT") else body
            values = ", ".join(f"lon + {dx} * {width}, lat + {dy} * {height}" for part in parts for v in part for dx, dy in v)
            arms.append(f"when {rest} then format_string('{kind} {body}', {values})")
        return self.pois.selectExpr("id", f"case id % 6 {' '.join(arms)} end as geometry")

    @cached_property
    def shapes(self) -> DataFrame:
        return read_shapes(self.shape_texts)

    @cached_property
    def trails(self) -> DataFrame:
        """Lines of many vertices, moved to the antimeridian; their vertices arrive as text."""
        rows = dealt(self._derive(TRAIL, "supplier"), "vertices", VERTICES_PER_TASK)
        lon = f"pmod({TRAIL_X} + {FAR_EAST} + 180, 360) - 180"
        vertex = f"format_string('%.7f %.7f', {lon}, {TRAIL_Y})"
        text = f"concat('LINESTRING (', array_join(transform(sequence(0, cast(vertices as int) - 1), k -> {vertex}), ', '), ')')"
        return tables.read_lines(rows.selectExpr("id", f"{text} as geometry"), "geometry").drop("geometry")

    @cached_property
    def far_stations(self) -> DataFrame:
        """The stations, moved like the trails."""
        return self.stations.withColumn("lon", F.expr(f"pmod(lon + {FAR_EAST} + 180, 360) - 180"))

    def csv_lines(self) -> str:
        """Path of CSV text made from the customers, one record each: id, balance, day, note. Notes
        have quotes and line ends; some records have a word for the balance, a field too few or too
        many, or no id."""
        plain = "concat_ws(',', cast(c_custkey as string), cast(c_acctbal as string), '2024-01-0' || (1 + c_custkey % 9), {note})"
        note = "concat('\"say \"\"', c_mktsegment, if(c_custkey % 4 = 0, '\"\",\n', '\"\", '), 'yes\"')"
        text = (
            f"case c_custkey % 10 when 3 then concat_ws(',', cast(c_custkey as string), 'much', '2024-01-01', 'a') "
            f"when 5 then concat_ws(',', cast(c_custkey as string), '1.5') "
            f"when 7 then concat_ws(',', cast(c_custkey as string), '1.5', '2024-01-01', 'a', 'b') "
            f"when 9 then concat_ws(',', '', '1.5', '2024-01-01', 'note ' || c_custkey) "
            f"else {plain.format(note=note)} end as value"
        )
        path = fresh_path(self.spark, "lines")
        self.table("customer").selectExpr(text).write.text(path)
        return path

    @cached_property
    def population(self) -> DataFrame:
        """Population points; their places arrive as text."""
        rows = self._derive(POPULATION, "supplier")
        text = rows.select("pop_key", "population", "last_updated", _point_text())
        return tables.read_points(text, "geometry").drop("geometry")

    @cached_property
    def boundary(self) -> DataFrame:
        """Edges of a GeoJSON file: the boundary is the first of its two features."""
        path = fresh_path(self.spark, "boundary")
        self.spark.createDataFrame([(self.boundary_text,)], "value string").write.text(path)
        return tables.read_boundary(self.spark, path)

    @property
    def boundary_text(self) -> str:
        ring = [[x, y] for x, y in (*BOUNDARY, BOUNDARY[0])]
        other = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
        features = [
            {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": rings}}
            for rings in ([ring], other)
        ]
        return json.dumps({"type": "FeatureCollection", "features": features}, indent=1)

    @cached_property
    def station_flags(self) -> DataFrame:
        """Counts per class and the distance to a shopping center, from the order table."""
        return self._derive(station_flags_sql(), "orders", "customer")

    @cached_property
    def extracts(self) -> DataFrame:
        """Elements of one map extract per customer, written as JSON and read back: a closed way, an
        open way, and a relation of the closed way (inner) and of three open ways that make its
        outer ring, stored in either direction. Every fifth lacks the last node of the closed way,
        every seventh the relation's third open way."""
        node = (
            "named_struct('type', 'node', 'id', {k}L, 'lat', 60 + (c_custkey % 700) / 100.0D + {y}D, "
            "'lon', 10 + (c_custkey % 500) / 100.0D + {x}D, 'nodes', cast(null as array<bigint>), 'members', {none}, 'tags', {no_tags})"
        )
        none = "cast(null as array<struct<type: string, ref: bigint, role: string>>)"
        no_tags = "cast(null as map<string, string>)"
        nodes = [node.format(k=k, x=x, y=y, none=none, no_tags=no_tags) for k, (x, y) in enumerate(CORNERS)]
        nowhere = "'lat', cast(null as double), 'lon', cast(null as double)"
        other = "named_struct('type', '{t}', 'id', {i}, " + nowhere + ", 'nodes', {n}, 'members', {m}, 'tags', {g})"
        home = "if({}, map('landuse', 'residential'), " + no_tags + ")"

        def way(number: str, along: str, tags: str) -> str:
            return other.format(t="way", i=number, n=along, m=none, g=tags)

        ring = way("c_custkey", "array(0L, 1L, 2L, 3L, 0L)", home.format("c_custkey % 3 <> 0"))
        line = way("-5 * c_custkey - 4", "array(0L, 1L)", no_tags)
        first = way("-5 * c_custkey - 1", "array(4L, 5L, 6L)", no_tags)
        second = way("-5 * c_custkey - 2", "if(c_custkey % 2 = 0, array(6L, 7L, 8L), array(8L, 7L, 6L))", no_tags)
        third = way("-5 * c_custkey - 3", "if(c_custkey % 4 < 2, array(8L, 9L, 4L), array(4L, 9L, 8L))", no_tags)
        member = "named_struct('type', 'way', 'ref', {}, 'role', '{}')"
        outer = (member.format(f"-5 * c_custkey - {i}", "outer") for i in (2, 1, 3))
        listed = f"array({member.format('c_custkey', 'inner')}, {', '.join(outer)})"
        relation = other.format(
            t="relation", i="c_custkey", n="cast(null as array<bigint>)", m=listed, g=home.format("c_custkey % 3 <> 1")
        )
        some = f"if(c_custkey % 5 = 0, array({', '.join((*nodes[:3], *nodes[4:]))}), array({', '.join(nodes)}))"
        ways = f"array({ring}, {line}, {first}, {second}), if(c_custkey % 7 = 0, array(), array({third}))"
        documents = self.table("customer").selectExpr(
            "cast(c_custkey as string) as document", f"concat({some}, {ways}, array({relation})) as elements"
        )
        path = fresh_path(self.spark, "extracts")
        documents.write.json(path)
        return tables.read_extracts(self.spark, path, lines=True)


def station_flags_sql() -> str:
    counts = ",\n".join(
        f"sum(case when o_orderkey % 15 = {i} then o_orderkey % 17 else 0 end) as poi_count_{name}"
        for i, name in enumerate(POI_CLASSES)
    )
    center = POI_CLASSES.index("shopping_center")
    return f"""
select o_custkey as id, o_custkey - o_custkey % 3 as city, {counts},
       min(case when o_orderkey % 15 = {center} then o_totalprice/500 end) as poi_distance_shopping_center
from {{orders}} join {{customer}} on o_custkey = c_custkey group by o_custkey
"""
