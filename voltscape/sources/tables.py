"""Readers and writers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltscape.functions import geo
from voltscape.functions.staging import stage


def query(spark: SparkSession, sql: str, parameters: dict[str, Any] | None = None, **tables: DataFrame) -> DataFrame:
    """SQL text with named parameters (`:name`) and frames (`{name}`).

    Only parameters whose marker occurs in the text are bound.
    """
    used = {name: value for name, value in (parameters or {}).items() if f":{name}" in sql}
    return spark.sql(sql, args=used or None, **tables)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header; the schema is given, so the file is read once."""
    return spark.read.schema(schema).csv(path, header=True)


CORRUPT = "_corrupt_record"


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    header: bool = True,
    multi_line: bool = False,
    required: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): the rows that fit the schema, and (file, record) of all others, as text.

    A record is quarantined if it has too few or too many fields, a value that is not of its
    column's type, or none in a `required` column. With `multi_line`, quoted fields may hold line
    ends; such a file can't be split, so it is one task's work. Both results come from one reading,
    which is written first.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    read = spark.read.schema(T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())]))
    rows = read.csv(path, header=header, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, quote='"', escape='"')
    # a record that lacks a required value is told by its fields, as the reader kept it for good
    fields = F.to_csv(F.struct(*(F.col(f"`{f.name}`").cast("string") for f in wanted.fields)))
    lacking = F.lit(False)
    for name in required:
        lacking = lacking | F.col(f"`{name}`").isNull()
    told = F.coalesce(F.col(CORRUPT), F.when(lacking, fields))
    known = stage(rows.withColumn(CORRUPT, told).withColumn("_file", F.input_file_name()), "csv")
    good = known.where(F.col(CORRUPT).isNull()).select(*(F.col(f"`{f.name}`") for f in wanted.fields))
    return good, known.where(F.col(CORRUPT).isNotNull()).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("record"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns become JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").csv(path, header=True)


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a catalog table with the rows of `df`, which may read the table itself.

    The rows are written to a table of their own first, which then takes the name: if the writing
    fails, the old table is as it was, and nobody finds a table half written. Frames made from the
    old table can no longer be read. `name` may have a database in front.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{name}__new_{mark}", f"{name}__old_{mark}"
    try:
        df.write.saveAsTable(fresh)
    except Exception:
        spark.sql(f"drop table if exists {fresh}")
        raise
    replaced = spark.catalog.tableExists(name)
    if replaced:
        spark.sql(f"alter table {name} rename to {old}")
    try:
        spark.sql(f"alter table {fresh} rename to {name}")
    except Exception:
        if replaced:
            spark.sql(f"alter table {old} rename to {name}")
        spark.sql(f"drop table if exists {fresh}")
        raise
    if replaced:
        spark.sql(f"drop table {old}")
    return spark.table(name)


def read_points(df: DataFrame, geometry: str) -> DataFrame:
    """Point text to `lon` and `lat`; the text is parsed once, however often they are used."""
    return geo.with_point(df, geometry, "lon", "lat")


def read_lines(df: DataFrame, geometry: str) -> DataFrame:
    """Line text to `coordinates`."""
    return df.withColumn("coordinates", geo.line_coordinates(F.col(geometry)))


def population_points(df: DataFrame, newer_than) -> DataFrame:
    """Population rows updated after a day."""
    return df.where(F.col("last_updated") > F.lit(newer_than)).select("pop_key", "population", "lon", "lat")


# ---------------------------------------------------------------- GeoJSON

RINGS = "array<array<array<double>>>"


def read_boundary(spark: SparkSession, path: str) -> DataFrame:
    """Edges (x1, y1, x2, y2) of a GeoJSON polygon file."""
    return boundary_edges(spark.read.text(path, wholetext=True), "value")


def boundary_edges(documents: DataFrame, column: str) -> DataFrame:
    """Edges of the polygon or multi-polygon in each document.

    A feature collection stands for its first feature, a feature for its geometry, and any
    other document is a geometry itself. A document without one is an error.
    """
    text = F.col(column)
    kind = F.get_json_object(text, "$.type")
    geometry = (
        F.when(kind == "FeatureCollection", F.get_json_object(text, "$.features[0].geometry"))
        .when(kind == "Feature", F.get_json_object(text, "$.geometry"))
        .otherwise(text)
    )
    shape = F.get_json_object("_geometry", "$.type")
    body = F.get_json_object("_geometry", "$.coordinates")
    rings = (
        F.when(shape == "Polygon", F.from_json(body, RINGS))
        .when(shape == "MultiPolygon", F.flatten(F.from_json(body, f"array<{RINGS}>")))
        .otherwise(F.raise_error(F.lit("document has no polygon geometry")).cast(RINGS))
    )
    named = F.transform(
        rings,
        lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))),
    )
    missing = F.raise_error(F.lit("document has no polygon geometry")).cast("array<array<struct<lon:double,lat:double>>>")
    return (
        documents.select(geometry.alias("_geometry"))
        .select(F.coalesce(named, missing).alias("_rings"))
        .select(F.inline(geo.ring_edges(F.col("_rings"))))
    )


# ---------------------------------------------------------------- nested map extracts

EXTRACT = """
elements array<struct<
  type: string, id: bigint, lat: double, lon: double, nodes: array<bigint>,
  members: array<struct<type: string, ref: bigint, role: string>>, tags: map<string, string>>>
"""


def read_extracts(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Elements of map-extract documents, one row per element, with their `document`.

    A file holds one document, or with `lines` one on each line. A document is named by its
    `document` member, or else by its file.
    """
    documents = spark.read.schema(f"document string, {EXTRACT}").json(path, multiLine=not lines)
    return extract_elements(documents.withColumn("document", F.coalesce("document", F.input_file_name())), "document")


def extract_elements(documents: DataFrame, document: str) -> DataFrame:
    """One row per element of each document."""
    return documents.select(F.col(document).alias("document"), F.inline("elements"))


def _ways(elements: DataFrame) -> DataFrame:
    """Ways of each document with their vertices in order; a vertex whose node the document
    lacks is NULL. Of several nodes or ways with one id the smallest counts."""
    nodes = (
        elements.where(F.col("type") == "node")
        .groupBy("document", F.col("id").alias("node"))
        .agg(F.min(F.struct("lon", "lat")).alias("_at"))
    )
    ways = (
        elements.where(F.col("type") == "way")
        .groupBy("document", F.col("id").alias("way"))
        .agg(F.min(F.struct("nodes", F.to_json("tags").alias("tags"))).alias("_way"))
        .select("document", "way", "_way.nodes", F.from_json("_way.tags", "map<string, string>").alias("tags"))
    )
    links = ways.select("document", "way", F.posexplode("nodes").alias("position", "node"))
    vertices = (
        links.join(nodes, ["document", "node"], "left")
        .groupBy("document", "way")
        .agg(F.sort_array(F.collect_list(F.struct("position", "_at"))).alias("_v"))
    )
    return ways.join(vertices, ["document", "way"])


def _missing() -> Column:
    return F.size(F.filter("_v", lambda v: v["_at"].isNull()))


def way_lines(elements: DataFrame) -> DataFrame:
    """Each whole way of a document with its vertices in order and whether it is a closed ring.

    Node ids are joined within the document. A way of which the document lacks a node is no
    line: incomplete_ways lists it. The vertices of one way are one row's value.
    """
    return whole_ways(elements).drop("nodes")


def whole_ways(elements: DataFrame) -> DataFrame:
    """`way_lines` with the `nodes` of each way."""
    closed = (F.size("nodes") > 3) & (F.try_element_at("nodes", F.lit(1)) == F.try_element_at("nodes", F.lit(-1)))
    return _ways(elements).where(_missing() == 0).select(
        "document",
        "way",
        "tags",
        "nodes",
        F.transform("_v", lambda v: v["_at"]).alias("coordinates"),
        F.coalesce(closed, F.lit(False)).alias("closed"),
    )


def incomplete_ways(elements: DataFrame) -> DataFrame:
    """(document, way, missing): ways with vertices whose node the document lacks."""
    return _ways(elements).select("document", "way", _missing().alias("missing")).where("missing > 0")
