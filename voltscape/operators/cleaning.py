"""Which rows of the wide tables survive, and how the tables come together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions.numeric import row_sum

REQUIRED_POI_COLUMNS = [f"{name}_count" for name in fixed.REQUIRED_POI_CLASSES]
CHECKED_ROAD_COLUMNS = [f"road_distance_{name}" for name in fixed.CHECKED_ROAD_CLASSES]
# Columns of the merged table that nothing later uses.
UNUSED_COLUMNS = ["start_day", "end_day", "address"]


def with_signal(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop every row of an id that has a row whose `columns` sum to 0 (NULLs count as 0)."""
    empty = df.where(row_sum([F.col(c) for c in columns]) == 0).select("id").distinct()
    return df.join(empty, "id", "left_anti").select(*df.columns)


def with_pois(df: DataFrame) -> DataFrame:
    return with_signal(df, REQUIRED_POI_COLUMNS)


def with_roads(df: DataFrame) -> DataFrame:
    return with_signal(df, CHECKED_ROAD_COLUMNS)


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any NULL."""
    return df.na.drop("any")


def one_row_per_id(df: DataFrame) -> DataFrame:
    """One row per id: of several the first by all columns in their order, NULL first."""
    others = [c for c in df.columns if c != "id"]
    first = df.groupBy("id").agg(F.min(F.struct(*(f"`{c}`" for c in others))).alias("_first"))
    return first.select("id", "_first.*").select(*(f"`{c}`" for c in df.columns))


def ensure_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Add the missing columns as 0."""
    missing = {name: F.lit(0) for name in names if name not in df.columns}
    return df.withColumns(missing) if missing else df


def merge_features(roads: DataFrame, segmented: DataFrame) -> DataFrame:
    """Road table with the POI table's features; shared columns come from the road side.

    Only the operator is taken from the POI side, so it is NULL for stations the POI
    cleaning dropped.
    """
    shared = [c for c in segmented.columns if c in roads.columns and c not in ("id", "operator")]
    left = roads.drop("operator", *UNUSED_COLUMNS)
    right = segmented.drop(*shared, *UNUSED_COLUMNS)
    return left.join(right, "id", "left").withColumnsRenamed(fixed.FEATURE_NAMES)


def columns_ending(df: DataFrame, *endings: str) -> list[str]:
    return [c for c in df.columns if c.endswith(endings)]


def distance_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith("_dist") or c.startswith("road_distance_")]


def fill_counts(df: DataFrame) -> DataFrame:
    return df.fillna(0, subset=columns_ending(df, "_count"))


def rounded(df: DataFrame, columns: list[str], rounding) -> DataFrame:
    done: dict[str, Column] = {c: rounding(F.col(f"`{c}`")) for c in columns if c in df.columns}
    return df.withColumns(done) if done else df
