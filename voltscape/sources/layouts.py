"""Layouts on disk: the hourly fact by month and station group, and bucketed tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltscape.functions.calendar import DayWindow
from voltscape.functions.joins import is_small

#: Groups of stations that a month of the fact is cut into.
STATION_GROUPS = 16


def station_group(column: str = "id") -> str:
    return f"cast(pmod(xxhash64({column}), {STATION_GROUPS}) as int)"


def write_usage(usage: DataFrame, path: str, replace: bool = False) -> None:
    """The hourly fact as Parquet folders `month=.../station_group=...`, written once.

    Rows are dealt out by month, group and hour of the day before they are written, so a folder has
    at most 24 files however many tasks there are, and a hot station's group is written by as many.
    """
    dealt = usage.selectExpr("*", "trunc(hour, 'MM') as month", f"{station_group()} as station_group")
    placed = dealt.repartition("month", "station_group", F.hour("hour"))
    ordered = placed.sortWithinPartitions("month", "station_group", "hour", "id")
    mode = "overwrite" if replace else "error"
    ordered.write.mode(mode).partitionBy("month", "station_group").parquet(path)


def months(window: DayWindow) -> tuple[date, date]:
    """First and last month that the window's hours may be stored in."""
    slack = timedelta(days=0 if window.zone == "UTC" else 1)
    return (window.start - slack).replace(day=1), (window.end + slack).replace(day=1)


def read_usage(
    spark: SparkSession, path: str, window: DayWindow, stations: DataFrame | None = None
) -> DataFrame:
    """The stored fact's rows that a window may need, for the window operators.

    The months of the window select folders when the query is planned. With few `stations`, their
    groups select folders when it runs (dynamic pruning), and rows of other stations in the
    same folders are dropped at the scan.
    """
    first, last = months(window)
    rows = spark.read.parquet(path).where(F.col("month").between(F.lit(first), F.lit(last)))
    if stations is not None and is_small(stations):
        wanted = stations.select("id").distinct().withColumn("station_group", F.expr(station_group()))
        rows = rows.join(F.broadcast(wanted), ["station_group", "id"], "left_semi")
    return rows.drop("month", "station_group")


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Save `df` as a table bucketed and sorted by `key`, replacing it, and return the table.

    Tables saved with the same key and number of buckets are joined and grouped by the key in later
    jobs without an exchange. Each bucket is one file: rows are dealt out by the key first.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)
