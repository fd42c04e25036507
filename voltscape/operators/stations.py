"""Which stations take part."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions.joins import lookup_join


@dataclass(frozen=True)
class StationFilter:
    source: str | None = None
    approved_only: bool = True
    min_capacity_kw: float | None = None
    capacity_included: bool = True
    country: str | None = None

    def condition(self) -> Column:
        tests = [F.lit(True)]
        if self.source is not None:
            tests.append(F.col("source") == self.source)
        if self.approved_only:
            tests.append(F.col("is_approved"))
        if self.min_capacity_kw is not None:
            capacity = F.col("capacity_kw")
            tests.append(
                capacity >= self.min_capacity_kw if self.capacity_included else capacity > self.min_capacity_kw
            )
        if self.country is not None:
            tests.append(F.col("country_name") == self.country)
        result = tests[0]
        for test in tests[1:]:
            result = result & test
        return result


NORWAY = StationFilter(
    source=fixed.SOURCE_NORWAY, min_capacity_kw=fixed.MIN_CAPACITY_NORWAY_KW, country=fixed.COUNTRY_NORWAY
)
SWITZERLAND = StationFilter(
    source=fixed.SOURCE_SWITZERLAND,
    min_capacity_kw=fixed.MIN_CAPACITY_SWITZERLAND_KW,
    capacity_included=False,
)
SWITZERLAND_UNAPPROVED = StationFilter(
    source=fixed.SOURCE_SWITZERLAND,
    approved_only=False,
    min_capacity_kw=fixed.MIN_CAPACITY_SWITZERLAND_KW,
    capacity_included=False,
)


def eligible(stations: DataFrame, rule: StationFilter, boundary: DataFrame | None = None) -> DataFrame:
    """Stations that meet `rule` and, if given, lie inside the boundary's edges."""
    kept = stations.where(rule.condition())
    return kept if boundary is None else within_boundary(kept, boundary)


def within_boundary(points: DataFrame, edges: DataFrame, band_degrees: float = 0.05) -> DataFrame:
    """Rows of `points` (lon, lat) inside the rings given as edges (x1, y1, x2, y2).

    A ray towards rising longitude meets an odd number of edges from inside; with all rings
    in one edge table, holes work out. Only edges that pass the point's latitude matter, so
    points and edges meet on a latitude band. Equal points are tested once.
    """
    sites = points.select("lon", "lat").distinct().withColumn("_band", F.floor(F.col("lat") / band_degrees))
    first = F.floor(F.least("y1", "y2") / band_degrees)
    last = F.floor(F.greatest("y1", "y2") / band_degrees)
    banded = edges.where(F.col("y1") != F.col("y2")).withColumn("_band", F.explode(F.sequence(first, last)))
    slope = F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    meets = ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (
        F.col("lon") < slope * (F.col("lat") - F.col("y1")) + F.col("x1")
    )
    inside = (
        lookup_join(sites, banded, ["_band"])
        .where(meets)
        .groupBy("lon", "lat")
        .agg(F.count(F.lit(1)).alias("_edges"))
        .where(F.col("_edges") % 2 == 1)
        .select("lon", "lat")
    )
    return points.join(inside, ["lon", "lat"], "left_semi").select(*points.columns)
