"""One row per station from one row per station and class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed


def class_values(df: DataFrame, column: str) -> list[str]:
    """The classes that occur, in order; NULL is none. Each becomes columns of the result, so
    their number is bounded by what a table can hold."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in rows)


def normalised(name: str) -> str:
    return name.lower().replace(" ", "_")


def quoted(name: str) -> str:
    """SQL identifier."""
    return f"`{name.replace('`', '``')}`"


def poi_features(counts: DataFrame, station_ids: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """`<class>_count` and `<class>_dist`, one row for each id of `station_ids`.

    Missing values become 0; where both are 0, nothing was near and the distance becomes
    the absent distance. `classes` defaults to those in the data.
    """
    classes = class_values(counts, "superclass") if classes is None else classes

    names = [normalised(name) for name in classes]
    if twice := sorted({name for name in names if names.count(name) > 1}):
        raise ValueError(f"classes with the same column name: {', '.join(twice)}")
    measures = {"count": "poi_count", "dist": "closest_distance_meters"}
    pivoted = counts.where("superclass is not null").groupBy("id").agg(
        F.lit(None).alias("_none"),
        *(
            F.expr(f"avg({measure}) filter (where superclass = {_text(name)}) as {quoted(f'{normalised(name)}_{ending}')}")
            for ending, measure in measures.items()
            for name in classes
        ),
    )
    ids = station_ids.select("id").distinct()
    filled = ids.join(pivoted.drop("_none"), "id", "left").fillna(0.0)
    counted, distant = ([quoted(f"{name}_{ending}") for name in names] for ending in ("count", "dist"))
    return filled.selectExpr(
        "id",
        *counted,
        *(
            f"if({count} = 0 and {distance} = 0, {fixed.ABSENT_DISTANCE_M}D, {distance}) as {distance}"
            for count, distance in zip(counted, distant)
        ),
    )


def road_features(roads: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """`road_distance_<class>` and `road_count_<class>` for every station of `roads`.

    The listed classes and those the cleaning step looks at are always there. A missing
    distance, and a distance of exactly 0, become the absent distance; a missing count 0.
    A station with two rows of one class is an error.
    """
    found = class_values(roads, "type_road") if classes is None else classes
    wanted = sorted({*fixed.ROAD_CLASSES, *fixed.CHECKED_ROAD_CLASSES, *found})

    # the first is empty unless a station has several rows of a class
    repeated = " + ".join(
        f"if(count(*) filter (where type_road = {_text(name)}) > 1, 1, 0)" for name in wanted
    )
    pivoted = roads.groupBy("id").agg(
        F.expr(f"if({repeated} > 0, raise_error('a station has several rows of one road class'), null) as _check"),
        *_of_class(wanted),
    )
    absent = f"{fixed.ABSENT_DISTANCE_M}D"
    return pivoted.where("_check is null").selectExpr(
        "id",
        *(
            f"if(coalesce({c}, 0D) = 0, {absent}, {c}) as {c}"
            for c in (quoted(f"road_distance_{name}") for name in wanted)
        ),
        *(f"coalesce(cast({c} as double), 0D) as {c}" for c in (quoted(f"road_count_{name}") for name in wanted)),
    )


def _of_class(classes: list[str]) -> list[Column]:
    measures = {"distance": "closest_distance_meters", "count": "roads_count"}
    return [
        F.expr(f"max({measure}) filter (where type_road = {_text(name)}) as {quoted(f'road_{kind}_{name}')}")
        for kind, measure in measures.items()
        for name in classes
    ]


def _text(name: str) -> str:
    """SQL text literal."""
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{quoted}'"


def road_flags(roads: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Distances and counts as found, NULL where a class is absent. `classes` defaults to those
    in the data and the ones the cleaning step looks at."""
    found = class_values(roads, "type_road") if classes is None else classes
    wanted = sorted({*fixed.CHECKED_ROAD_CLASSES, *found})
    return roads.groupBy("id").agg(*_of_class(wanted))
