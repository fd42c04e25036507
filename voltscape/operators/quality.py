"""Counts that show whether a table is sound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape.functions.ordering import linear_quantiles
from voltscape.functions.staging import stage


def id_counts(df: DataFrame) -> DataFrame:
    """Rows, different ids and rows beyond the first of their id."""
    rows, ids = F.count(F.lit(1)), F.count_distinct("id")
    return df.agg(rows.alias("rows"), ids.alias("ids"), (rows - ids).alias("repeats")).select(
        F.lit("ids").alias("check"),
        F.inline(
            F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in ("rows", "ids", "repeats")))
        ),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL included."""
    return df.groupBy(F.col(column).cast("string").alias("item")).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    ).select(F.lit(column).alias("check"), "item", "value")


def description(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, spread, extremes and quartiles of one column."""
    value = F.col(column).cast("double")
    measures = {
        "count": F.count(value).cast("double"),
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
        "min": F.min(value),
        "max": F.max(value),
    }
    basics = df.agg(*(m.alias(name) for name, m in measures.items())).select(
        F.inline(F.array(*(F.struct(F.lit(name).alias("item"), F.col(name).alias("value")) for name in measures)))
    )
    quarters = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    readings = [
        F.struct(F.lit(name).alias("item"), value.alias("value"), F.lit(p).alias("probability"))
        for name, p in quarters.items()
    ]
    long = df.select(F.inline(F.array(*readings)))
    quartiles = linear_quantiles(long, "item", "value", "probability").withColumnRenamed("quantile", "value")
    return basics.unionByName(quartiles).select(F.lit(column).alias("check"), "item", "value")


def quality_report(df: DataFrame, counted: list[str], described: list[str]) -> DataFrame:
    """All checks of a table as (check, item, value). The table is read once per check, so it
    is written first."""
    df = stage(df, "checked")
    parts = [id_counts(df), *(value_counts(df, c) for c in counted), *(description(df, c) for c in described)]
    return reduce(DataFrame.unionByName, parts)


def unmatched_distances(columns: list[str]) -> list[str]:
    """Distance columns without a count column of the same class."""
    return [
        c.removesuffix("_dist") + "_count"
        for c in columns
        if c.endswith("_dist") and c.removesuffix("_dist") + "_count" not in columns
    ]


def sample_rows(df: DataFrame, columns: list[str], n: int = 5) -> DataFrame:
    """The first rows by id, for a look."""
    return df.select("id", *(c for c in columns if c in df.columns and c != "id")).orderBy("id").limit(n)
