"""Ranks, quantiles and exact-size cuts without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltscape.functions.staging import stage

#: Distinct values that one range should hold.
RANGE_VALUES = 100_000


def running_counts(df: DataFrame, value: str, by: list[str] | None = None, ranges: int | None = None) -> DataFrame:
    """One row per distinct `value` (within `by`): `n` rows hold it, `n_before` are smaller.

    Equal values are counted before any shuffle, so a hot value is one row from then on; the
    counts are written once and all further steps read them. The distinct values are cut into
    `ranges` at approximate quantiles, by default as many as their number asks for; every range
    is summed in its own task and shifted by the total of the ranges before it. The cut points
    (one per range) are fetched once and become constants, so a re-run task puts a value into
    the same range. NULL values are left out.
    """
    group = by or []
    counts = stage(
        df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n")), "value-counts"
    )
    if ranges is None:
        ranges = max(1, -(-counts.count() // RANGE_VALUES))
    placed = _placed(counts, value, group, ranges)
    within = Window.partitionBy(*group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(within), F.lit(0))
    if ranges == 1:
        return placed.select(*group, value, "n", inside.alias("n_before"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*group, "_range")
        .agg(F.sum("n").alias("_total"))
        .select(*group, "_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    # a row per range and group
    return placed.join(F.broadcast(offsets), [*group, "_range"]).select(
        *group, value, "n", (F.col("_offset") + inside).alias("n_before")
    )


def _placed(counts: DataFrame, value: str, group: list[str], ranges: int) -> DataFrame:
    """`counts` with the number of the range each value lies in."""
    if ranges == 1:
        return counts.withColumn("_range", F.lit(0))
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = counts.groupBy(*group).agg(F.percentile_approx(F.col(value), probabilities, 10 * ranges).alias("_cuts"))
    rows = [tuple(row) for row in cuts.collect()]
    if not group:
        points = sorted(set(rows[0][0] or [])) if rows else []
        return counts.withColumn("_range", _range(F.array(*map(F.lit, points)), F.col(value)) if points else F.lit(0))
    kind = T.StructType(
        [*(f for f in counts.schema.fields if f.name in group), T.StructField("_cuts", cuts.schema["_cuts"].dataType)]
    )
    local = counts.sparkSession.createDataFrame(rows, kind)
    return counts.join(F.broadcast(local), group).withColumn("_range", _range(F.col("_cuts"), F.col(value))).drop("_cuts")


def _range(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda cut: cut < value))


def linear_quantiles(long: DataFrame, by: str, value: str, probability: str) -> DataFrame:
    """Exact quantile per group, linear between the two neighbouring order statistics.

    `long` has one row per (group, value) reading and the wanted probability, which is the
    same on all rows of a group; it is read once. Returns (`by`, `quantile`); NULL values are
    skipped.
    """
    counts = running_counts(long, value, [by, probability])
    # the rows of a group are those before its largest value and those with it
    rows = counts.groupBy(by, probability).agg(F.max(F.col("n_before") + F.col("n")).alias("_rows"))
    # positions of the two order statistics, counted from 0
    position = F.col(probability) * (F.col("_rows") - 1)
    hits = (
        counts.join(F.broadcast(rows), [by, probability])
        .withColumn("_low", F.floor(position))
        .withColumn("_high", F.ceil(position))
        .withColumn("_part", position - F.floor(position))
    )

    def holds(rank: str) -> Column:
        return (F.col(rank) >= F.col("n_before")) & (F.col(rank) < F.col("n_before") + F.col("n"))

    return (
        hits.where(holds("_low") | holds("_high"))
        .groupBy(by)
        .agg(
            F.max(F.when(holds("_low"), F.col(value))).alias("_a"),
            F.max(F.when(holds("_high"), F.col(value))).alias("_b"),
            F.max("_part").alias("_part"),
        )
        .select(by, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")).alias("quantile"))
    )
