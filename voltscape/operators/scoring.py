"""Bins, thresholds, scores and ranks over all stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions.joins import lookup_pairs
from voltscape.functions.ordering import linear_quantiles, running_counts
from voltscape.operators.cleaning import columns_ending, distance_columns


def occupation_bins(df: DataFrame, column: str = "percentage_average") -> DataFrame:
    """Equal right-closed bins from 0 to the largest value.

    Adds `occupation_bin` (1 is the lowest), its ends and a label. Values of 0 or below and
    NULL fall in no bin.
    """
    bins = fixed.UTILIZATION_BINS
    largest = df.agg(F.max(column)).scalar()
    marked = df.withColumn("_max", largest)

    def edge(number: str) -> str:
        return f"if({number} = {bins}, _max, {number} * (_max / {bins}))"

    below = " + ".join(f"if({edge(str(i))} < {column}, 1, 0)" for i in range(bins + 1))
    binned = marked.withColumn("occupation_bin", F.expr(f"case when {column} > 0 then {below} end"))
    ends = binned.selectExpr(
        "*", f"{edge('(occupation_bin - 1)')} as occupation_low", f"{edge('occupation_bin')} as occupation_high"
    )
    label = F.expr("if(occupation_bin is null, null, format_string('(%.3f, %.3f]', occupation_low, occupation_high))")
    return ends.withColumn("occupation_rate", label).drop("_max")


def occupation_rank(df: DataFrame) -> DataFrame:
    """Rank of the bin among the bins that occur, the highest first."""
    best_first = Window.orderBy(F.desc("occupation_bin"))
    # at most one row per bin
    ranks = (
        df.where(F.col("occupation_bin").isNotNull())
        .select("occupation_bin")
        .distinct()
        .withColumn("occupation_rank", F.row_number().over(best_first))
    )
    return df.join(F.broadcast(ranks), "occupation_bin", "left").select(*df.columns, "occupation_rank")


def feature_thresholds(df: DataFrame) -> DataFrame:
    """(metric, kind, threshold): a high quantile of counts, a low one of distances.

    Reads `df` once.
    """
    kinds = dict.fromkeys(distance_columns(df), fixed.DISTANCE_QUANTILE)
    kinds |= dict.fromkeys(columns_ending(df, "_count"), fixed.COUNT_QUANTILE)
    readings = ", ".join(
        f"struct('{metric}' as metric, cast(`{metric}` as double) as value, {probability}D as probability)"
        for metric, probability in kinds.items()
    )
    long = df.selectExpr(f"inline(array({readings}))")
    kind = F.when(F.col("metric").endswith("_count"), "count").otherwise("distance")
    return linear_quantiles(long, "metric", "value", "probability").select(
        "metric", kind.alias("kind"), F.col("quantile").alias("threshold")
    )


def feature_score(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """`good_feature_score` from 0 to 10: the share of thresholds met, plus two flags.

    The thresholds are one row per feature column; they become constants of the expression.
    Missing values meet no threshold, missing flags are 0.
    """
    limits = thresholds.collect()
    tests = [
        f"`{row.metric}` {'>=' if row.kind == 'count' else '<='} {row.threshold!r}D"
        for row in limits
        if row.threshold is not None
    ]
    met = [f"if({test}, 1, 0)" for test in tests]
    flags = [f"coalesce(cast({name} as int), 0)" for name in fixed.SCORE_FLAGS if name in df.columns]
    most = len(limits) + len(fixed.SCORE_FLAGS)
    share = f"({' + '.join(['0', *met, *flags])}) / {float(most)!r}D"
    return df.withColumn("good_feature_score", F.expr(f"greatest(0D, least({share} * 10, 10D))"))


def performance_rank(df: DataFrame, column: str = "percentage_average") -> DataFrame:
    """`score_performance`: 1 for the highest value; equal values share the larger number.

    Rows without a value get NULL. Reads `df` several times: write it first if it is costly.
    """
    positions = running_counts(df.select(column), column).select(column, "n_before")
    rows = df.count()
    # there are no more positions than rows
    ranked = lookup_pairs(df.where(F.col(column).isNotNull()), positions, [column], right_rows=rows)
    scored = ranked.withColumn("score_performance", F.lit(rows) - F.col("n_before"))
    unknown = df.where(F.col(column).isNull()).withColumn("score_performance", F.lit(None).cast("bigint"))
    columns = [*df.columns, "score_performance"]
    return scored.select(*columns).unionByName(unknown.select(*columns))
