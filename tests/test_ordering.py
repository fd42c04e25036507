"""Ranks, quantiles and exact cuts against pandas."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltscape.functions.ordering import linear_quantiles, running_counts
from voltscape.operators import quality, scoring, split


def values(seed, n):
    rng = random.Random(seed)
    # a third of all rows hold one value
    return [0.25 if rng.random() < 0.34 else round(rng.gauss(0, 1), 2) for _ in range(n)]


@pytest.mark.parametrize("ranges", [None, 2, 7, 64])
def test_running_counts(spark, ranges):
    data = values(1, 500)
    frame = spark.createDataFrame([(v,) for v in [*data, None]], "v double")
    got = {r.v: (r.n, r.n_before) for r in running_counts(frame, "v", ranges=ranges).collect()}
    assert got == {v: (data.count(v), sum(x < v for x in data)) for v in set(data)}


def test_running_counts_of_nothing(spark):
    assert running_counts(spark.createDataFrame([], "v double"), "v").count() == 0


@pytest.mark.parametrize("n", [1, 2, 11, 200])
def test_quantiles_equal_pandas(spark, n):
    groups = {"a": (values(2, n), 0.7), "b": (values(3, n), 0.3), "c": ([None, *values(4, n)], 0.5)}
    rows = [(g, v, p) for g, (data, p) in groups.items() for v in data]
    frame = spark.createDataFrame(rows, "g string, v double, p double")
    got = {r.g: r.quantile for r in linear_quantiles(frame, "g", "v", "p").collect()}
    assert got == pytest.approx({g: pd.Series(data, dtype=float).quantile(p) for g, (data, p) in groups.items()})


def test_performance_rank_equals_pandas(spark):
    data = values(5, 300)
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id bigint, percentage_average double")
    got = {r.id: r.score_performance for r in scoring.performance_rank(frame).collect()}
    series = pd.Series(data)
    assert [got[i] for i in range(300)] == list(len(data) - series.rank(method="min").astype(int) + 1)


def test_performance_rank_ties_and_missing(spark):
    frame = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 5.0), (4, 1.0), (5, None)], "id bigint, percentage_average double")
    got = {r.id: r.score_performance for r in scoring.performance_rank(frame).collect()}
    assert got == {1: 4, 2: 4, 3: 2, 4: 5, 5: None}


def test_bins_equal_pandas_cut(spark):
    rng = random.Random(7)
    data = [0.0, 3.7, -1.0, *(3.7 / 10 * i for i in range(1, 10)), *(rng.uniform(0, 3.7) for _ in range(200))]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)] + [(-1, None)], "id bigint, percentage_average double")
    rows = {r.id: r for r in scoring.occupation_rank(scoring.occupation_bins(frame)).collect()}
    import numpy as np

    wanted = pd.cut(pd.Series(data), bins=np.linspace(0, max(data), 11), labels=False)
    got = [rows[i].occupation_bin for i in range(len(data))]
    assert got == [None if pd.isna(w) else int(w) + 1 for w in wanted]
    assert rows[-1].occupation_bin is None and rows[0].occupation_rate is None
    assert rows[1].occupation_bin == 10 and rows[1].occupation_rank == 1 and rows[1].occupation_high == 3.7


def test_bin_rank_skips_empty_bins(spark):
    frame = spark.createDataFrame([(1, 10.0), (2, 0.5), (3, 0.4)], "id bigint, percentage_average double")
    rows = {r.id: r.occupation_rank for r in scoring.occupation_rank(scoring.occupation_bins(frame)).collect()}
    assert rows == {1: 1, 2: 2, 3: 2}


def test_score(spark):
    frame = spark.createDataFrame(
        [(1, 0, 100.0, 1), (2, 5, 400.0, 0), (3, 10, None, None)], "id bigint, a_count bigint, a_dist double, is_motorway int"
    )
    limits = scoring.feature_thresholds(frame)
    assert {r.metric: (r.kind, r.threshold) for r in limits.collect()} == {
        "a_count": ("count", pytest.approx(7.0)), "a_dist": ("distance", pytest.approx(190.0))
    }
    scores = {r.id: r.good_feature_score for r in scoring.feature_score(frame, limits).collect()}
    assert scores == {1: 5.0, 2: 0.0, 3: pytest.approx(2.5)}


@pytest.mark.parametrize("n", [0, 1, 30, 99, 100])
def test_marked_rows_are_exact_and_whole(spark, n):
    # a third of the rows are copies of one row, so the cut falls into copies
    frame = spark.createDataFrame([(0 if i % 3 else i, i % 3) for i in range(100)], "id bigint, x int").withColumn("o", F.col("id") % 7)
    frame = frame.union(spark.createDataFrame([(1, 1, None)] * 4, "id bigint, x int, o bigint"))
    marked = split.marked_first(frame, n, "o", "m")
    first, rest = marked.where("m").drop("m"), marked.where("not m").drop("m")
    assert (first.count(), rest.count()) == (n, 104 - n)
    assert sorted(map(str, first.unionAll(rest).collect())) == sorted(map(str, frame.collect()))
    assert not first.where("o is null").count()
    if 0 < n < 100:
        assert first.agg(F.max("o")).first()[0] <= rest.agg(F.min("o")).first()[0]
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_marked_rows_need_enough(spark):
    with pytest.raises(ValueError):
        split.marked_first(spark.range(3).withColumn("o", F.col("id")), 4, "o", "m")


def test_repeated_rows_in_chunks(spark):
    frame = spark.createDataFrame([("a", 7), ("b", 0), ("c", 3)], "x string, n bigint")
    got = [r.x for r in split._repeated(frame, F.col("n"), ["x"], chunk=3).collect()]
    assert sorted(got) == ["a"] * 7 + ["c"] * 3


def test_split_sizes_and_reproducible(spark):
    frame = spark.range(400).selectExpr("id", "case id % 3 when 0 then 'Uno-X' when 1 then 'UNO charge' end as operator")
    once = split.split_assign(frame, frame)
    counts = {r.split: r["count"] for r in once.groupBy("split").count().collect()}
    assert counts == {"test": 56, "validation": 60, "train": 284}
    assert once.where("split = 'test' and operator is null").count() == 0
    assert once.select("id").distinct().count() == 400
    again = split.split_assign(frame.repartition(7), frame.repartition(3))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    other = split.split_assign(frame, frame, seed=7)
    assert sorted(map(tuple, once.collect())) != sorted(map(tuple, other.collect()))


def test_split_needs_enough_candidates(spark):
    frame = spark.range(10).selectExpr("id", "'uno' as operator")
    with pytest.raises(ValueError):
        split.split_assign(frame, frame)


def test_operator_match(spark):
    frame = spark.createDataFrame([(1, "Uno-X"), (2, "sUNOco"), (3, "Mer"), (4, None)], "id int, operator string")
    assert sorted(r.id for r in split.operator_matches(frame).collect()) == [1, 2]


def test_quality_report(spark):
    frame = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (2, None, 4.0)], "id bigint, kind string, d double")
    report = {(r.check, r.item): r.value for r in quality.quality_report(frame, ["kind"], ["d"]).collect()}
    assert report[("ids", "rows")] == 3 and report[("ids", "ids")] == 2 and report[("ids", "repeats")] == 1
    assert report[("kind", "a")] == 2 and report[("kind", None)] == 1
    assert report[("d", "50%")] == 2.0 and report[("d", "25%")] == 1.5 and report[("d", "std")] == pytest.approx(pd.Series([1, 2, 4]).std())
    assert quality.unmatched_distances(["a_dist", "a_count", "b_dist"]) == ["b_count"]
    assert [r.id for r in quality.sample_rows(frame, ["d", "none"], 2).collect()] == [1, 1]
