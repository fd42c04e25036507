"""Reproducible train / validation / test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltscape import fixed_values as fixed
from voltscape.functions.ordering import running_counts
from voltscape.functions.staging import stage


def operator_matches(df: DataFrame, pattern: str = fixed.OPERATOR_PATTERN) -> DataFrame:
    """Rows whose operator contains the text, in any case; NULL does not match."""
    return df.where(F.coalesce(F.col("operator").ilike(pattern), F.lit(False)))


def sample_ids(df: DataFrame, n: int, order: Column) -> DataFrame:
    """Exactly `n` different ids, first by `order`; an error if there are fewer."""
    ids = df.select("id").distinct()
    drawn = ids.orderBy(order, "id").limit(n)
    if drawn.count() < n:
        raise ValueError(f"fewer than {n} ids to sample from")
    return drawn


def marked_first(df: DataFrame, n: int, order: str, mark: str) -> DataFrame:
    """`df` with `mark`: whether a row is among the first `n` by the `order` column.

    The number of rows per `order` value gives the value at which the cut falls, and the number of
    rows per hash of the row gives the place among the rows with that value: two comparisons
    decide all rows but those with this value and hash. These are equal rows (of different rows
    with one hash there are hardly any); they are counted and split by number. Reads `df`
    several times: write it first if it is costly. Fails if there are fewer than `n` rows.
    """
    if n <= 0:
        return df.withColumn(mark, F.lit(False))
    at = _cut(df, order, n)
    if at is None:
        raise ValueError(f"fewer than {n} rows")
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    key, value = F.col(order), F.lit(at[order])
    still = n - at["n_before"]
    among = _cut(hashed.where(key == value).select("_hash"), "_hash", still)
    spot, left = F.lit(among["_hash"]), still - among["n_before"]
    undecided = (key == value) & (F.col("_hash") == spot)
    clear = hashed.where(~F.coalesce(undecided, F.lit(False))).withColumn(
        mark, F.coalesce((key < value) | ((key == value) & (F.col("_hash") < spot)), F.lit(False))
    )
    # one row for each content with this hash
    by_content = Window.partitionBy("_hash").orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        hashed.where(undecided)
        .groupBy("_hash", *df.columns)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(by_content), F.lit(0)))
        .withColumn("_in", F.least(F.greatest(F.lit(left) - F.col("_before"), F.lit(0)), F.col("_rows")))
    )
    columns = [*df.columns, mark]
    inside = _repeated(counted.withColumn(mark, F.lit(True)), F.col("_in"), columns)
    outside = _repeated(counted.withColumn(mark, F.lit(False)), F.col("_rows") - F.col("_in"), columns)
    return clear.select(*columns).unionByName(inside).unionByName(outside)


def _cut(df: DataFrame, column: str, n: int):
    """The value of `column` at which the first `n` rows end, and its counts."""
    found = running_counts(df.select(column), column)
    return found.where((F.col("n_before") < n) & (F.col("n_before") + F.col("n") >= n)).first()


def _repeated(df: DataFrame, times: Column, columns: list[str], chunk: int = 10_000) -> DataFrame:
    """Each row `times` times, in two steps so that no array grows with the number of copies."""
    chunks = df.withColumn("_times", times).where(F.col("_times") > 0)
    last = F.ceil(F.col("_times") / F.lit(chunk)).cast("bigint") - 1
    starts = chunks.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.lit(chunk), F.col("_times") - F.col("_chunk") * chunk).cast("int")
    return starts.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).select(*columns)


def split_assign(
    df: DataFrame,
    candidates: DataFrame,
    test_stations: int = fixed.TEST_STATIONS,
    validation_share: float = fixed.VALIDATION_SHARE,
    seed: int = 42,
    order: Column | None = None,
) -> DataFrame:
    """Add `split`: all rows of `test_stations` matching stations are test rows, a share of
    all rows, drawn from the others, is validation, and what is left is train.

    Stations are drawn by a hash of the id and the seed, rows by a hash of the whole row, so
    that the rows of one id are drawn apart; a given `order` decides both instead.
    """
    by_id = F.xxhash64(F.col("id"), F.lit(seed)) if order is None else order
    by_row = F.xxhash64(*map(F.col, df.columns), F.lit(seed)) if order is None else order
    test_ids = sample_ids(operator_matches(candidates), test_stations, by_id)
    # as many rows as asked for at most, so a bounded broadcast
    test_ids = F.broadcast(test_ids)
    named = test_ids.select("id", F.lit(True).alias("_test"))
    marked = df.join(named, "id", "left").select(*df.columns, F.coalesce("_test", F.lit(False)).alias("_test"))
    keyed = stage(marked.withColumn("_order", F.when(~F.col("_test"), by_row)), "split")
    # test rows have no order, so they are never among the first
    drawn = marked_first(keyed, int(validation_share * keyed.count()), "_order", "_drawn")
    part = F.when(F.col("_test"), "test").when(F.col("_drawn"), "validation").otherwise("train")
    return drawn.select(*df.columns, part.alias("split"))
