"""Joins that hold up when one side is large and one key is hot."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape.functions.staging import stage

# a broadcast of this many narrow rows stays well under 100 MB
BROADCAST_ROWS = 500_000
# rows and pairs of one key that a single join task should handle
ROWS_PER_TASK = 50_000
PAIRS_PER_TASK = 5_000_000
# narrow rows, of many keys, that are moved to one task
ROWS_MOVED_PER_TASK = 200_000
# the same for a fact joined with one dimension row per key
FACT_ROWS_PER_TASK = 5_000_000
#: Column that names the part of a key that rows are in.
PART = "_part"


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `max_rows` rows (a plain count, so no single task sees them)."""
    return df.count() <= max_rows


def dealt(df: DataFrame, weight: str = "1", per_task: int = ROWS_PER_TASK) -> DataFrame:
    """`df` over as many tasks as the sum of `weight` asks for, whatever files it comes from.

    For rows that grow when they are read or unrolled: a small file is one task, and its size says
    nothing about the work that follows.
    """
    total = df.agg(F.sum(F.expr(weight).cast("double")).alias("n")).collect()[0].n or 0
    return df.repartition(ceil(total / per_task)) if total > per_task else df


def lookup_join(
    big: DataFrame, small: DataFrame, on: list[str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Inner join of a big side with a dimension: broadcast if small, else spread."""
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), on)
    return spread_join(big, small, on, rows_per_task=FACT_ROWS_PER_TASK)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Inner equi-join that splits hot keys over several tasks.

    A key with too many rows on one side, or too many pairs, is cut into left parts x right
    parts, in the proportion that repeats the fewest rows. A row's part follows from a hash of
    its values, so a re-run task places it alike; the other side is repeated once per part.
    A hot key has more than rows_per_task, or more than sqrt(pairs_per_task), rows, which
    bounds the table of hot keys that is broadcast.
    Neither side is broadcast by its estimated size: that is the size of its files, which does not
    count the rows unrolled from them.
    Exact copies of a row share a part: remove or count them first where they matter.
    """
    hot = _parts(_sizes(left, right, on).where(_hot(rows_per_task, pairs_per_task)), on, rows_per_task, pairs_per_task)
    lefts = _placed(left, hot, on, "_l", "_r", left.columns)
    rights = _placed(right, hot, on, "_r", "_l", right.columns)
    return lefts.join(rights.hint("merge"), [*on, "_l", "_r"]).drop("_l", "_r")


def _sizes(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """The keys of both sides, with the rows of each."""
    lefts, rights = (
        df.groupBy(*on).agg(F.count(F.lit(1)).cast("double").alias(name)) for df, name in ((left, "_l"), (right, "_r"))
    )
    return lefts.join(rights, on)


def _hot(rows_per_task: int, pairs_per_task: int) -> str:
    return f"_l > {rows_per_task} or _r > {rows_per_task} or _l * _r > {pairs_per_task}"


def _parts(sizes: DataFrame, on: list[str], rows_per_task: int, pairs_per_task: int) -> DataFrame:
    """Into how many parts the sides of each key are cut."""
    wanted = f"greatest(ceil(_l * _r / {pairs_per_task}), 1)"
    return (
        sizes.selectExpr(*on, "_l", "_r", f"{wanted} as _parts")
        .selectExpr(
            *on, "_r", "_parts", f"cast(greatest(ceil(_l / {rows_per_task}), ceil(sqrt(_parts * _l / _r))) as int) as _lparts"
        )
        .selectExpr(
            *on, "_lparts", f"cast(greatest(ceil(_r / {rows_per_task}), ceil(_parts / _lparts)) as int) as _rparts"
        )
    )


def _placed(
    df: DataFrame, parts: DataFrame, on: list[str], own: str, other: str, hashed: list[str], how: str = "left"
) -> DataFrame:
    """Rows with the part of their own side, repeated for each part of the other."""
    marked = df.withColumn("_hash", F.xxhash64(*hashed)).join(F.broadcast(parts), on, how)
    return marked.selectExpr(
        *df.columns,
        f"cast(pmod(_hash, coalesce({own}parts, 1)) as int) as {own}",
        f"explode(sequence(0, coalesce({other}parts, 1) - 1)) as {other}",
    )


def spread_sides(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    together: list[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> tuple[DataFrame, DataFrame]:
    """Both sides with PART in place of the key, and placed by it: rows of one key meet in one part, or
    in several if it is hot, as in `spread_join`.

    The join by PART moves no row again, nor does grouping its rows by PART and more. Right rows of a
    key that agree on `together` are in one part as a left row sees it, so what is counted of them
    part by part adds up.
    """
    counted = stage(_sizes(left, right, on), "sizes")
    known = counted.agg(
        F.count(F.lit(1)).alias("keys"), *(F.sum(F.expr(x)).alias(n) for n, x in (("l", "_l"), ("r", "_r"), ("pairs", "_l * _r")))
    ).collect()[0]
    # few keys: rows of all others are dropped before they move
    few = known["keys"] <= BROADCAST_ROWS
    kept = counted if few else counted.where(_hot(rows_per_task, pairs_per_task))
    parts, how = _parts(kept, on, rows_per_task, pairs_per_task), "inner" if few else "left"
    wanted = max(((known.l or 0) + (known.r or 0)) / ROWS_MOVED_PER_TASK, (known.pairs or 0) / pairs_per_task)
    tasks = max(ceil(wanted), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def side(df: DataFrame, own: str, other: str, hashed: list[str]) -> DataFrame:
        rows = _placed(df, parts, on, own, other, hashed, how).withColumn(PART, F.xxhash64(*on, "_l", "_r"))
        return rows.drop(*on, "_l", "_r").repartition(tasks, PART)

    return side(left, "_l", "_r", left.columns), side(right, "_r", "_l", together or right.columns)


def lookup_pairs(left: DataFrame, right: DataFrame, on: list[str], right_rows: int) -> DataFrame:
    """Inner equi-join whose right side has few rows per key, whatever the left side holds.

    A right side known to have at most BROADCAST_ROWS rows is broadcast. Beyond that both sides
    are shuffled, and adaptive execution cuts the partitions of hot left keys, repeating only
    the right rows that go with them.
    """
    return left.join(F.broadcast(right) if right_rows <= BROADCAST_ROWS else right, on)
