"""Mixing sources to target weights by systematic sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltscape.functions.staging import stage
from voltscape.llm.common import WORD, attach

#: Copies are counted in units of 1e-9, so every sum is an exact integer.
UNIT = 1_000_000_000
#: Rows that one sorted bucket should hold.
BUCKET_ROWS = 20_000

_SIZE = f"coalesce(regexp_count(text, r'{WORD}'), 0L)"
#: Sizes below 16 are a class each; above, an octave is cut into eight.
_CLASS = (
    "if(_size < 16, _size, length(bin(_size)) * 16 + shiftright(_size, length(bin(_size)) - 4))"
)


def _hash32(text: str) -> str:
    return f"cast(conv(substring(md5({text}), 1, 8), 16, 10) as bigint)"


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_repeat: int = 3
) -> DataFrame:
    """(source, source_size, target, _index) from rows (source, _size).

    Sources by code point, NULL last, take the weights in turn. Together they get `share` of all
    sizes; a target stops at `max_repeat` times its source's size and the excess is shared among
    the others by weight until none is above. That is the level at which the capped targets add up
    to the total: with sources in order of cap / weight, the largest of
    (total - caps so far) / (weights from here on). The windows run over one row per source.
    """
    listed = "array(" + ", ".join(f"{w}L" for w in weights) + ")"
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ordered = (
        sizes.groupBy("source")
        .agg(F.sum("_size").alias("source_size"))
        .withColumn("_index", F.row_number().over(by_name))
        .withColumn("_weight", F.expr(f"element_at({listed}, cast((_index - 1) % {len(weights)} + 1 as int))"))
        .withColumn("_cap", F.col("source_size") * max_repeat)
    )
    by_ratio = Window.orderBy(F.expr("_cap / _weight"), "_index")
    earlier, later = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    stepped = ordered.withColumn(
        "_step",
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0)))
        / F.sum("_weight").over(later),
    )
    return stepped.withColumn("_level", F.max("_step").over(everything)).selectExpr(
        "source", "source_size", "least(_weight * _level, cast(_cap as double)) as target", "_index"
    )


def planned(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    share: float = 1.0,
    max_repeat: int = 3,
    seed: int = 0,
    carry: list[str] | None = None,
) -> DataFrame:
    """All rows of `docs` (doc_id, text, source, any more), with all columns or those of
    `carry`, and size, source_size, target and copies: how often the mix takes the row.

    Systematic sampling: a row of a source is expected target / source_size times. Expected
    copies are summed over the source in order of size class and a hash of doc_id, one random
    offset per source is added, and a row is taken once for each whole number its stretch of the
    running sum crosses. In size order the taken words miss a target by little more than the
    spread of sizes within a class, and no row is taken over `max_repeat` times.

    The running sum has two levels: (source, class, stretch of hash values) buckets are counted
    first and summed by windows over these counts; rows are summed inside their bucket only. The
    number of buckets follows the rows, so a hot source or a hot size is cut into many tasks.

    NULL and empty texts have size 0 and are sampled like others; a source of size 0 has target
    0 and is not taken; NULL is a source of its own; repeated rows are rows of their own, placed
    next to each other; rows alike in every ordering column are interchangeable. An empty table
    gives an empty result. Columns of `docs` named like a result column are replaced.
    """
    kept = [c for c in carry or docs.columns if c.lower() not in ("size", "source_size", "target", "copies")]
    hashed = _hash32(f"concat('{seed}:', coalesce(cast(doc_id as string), ''))")
    # the row travels as one struct, so its column names meet no others
    packed = docs.select(F.struct(*kept).alias("_row"), "doc_id", "source", F.expr(_SIZE).alias("_size"))
    drawn = packed.withColumn("_draw", F.expr(hashed))
    keys = stage(drawn.select("source", "_size", "_draw"), "mix-keys")
    targets = stage(
        source_targets(keys, weights, share, max_repeat).selectExpr(
            "*",
            f"coalesce(cast(floor(least(target / nullif(source_size, 0), {max_repeat}D) * {UNIT}) as bigint), 0L) as _each",
            f"({_hash32(f"concat('{seed}/', coalesce(source, ''))")} * {UNIT}) div 4294967296L as _offset",
        ),
        "mix-targets",
    )
    buckets = max(1, -(-keys.count() // BUCKET_ROWS))
    place = ["_index", "_class", "_bucket"]

    def placed(df: DataFrame) -> DataFrame:
        # NULL is a source too, so the key is its index
        known = attach(
            df.withColumn("_named", F.expr("struct(source)")), targets.withColumn("_named", F.expr("struct(source)")).drop("source"), ["_named"]
        ).drop("_named")
        return known.withColumns({"_class": F.expr(_CLASS), "_bucket": F.expr(f"(_draw * {buckets}L) div 4294967296L")})

    counts = placed(keys).groupBy(*place).agg(F.sum(F.expr("cast(_each as decimal(20, 0))")).alias("_sum"))
    zero = F.expr("cast(0 as decimal(38, 0))")
    before = Window.partitionBy("_index", "_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    classes = Window.partitionBy("_index").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    of_class = (
        counts.groupBy("_index", "_class")
        .agg(F.sum("_sum").alias("_all"))
        .select("_index", "_class", F.coalesce(F.sum("_all").over(classes), zero).alias("_start"))
    )
    starts = (
        counts.withColumn("_inner", F.coalesce(F.sum("_sum").over(before), zero))
        .join(of_class, ["_index", "_class"])
        .select(*place, F.expr("cast(_start + _inner as decimal(38, 0))").alias("_start"))
    )
    inside = Window.partitionBy(*place).orderBy("_draw", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        placed(drawn)
        .withColumn("_run", F.coalesce(F.sum(F.expr("cast(_each as decimal(20, 0))")).over(inside), zero))
        .join(starts, place)
        .withColumn("_from", F.expr("cast(_start + _run + _offset as decimal(38, 0))"))
    )
    crossed = f"((_from + _each) div {UNIT}) - (_from div {UNIT})"
    return summed.selectExpr("_row.*", "_size as size", "source_size", "target", f"cast({crossed} as bigint) as copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row of `docs` once per copy, with `copy` counting from 1."""
    kept = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies", "copy")]
    taken = planned(docs.select(*kept), **options).where("copies > 0")
    return taken.select(*kept, F.expr("explode(sequence(1, cast(copies as int)))").alias("copy"))
