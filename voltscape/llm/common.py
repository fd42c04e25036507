"""Small helpers the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltscape.functions.joins import BROADCAST_ROWS
from voltscape.functions.staging import stage

#: A word is a run of anything but space, tab, newline, vertical tab, form feed, carriage return:
#: what `bytes.split()` splits at.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch that a kernel gets at a time.
PIECE_BYTES = 4 << 20


def map_rows(
    df: DataFrame, schema: str, kernel: Callable[[dict[str, list]], dict[str, list]], piece: int = PIECE_BYTES
) -> DataFrame:
    """`kernel` turns columns (lists) of some rows into columns of the result. It gets about
    `piece` bytes at a time, one row at least, so that neither side of it is large."""
    wanted = StructType.fromDDL(schema)
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, batch.num_rows * piece // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                found = kernel({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_pydict(found, schema=arrow)

    return df.mapInArrow(run, wanted)


#: Bytes of text in a table that is broadcast.
BROADCAST_BYTES = 64 << 20


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a written table of one row per key: broadcast when its counted rows and the bytes of
    their texts allow it, else by a shuffle, where adaptive execution splits hot keys."""
    texts = [f.name for f in small.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    size = " + ".join(f"coalesce(octet_length(`{name}`), 0)" for name in texts) or "0"
    rows, held = small.agg(F.count(F.lit(1)), F.expr(f"sum(cast({size} as bigint))")).first()
    fits = rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES
    return big.join(F.broadcast(small) if fits else small, on, how)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge.

    Alternating large-star and small-star steps; each step's edges are written to the shared
    folder, so lineage stays short and nothing is collected but two numbers a step. A step
    groups by plain minimum (partial sums first) and joins it back, so a hub is split like any
    skewed join. No edges give no rows; loops and NULL ends are ignored.
    """
    found = stage(edges.where(F.col(a) != F.col(b)).selectExpr(f"{a} as u", f"{b} as v").distinct(), "edges")
    before = None
    while True:
        both = found.union(found.selectExpr("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.where("v > u").join(least, "u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        down = stage(large.selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "edges")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u").where("v <> m").selectExpr("v as u", "m as v").union(least.selectExpr("u", "m as v"))
        )
        found = stage(small.where("u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").distinct(), "edges")
        now = found.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == before:
            break
        before = now
    # every edge now leads from a node to its root
    return found.selectExpr("u as node", "v as root").union(found.selectExpr("v as node", "v as root").distinct())
