"""SimHash near-duplicates by a grid join over popcounts of segments."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape.functions.staging import stage
from voltscape.llm.common import attach, components, map_rows

SEED = 42
BITS = 64
#: Segments of two bits: a fingerprint is a point with 32 coordinates from 0 to 2.
SEGMENTS = 32
#: Two random segments have the same popcount with this probability.
SAME = 0.375
#: Chance candidates a fingerprint may meet before cells are made finer.
CHANCE = 16
#: Fingerprints of one cell that one task compares; fuller cells are cut into pairs of blocks.
CELL_ROWS = 20_000
_LOW = 0x5555555555555555


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority of the bits of the XXH64 of all shingles; lower-cases A-Z; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    hashed = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, len(shingles))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashed), 65_536):
        block = hashed[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashed)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long, and the SQL expressions in `more`."""
    rows = docs.selectExpr("doc_id", "cast(coalesce(text, '') as binary) as text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        return {"doc_id": batch["doc_id"], "fp": [fingerprint(text, shingle) for text in batch["text"]]}

    if not more:
        return map_rows(rows, f"doc_id {kind}, fp long", kernel)
    extra = rows.selectExpr("doc_id", "text", *more)
    names = [c for c in extra.columns if c not in ("doc_id", "text")]
    fields = ", ".join(f"{c} {extra.schema[c].dataType.simpleString()}" for c in names)
    return map_rows(
        extra, f"doc_id {kind}, fp long, {fields}", lambda b: kernel(b) | {c: b[c] for c in names}
    )


def _popcounts(fp: str) -> str:
    """All segment popcounts in one word: field i holds 0, 1 or 2."""
    moved = f"shiftrightunsigned({fp}, 1)"
    return f"(shiftleft({fp} & {moved} & {_LOW}L, 1) | (({fp} ^ {moved}) & {_LOW}L))"


def groups_for(rows: int, distance: int) -> int:
    """Groups of coordinates: as few as keep the chance candidates per fingerprint low."""
    for groups in range(distance + 2, 2 * distance + 3):
        fixed = groups - distance
        if comb(groups, fixed) * rows * SAME ** (SEGMENTS * fixed / groups) <= CHANCE:
            return groups
    return 2 * distance + 2


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def cell_masks(groups: int, distance: int) -> list[int]:
    """The coordinates that each grid keeps, as bit masks."""
    bounds = [SEGMENTS * i // groups for i in range(groups + 1)]
    parts = [sum(3 << (2 * s) for s in range(lo, hi)) for lo, hi in zip(bounds, bounds[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(parts, groups - distance)]


def _close(fps: np.ndarray, counts: np.ndarray, others: np.ndarray, other_counts: np.ndarray, distance: int) -> np.ndarray:
    """Manhattan distance of the popcounts first, exact bit distance for what passes."""
    # fields differ by 0, 1 or 2: |a - b| is 1 where the low bits differ, else 2 where the high ones do
    apart = counts ^ other_counts
    odd, even = apart & np.uint64(_LOW), (apart >> np.uint64(1)) & np.uint64(_LOW)
    bound = np.bitwise_count(odd) + 2 * np.bitwise_count(even & ~odd)
    passed = bound <= distance
    passed[passed] = np.bitwise_count(fps[passed] ^ others[passed]) <= distance
    return passed


def linked(fps: np.ndarray, counts: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Positions of links that connect all that is connected within one cell: a breadth-first
    forest, so at most one link per fingerprint however full the cell is."""
    found, open_ = [], np.arange(len(fps))
    while len(open_) > 1:
        queue, open_ = [open_[0]], open_[1:]
        while queue and len(open_):
            at = queue.pop()
            near = _close(fps[open_], counts[open_], np.broadcast_to(fps[at], len(open_)), np.broadcast_to(counts[at], len(open_)), distance)
            hits = open_[near]
            found += [(int(at), int(x)) for x in hits]
            queue += list(hits)
            open_ = open_[~near]
    return found


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b) links between distinct fingerprints `fp` that differ in at most `distance` bits;
    not all pairs, but all that is connected by pairs is connected by these.

    Each fingerprint becomes the point of its segment popcounts. The Manhattan distance of two
    points is never above the bit distance, so partners lie within `distance` of each other; then
    at most `distance` of the coordinate groups differ, and the two share a cell of at least one
    grid over the other groups. A row per grid is dealt out by cell and compared inside the cell:
    first the Manhattan distance, then all bits. The number of groups follows the number of
    fingerprints; the links don't depend on it. Cells fuller than CELL_ROWS are cut into blocks,
    and each pair of blocks is compared in a task of its own.
    """
    masks = cell_masks(groups_for(fps.count(), distance), distance)
    grids = ", ".join(f"named_struct('grid', {i}, 'cell', _point & {mask}L)" for i, mask in enumerate(masks))
    cells = fps.selectExpr("fp", f"{_popcounts('fp')} as _point").selectExpr("fp", "_point", f"inline(array({grids}))")
    full = stage(
        cells.groupBy("grid", "cell").count().where(f"count > {CELL_ROWS}").selectExpr(
            "grid", "cell", f"cast(ceil(count / {CELL_ROWS}) as int) as _blocks"
        ),
        "full-cells",
    )
    cut = attach(cells, full, ["grid", "cell"], "left").selectExpr(
        "*", "if(_blocks is null, 0, cast(pmod(xxhash64(fp), _blocks) as int)) as _own"
    )
    dealt = cut.selectExpr("fp", "_point", "grid", "cell", "_own", "explode(sequence(0, coalesce(_blocks, 1) - 1)) as _other")
    dealt = dealt.selectExpr(
        "fp", "_point", "xxhash64(grid, cell, least(_own, _other), greatest(_own, _other)) as _task"
    ).repartition("_task")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        task = rows["_task"].to_numpy()
        order = np.argsort(task, kind="stable")
        task = task[order]
        own = rows["fp"].to_numpy()[order].view(np.uint64)
        points = rows["_point"].to_numpy()[order].view(np.uint64)
        start = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
        sizes = np.diff(np.r_[start, len(task)])
        a, b = [], []
        last = np.repeat(start + sizes, sizes)
        small = np.repeat(sizes <= 64, sizes)
        for step in range(1, 64):
            left = np.flatnonzero(small & (np.arange(len(task)) + step < last))
            if not len(left):
                break
            right = left + step
            near = _close(own[left], points[left], own[right], points[right], distance)
            a.append(own[left[near]])
            b.append(own[right[near]])
        for at, size in zip(start[sizes > 64], sizes[sizes > 64]):
            pairs = np.array(linked(own[at : at + size], points[at : at + size], distance), int).reshape(-1, 2) + at
            a.append(own[pairs[:, 0]])
            b.append(own[pairs[:, 1]])
        if a:
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def clusters(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, root): for every distinct fingerprint the smallest one it is linked with."""
    distinct = stage(fps.select("fp").distinct(), "fingerprints")
    roots = components(links(distinct, distance), "a", "b")
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").selectExpr("fp", "coalesce(root, fp) as root")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of `docs` (doc_id, text, any more).

    fingerprint is 16 lowercase hex digits; component_id is the smallest doc_id reachable over
    links of at most `distance` differing bits, the row's own included. Copies share a
    fingerprint and are compared once. NULL and empty texts, and texts without a word, have
    fingerprint 0 and are linked like others. Rows with a NULL doc_id take part; a component of
    such rows alone has component_id NULL. Repeated rows come out repeated; an empty table gives
    an empty result; other columns are ignored.
    """
    marked = stage(fingerprints(docs, shingle), "marked")
    ids = marked.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    of_fp = stage(clusters(marked, distance).join(ids, "fp"), "clusters")
    of_root = of_fp.groupBy("root").agg(F.min("_least").alias("component_id"))
    of_fp = of_fp.join(of_root, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) as fingerprint", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the smallest
    doc_id stays (NULL after all others; of repeated ids the text with the smallest hash, and one
    row of equal ones). All columns are kept."""
    ranked = "struct(doc_id is null as _none, doc_id as _id, _text as _text)"
    marked = stage(fingerprints(docs, shingle, ("xxhash64(text) as _text",)).distinct(), "marked")
    best = marked.groupBy("fp").agg(F.min(F.expr(ranked)).alias("_best"))
    of_fp = clusters(marked, distance).join(best, "fp")
    keep = of_fp.groupBy("root").agg(F.min("_best").alias("_best")).selectExpr("_best._id as _id", "_best._text as _text")
    packed = docs.select(
        F.struct("*").alias("_row"), "doc_id", F.expr("xxhash64(cast(coalesce(text, '') as binary)) as _text")
    )
    kept = packed.join(keep.withColumnRenamed("_text", "_same"), F.expr("doc_id <=> _id and _text = _same"), "left_semi")
    # rows equal in id and text are copies too
    return kept.dropDuplicates(["doc_id", "_text"]).select("_row.*")
