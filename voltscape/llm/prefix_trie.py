"""Prefix trie of conversations, as balanced parentheses per shard of the sorted conversations.

A conversation is the path of its turns' digests. Paths in order give the trie in preorder: each
closes the nodes it does not share with the one before and opens its own. The parentheses of all
shards, one after another, are those of the whole trie: a shard knows how many nodes were open
before it and how many stay open after it. Such nodes, the spines, are the only ones that several
shards tell of, and they are merged by key. Every subtree is a stretch of parentheses, so its
totals are differences of cumulative arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltscape.functions.staging import stage
from voltscape.llm.common import attach

#: Bytes of a turn's digest in a path.
WIDTH = 16
#: Nodes of one shard, about.
SHARD_NODES = 200_000
#: Parentheses of one block of the range min-max index.
BLOCK = 64
#: Conversation ids of one row while the members of a path are listed, as a power of two.
CHUNK_BITS = 12
#: Turns a conversation may take over from the first of its hundred, less one.
SHARED_TURNS = 6

NO_ENDS = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max
#: What is summed over a subtree: conversations, characters of their turns, characters of nodes, leaves.
SUMS = ("convs", "spoken", "held", "leaves")


# ---------------------------------------------------------------- balanced parentheses


class Excess:
    """Depth after each parenthesis (+1 open, -1 close), with the least depth of blocks and of pairs
    of them up to the root (range min-max tree)."""

    def __init__(self, bits: np.ndarray, before: int = 0):
        self.depth = before + np.cumsum(bits, dtype=np.int64)
        blocks = max(1, -(-len(bits) // BLOCK))
        padded = np.full(blocks * BLOCK, _FAR, np.int64)
        padded[: len(bits)] = self.depth
        self.padded = padded
        self.levels = [padded.reshape(-1, BLOCK).min(axis=1)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = self.levels[-1] = np.r_[below, _FAR]
            self.levels.append(np.minimum(below[::2], below[1::2]))

    def _scan(self, start: np.ndarray, most: np.ndarray) -> np.ndarray:
        """First place from `start` to the end of its block with depth at most `most`, else -1."""
        found = np.full(len(start), -1, np.int64)
        live = np.arange(len(start))
        for step in range(BLOCK):
            live = live[(start[live] % BLOCK) + step < BLOCK]
            if not len(live):
                break
            at = start[live] + step
            hit = self.padded[at] <= most[live]
            found[live[hit]] = at[hit]
            live = live[~hit]
        return found

    def first_at_most(self, start: np.ndarray, most: np.ndarray) -> np.ndarray:
        """For each query the first place from `start` on with depth at most `most`, -1 if none."""
        found = np.full(len(start), -1, np.int64)
        inside = np.flatnonzero(start < len(self.depth))
        found[inside] = self._scan(start[inside], most[inside])
        live = inside[found[inside] < 0]
        node = start[live] // BLOCK
        hits: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in self.levels]
        for level, least in enumerate(self.levels[:-1]):
            right = node + 1
            hit = (node % 2 == 0) & (least[np.minimum(right, len(least) - 1)] <= most[live])
            hits[level].append((live[hit], right[hit]))
            live, node = live[~hit], node[~hit] // 2
        query, node = live[:0], live[:0]
        for level in range(len(self.levels) - 1, -1, -1):
            more = [q for q, _ in hits[level]], [n for _, n in hits[level]]
            query, node = np.concatenate([query, *more[0]]), np.concatenate([node, *more[1]])
            if level:
                left = node * 2
                node = np.where(self.levels[level - 1][left] <= most[query], left, left + 1)
        found[query] = self._scan(node * BLOCK, most[query])
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Place of the closing parenthesis of each opening one, -1 where it stays open."""
        return self.first_at_most(opens + 1, self.depth[opens] - 1)


def common(a: bytes, b: bytes) -> int:
    """Turns two paths share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * WIDTH] == b[: middle * WIDTH] else (low, middle - 1)
    return low


def _keys(path: bytes, count: int) -> list[str]:
    """Names of the first `count` nodes of a path, the root included."""
    state, out = hashlib.md5(usedforsecurity=False), []
    for depth in range(count):
        state.update(path[(depth - 1) * WIDTH : depth * WIDTH] if depth else b"")
        out.append(state.hexdigest())
    return out


def shard_nodes(
    paths: list[bytes], lengths: list[list[int]], counts: list[int], lows: list[int], ends: list[str], before: int, after: int
) -> tuple[dict[str, list], dict[str, list], list[int]]:
    """(nodes, spines, totals) of one shard: sorted different paths, the lengths of their turns, how
    many conversations go that way, the smallest, and the digest of all.

    `before` nodes of the first path are open already, `after` nodes of the last stay open. Nodes
    that open and close here are whole; of the others, the spines, this shard's part is told.
    """
    sizes = np.fromiter((len(p) // WIDTH + 1 for p in paths), np.int64, len(paths))
    shared = np.array([before, *(common(a, b) + 1 for a, b in zip(paths, paths[1:]))], np.int64)
    opened = sizes - shared
    closed = np.r_[0, sizes[:-1] - shared[1:]]
    bits = np.repeat(np.tile(np.array([-1, 1], np.int8), len(paths)), np.stack([closed, opened], axis=1).ravel())
    bits = np.r_[bits, np.full(sizes[-1] - after, -1, np.int8)]
    excess = Excess(bits, before)

    opens = np.flatnonzero(bits > 0)
    path = np.repeat(np.arange(len(paths)), opened)
    first = np.r_[0, opened.cumsum()[:-1]]
    depth = np.arange(len(opens)) - first[path] + shared[path]
    close = excess.findclose(opens)
    # lengths of nodes and of all above them
    turns = np.concatenate([np.array([0, *own], np.int64) for own in lengths])
    at = np.r_[0, sizes.cumsum()[:-1]]
    above = turns.cumsum() - turns
    held = turns[at[path] + depth]
    over = above[at[path] + depth] - above[at[path]]
    spoken = np.add.reduceat(turns, at)
    # parents, with the nodes open before in front
    parent = np.empty(len(opens), np.int64)
    branch = list(range(before))
    for i, (keep, new, start) in enumerate(zip(shared.tolist(), opened.tolist(), (first + before).tolist())):
        del branch[keep:]
        parent[start - before] = branch[-1] if branch else -1
        parent[start - before + 1 : start - before + new] = np.arange(start, start + new - 1)
        branch.extend(range(start, start + new))
    depths = np.r_[np.arange(before), depth]
    parents = np.r_[np.arange(-1, before - 1), parent]
    low = np.full(len(depths), _FAR, np.int64)
    tips = before + first + opened - 1
    low[tips] = lows
    by_depth = np.argsort(depths, kind="stable")
    cuts = np.r_[0, np.flatnonzero(np.diff(depths[by_depth])) + 1, len(by_depth)]
    for a, b in zip(cuts[-2:0:-1].tolist(), cuts[:1:-1].tolist()):
        level = by_depth[a:b]
        level = level[parents[level] >= 0]
        np.minimum.at(low, parents[level], low[level])
    children = np.bincount(parent[parent >= 0], minlength=len(depths))
    told: list[str] = [NO_ENDS] * len(depths)
    for tip, digest in zip(tips.tolist(), ends):
        told[tip] = digest

    # cumulative arrays: what comes before each parenthesis
    weights = np.zeros((len(SUMS), len(bits)), np.int64)
    tip_at = opens[tips - before]
    weights[0, tip_at] = counts
    weights[1, tip_at] = np.array(counts, np.int64) * spoken
    weights[2, opens] = held
    weights[3, opens] = (bits[opens] > 0) & (np.r_[bits, 1][opens + 1] < 0)
    running = np.concatenate([np.zeros((len(SUMS), 1), np.int64), weights.cumsum(axis=1)], axis=1)

    whole = np.flatnonzero(close >= 0)
    convs, said, kept, leaves = running[:, close[whole]] - running[:, opens[whole]]
    left = np.zeros(len(depths), bool)
    left[:before] = True
    left[before + np.flatnonzero(close < 0)] = True
    first_keys, last_keys = _keys(paths[0], before), _keys(paths[-1], after)

    def key_of(node: int) -> str | None:
        if node < 0:
            return None
        return first_keys[node] if node < before else last_keys[depths[node]]

    up = parents[before + whole]
    inside = ~left[up] & (up >= 0)
    nodes = {
        "conv_id": low[before + whole].tolist(),
        "depth": depth[whole].tolist(),
        "parent_conv_id": [int(low[p]) if own else None for p, own in zip(up.tolist(), inside.tolist())],
        "n_convs": convs.tolist(),
        "n_children": children[before + whole].tolist(),
        "n_leaves": leaves.tolist(),
        "saved_tokens": (said - convs * over[whole] - kept).tolist(),
        "ends_sha256": [told[i] for i in (before + whole).tolist()],
        "parent_key": [None if own else key_of(p) for p, own in zip(up.tolist(), inside.tolist())],
    }
    spine = np.flatnonzero(left).tolist()
    shut = excess.first_at_most(np.zeros(before, np.int64), np.arange(before))
    spines: dict[str, list] = {
        "key": [key_of(i) for i in spine],
        "depth": [int(depths[i]) for i in spine],
        "parent_key": [key_of(int(parents[i])) for i in spine],
        "low": [int(low[i]) for i in spine],
        "n_children": [int(children[i]) for i in spine],
        "ends_sha256": [None if i < before else told[i] for i in spine],
        "over": [None if i < before else int(over[i - before]) for i in spine],
        "opened": [None if i < before else running[:, opens[i - before]].tolist() for i in spine],
        "closed": [running[:, shut[i]].tolist() if i < before and shut[i] >= 0 else None for i in spine],
    }
    return nodes, spines, running[:, -1].tolist()


# ---------------------------------------------------------------- conversations to paths


def _with_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as digest and length. One row's value is
    a conversation of some 60 bytes a turn, without texts."""
    said = "concat(cast(char_length(role) as string), ':', role, text)"
    turns = conversations.where("conv_id is not null").selectExpr(
        "cast(conv_id as bigint) as conv_id", "turn", "coalesce(role, '') as role", "coalesce(text, '') as text"
    )
    digests = turns.selectExpr(
        "conv_id", f"struct(turn, md5(cast({said} as binary)) as digest, cast(char_length(text) as bigint) as n) as t"
    )
    return digests.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, lengths): the first h turns of the first conversation of its hundred, then
    its own after the first h, where h is crc32 of the id in decimals modulo SHARED_TURNS."""
    own = stage(_with_turns(conversations), "turns")
    leaders = own.where("conv_id % 100 = 0").selectExpr("conv_id as _leader", f"slice(turns, 1, {SHARED_TURNS - 1}) as _lead")
    leaders = stage(leaders, "leaders")
    h = f"cast(crc32(cast(cast(conv_id as string) as binary)) % {SHARED_TURNS} as int)"
    placed = own.selectExpr("conv_id", "turns", f"{h} as h", "conv_id - conv_id % 100 as _leader")
    joined = attach(placed, leaders, ["_leader"], "left")
    turns = "concat(slice(coalesce(_lead, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, greatest(size(turns) - h, 0)))"
    return joined.selectExpr("conv_id", f"{turns} as turns").selectExpr(
        "conv_id", "unhex(array_join(transform(turns, t -> t.digest), '')) as path", "transform(turns, t -> t.n) as lengths"
    )


def different_paths(conversations: DataFrame) -> DataFrame:
    """(path, lengths, n, low, ends_sha256) of `conversations` (conv_id, path, lengths): each path
    once, with the number of its conversations, the smallest id, and the digest of all ids in
    order. Ids are listed by chunks of 2^CHUNK_BITS, and a task reads the chunks of a path one
    after another, so a path of very many conversations never lies in memory."""
    chunks = conversations.groupBy("path", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.first("lengths").alias("lengths"), F.sort_array(F.collect_list("conv_id")).alias("ids")
    )
    wanted = StructType.fromDDL("path binary, lengths array<long>, n long, low long, ends_sha256 string")
    arrow = to_arrow_schema(wanted)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state, held = None, None, {}
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                text = ",".join(map(str, row["ids"]))
                if state and row["path"] == path:
                    state.update(f",{text}".encode())
                    held["n"] += len(row["ids"])
                else:
                    if state:
                        out.append(held | {"ends_sha256": state.hexdigest()})
                    path, state = row["path"], hashlib.sha256(text.encode())
                    held = {"path": path, "lengths": row["lengths"], "n": len(row["ids"]), "low": row["ids"][0]}
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
            out = []
        if state:
            yield pa.RecordBatch.from_pylist([held | {"ends_sha256": state.hexdigest()}], schema=arrow)

    ordered = chunks.repartition("path").sortWithinPartitions("path", "chunk").select("path", "lengths", "ids")
    return ordered.mapInArrow(listed, wanted)


# ---------------------------------------------------------------- the trie

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def _struct(ddl: str) -> str:
    return "struct<" + ", ".join(part.replace(" ", ": ") for part in ddl.split(", ")) + ">"


SPINE = "key string, depth long, parent_key string, low long, n_children long, ends_sha256 string, over long, opened array<long>, closed array<long>"
PARTS = f"shard int, node {_struct(NODE + ', parent_key string')}, spine {_struct(SPINE)}, totals array<long>"


def _sharded(paths: DataFrame, shard_nodes_: int) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """The paths with their shard, and of each shard how many nodes of its first path are open
    before it and how many of its last stay open. The driver sees two paths of each shard."""
    nodes = paths.agg(F.sum(F.expr(f"length(path) div {WIDTH} + 1"))).first()[0] or 0
    cut = paths.repartitionByRange(int(nodes // shard_nodes_) + 1, "path")
    shards = stage(cut.withColumn("shard", F.spark_partition_id()), "shards")
    ends = shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")).collect()
    ends = sorted((row.shard, bytes(row.first), bytes(row.last)) for row in ends)
    joints = [common(a[2], b[1]) + 1 for a, b in zip(ends, ends[1:])]
    return shards, {row[0]: open_ for row, open_ in zip(ends, zip([0, *joints], [*joints, 0]))}


def _parts(shards: DataFrame, joints: dict[int, tuple[int, int]]) -> DataFrame:
    """What each shard tells, as rows of PARTS."""
    wanted = StructType.fromDDL(PARTS)
    arrow = to_arrow_schema(wanted)
    names = ("path", "lengths", "n", "low", "ends_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            columns = pa.Table.from_batches(held).to_pydict()
            nodes, spines, totals = shard_nodes(*(columns[name] for name in names), *joints[shard])
            for field, found in (("node", nodes), ("spine", spines)):
                arrays = [pa.array(found[f.name], f.type) for f in arrow.field(field).type]
                rows = pa.StructArray.from_arrays(arrays, fields=list(arrow.field(field).type))
                yield _only(arrow, shard, field, rows)
            yield _only(arrow, shard, "totals", pa.array([totals], arrow.field("totals").type))

        for batch in batches:
            own = batch["shard"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and own[a] != shard:
                        yield from done()
                        held = []
                    shard = int(own[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    ordered = shards.repartition("shard").sortWithinPartitions("shard", "path")
    return ordered.select("shard", *names).mapInArrow(run, wanted)


def _only(schema: pa.Schema, shard: int, name: str, values: pa.Array) -> pa.RecordBatch:
    columns = [
        pa.array([shard] * len(values), f.type) if f.name == "shard" else values if f.name == name else pa.nulls(len(values), f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def trie(paths: DataFrame, shard_nodes_: int = SHARD_NODES) -> DataFrame:
    """A row per node of the trie of `paths` (path, lengths, n, low, ends_sha256; each path once):
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. No paths give no nodes, not even the root."""
    shards, joints = _sharded(stage(paths, "paths"), shard_nodes_)
    parts = stage(_parts(shards, joints), "parts")
    # one row per shard
    before = "rows between unbounded preceding and 1 preceding"
    offsets = stage(
        parts.where("totals is not null").selectExpr(
            "shard", *(f"coalesce(sum(totals[{i}]) over (order by shard {before}), 0L) as _{i}" for i in range(len(SUMS)))
        ),
        "offsets",
    )
    told = attach(parts.where("spine is not null").select("shard", "spine.*"), offsets, ["shard"])
    sums = [
        F.expr(f"max(closed[{i}] + _{i}) - max(opened[{i}] + _{i})").alias(name) for i, name in enumerate(SUMS)
    ]
    merged = told.groupBy("key").agg(
        F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"),
        F.min("low").alias("conv_id"),
        F.sum("n_children").alias("n_children"),
        F.max("ends_sha256").alias("ends_sha256"),
        F.max("over").alias("over"),
        *sums,
    )
    spine = stage(
        merged.selectExpr(
            "key", "conv_id", "depth", "parent_key", "convs as n_convs", "n_children", "leaves as n_leaves",
            "spoken - convs * over - held as saved_tokens", "ends_sha256",
        ),
        "spine",
    )
    up = spine.selectExpr("key as parent_key", "conv_id as _parent")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes = parts.where("node is not null").select("node.*")
    under = attach(nodes.where("parent_key is not null"), up, ["parent_key"]).withColumn("parent_conv_id", F.col("_parent"))
    over = attach(spine, up, ["parent_key"], "left").withColumn("parent_conv_id", F.col("_parent"))
    return nodes.where("parent_key is null").select(columns).union(under.select(columns)).union(over.select(columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations of `conversations` (conv_id, turn, role,
    text, any more); see `trie` for the columns and `rebuilt` for the conversations.

    A node is a different sequence of first turns (role and text), from the root without any;
    members are the conversations that start with it. saved_tokens is the number of characters
    that sharing the nodes of the subtree saves. NULL roles and texts are empty; a NULL turn comes
    first; turns of equal number are in the order of their digests, and repeated rows are turns of
    their own. Rows without conv_id belong to no conversation. A conversation that is left without
    turns is a member of the root. An empty table gives an empty result; other columns are ignored.
    """
    return trie(different_paths(rebuilt(conversations)))
