"""The conversation trie against a plain one: any shard size, spines, odd input."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from helpers import CLASHING

from voltscape.llm import prefix_trie as trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """A dictionary of prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = f"{len(role or '')}:{role or ''}{text or ''}"
            order = hashlib.md5(said.encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, order), (role or "", text or "")))
    own = {conv: [turn for _, turn in sorted(found)] for conv, found in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, said in sorted(own.items()):
        h = crc32(str(conv).encode()) % 6
        leader = abs(conv) // 100 * 100 * (1 if conv >= 0 else -1)  # remainders as in SQL
        path = tuple(own.get(leader, [])[:h] + said[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
        ends[path].append(conv)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        out.append((
            convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), children[path],
            sum(not children[p] for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, shard_nodes=trie.SHARD_NODES, clashing=False):
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHING + ["path", "digest", "n", "h", "lengths", "shard"] if clashing else []:
        frame = frame.selectExpr("*", f"cast(conv_id as string) as `{name}`")
    paths = trie.different_paths(trie.rebuilt(frame))
    return sorted((tuple(r) for r in trie.trie(paths, shard_nodes).select(COLUMNS).collect()), key=str)


def some_rows(seed: int, convs: int):
    draw = random.Random(seed)
    return [
        (conv, turn, draw.choice(["user", "assistant"]), draw.choice(["a", "bb", "cçç", ""]))
        for conv in range(convs)
        for turn in range(draw.randrange(1, 7))
    ]


@pytest.mark.parametrize("shard_nodes", [3, 40, trie.SHARD_NODES])
def test_any_shard_size_gives_the_plain_trie(spark, shard_nodes):
    rows = some_rows(5, 130)
    assert found(spark, rows, shard_nodes) == plain(rows)


def test_shards_of_one_path_are_merged_by_their_spines():
    """The kernel alone, on every way to cut sorted paths in two."""
    paths = [b"", b"a" * 16, b"a" * 32, b"a" * 16 + b"b" * 16, b"c" * 48]
    lengths = [[], [1], [1, 2], [1, 3], [5, 6, 7]]
    whole, none, totals = trie.shard_nodes(paths, lengths, [2, 1, 1, 4, 1], [9, 3, 4, 0, 7], list("abcde"), 0, 0)
    assert none["key"] == [] and totals[0] == 9 and len(whole["depth"]) == 7
    for cut in range(1, 5):
        joint = trie.common(paths[cut - 1], paths[cut]) + 1
        one = trie.shard_nodes(paths[:cut], lengths[:cut], [2, 1, 1, 4, 1][:cut], [9, 3, 4, 0, 7][:cut], list("abcde")[:cut], 0, joint)
        two = trie.shard_nodes(paths[cut:], lengths[cut:], [2, 1, 1, 4, 1][cut:], [9, 3, 4, 0, 7][cut:], list("abcde")[cut:], joint, 0)
        assert len(one[0]["depth"]) + len(two[0]["depth"]) + joint == 7
        assert one[1]["key"] == two[1]["key"] and len(one[1]["key"]) == joint
        assert np.add(one[2], two[2]).tolist() == totals
        sums = [[b + t - a for a, b, t in zip(o, c, one[2])] for o, c in zip(one[1]["opened"], two[1]["closed"])]
        assert sums[0] == totals  # the root holds all


def test_findclose_is_the_matching_parenthesis():
    draw = random.Random(1)
    for n in (1, 40, 700, 5000):
        bits, depth = [], 0
        for _ in range(n):
            bits.append(1 if depth == 0 or draw.random() < 0.55 else -1)
            depth += bits[-1]
        bits = np.array(bits, np.int8)
        stack, close = [], {}
        for i, bit in enumerate(bits):
            if bit > 0:
                stack.append(i)
            else:
                close[stack.pop()] = i
        opens = np.flatnonzero(bits > 0)
        assert trie.Excess(bits).findclose(opens).tolist() == [close.get(i, -1) for i in opens]


def test_odd_rows(spark):
    rows = [
        (0, 0, "user", "hello"),
        (0, None, None, None),
        (0, None, None, None),
        (0, 0, "user", "hello"),
        (0, 0, "user", "other"),
        (None, 0, "user", "nobody"),
        (None, None, None, None),
        (1, 5, "", "x" * 100_000),
        (2, 0, "user", None),
        (-1, 0, "user", "</s>"),
        (-130, 0, "user", "below"),
        (250, 0, "user", "no leader"),
        (10**15, 0, "user", "hello"),
        (10**15 + 7, 0, "user", "hello"),
    ]
    assert found(spark, rows, clashing=True) == plain(rows)


def test_many_members_of_one_path_are_listed_by_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BITS", 2)
    rows = [(conv, 0, "user", "same") for conv in range(-70, 130)]
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).columns == COLUMNS
