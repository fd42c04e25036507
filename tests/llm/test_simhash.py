"""Fingerprints and components against plain loops."""

import random

import numpy as np
import pytest
import xxhash
from helpers import documents, odd_rows, prose

from voltscape.llm import simhash
from voltscape.llm.common import components


def plain_fingerprint(text: str) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def plain_roots(fps: list[int], distance: int = 3) -> dict[int, int]:
    """Smallest fingerprint (as a signed long) reachable."""
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    parent = {f: f for f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((top(a), top(b)), key=signed.get)
                parent[y] = x
    return {signed[f]: signed[top(f)] for f in fps}


@pytest.mark.parametrize("text", ["", "  ", "One", "one TWO", "ÄRGER über Alles", prose(4, 900), "a b c " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)


def near(rng: random.Random, fp: int, bits: int) -> int:
    for bit in rng.sample(range(64), bits):
        fp ^= 1 << bit
    return fp


def fingerprints_with_groups(seed: int, groups: int) -> list[int]:
    rng = random.Random(seed)
    found = []
    for _ in range(groups):
        fp = rng.getrandbits(64)
        found.append(fp)
        for _ in range(rng.randrange(5)):
            found.append(fp := near(rng, fp, rng.randrange(1, 6)))
    return list(dict.fromkeys([0, *found]))


@pytest.mark.parametrize("cell_rows", [20_000, 3])
def test_clusters_equal_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)
    fps = fingerprints_with_groups(1, 150)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {r.fp: r.root for r in simhash.clusters(frame).collect()}
    assert got == plain_roots(fps)


def test_number_of_groups_changes_no_link(spark, monkeypatch):
    fps = fingerprints_with_groups(2, 120)
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for groups in (5, 8):
        monkeypatch.setattr(simhash, "groups_for", lambda rows, distance, n=groups: n)
        assert {r.fp: r.root for r in simhash.clusters(frame).collect()} == plain_roots(fps)


def test_full_cell_gives_few_links():
    rng = random.Random(3)
    fps = np.array(list({near(rng, 12345, 2) for _ in range(900)}), np.uint64)
    moved = fps >> np.uint64(1)
    low = np.uint64(0x5555555555555555)
    points = ((fps & moved & low) << np.uint64(1)) | ((fps ^ moved) & low)
    pairs = simhash.linked(fps, points, 3)
    assert len(pairs) <= len(fps) - 1
    roots = plain_roots([int(f) for f in fps])
    assert len(fps) - len(pairs) == len(set(roots.values()))


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 501: 500}
    assert components(edges.limit(0), "a", "b").count() == 0


def test_odd_rows(spark):
    got = simhash.near_duplicates(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert len(zero) == 4 and {r.component_id for r in zero} == {1}
    assert {r.component_id for r in got if r.doc_id == 5} == {4}
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_one_per_group(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    roots = {}
    for r in rows:
        roots.setdefault(plain_fingerprint(r[1] or ""), []).append(r)
    assert len(got) == len(set(plain_roots(list(roots)).values()))
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [1, 4, 4, 6, 7]
    assert simhash.one_per_group(documents(spark, [])).count() == 0
