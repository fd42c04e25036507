"""Rings from open ways, against a walk in plain Python; graph helpers."""

import random
from collections import defaultdict

import pytest

from voltscape.functions.graph import connected, positions
from voltscape.operators import rings
from voltscape.sources.tables import EXTRACT, extract_elements

AREA = {"landuse": "residential"}


def element(kind, number, **more):
    blank = {"lat": None, "lon": None, "nodes": None, "members": None, "tags": None}
    return {"type": kind, "id": number} | blank | more


def frame(spark, documents):
    rows = [{"document": name, "elements": found} for name, found in documents.items()]
    return extract_elements(spark.createDataFrame(rows, f"document string, {EXTRACT}"), "document")


def nodes(numbers):
    return [element("node", i, lon=float(i), lat=float(-i)) for i in numbers]


def cut(ring, parts, draw):
    """A closed list of nodes as open ways in any order and direction."""
    at = sorted(draw.sample(range(len(ring)), parts))
    pieces = [[ring[k % len(ring)] for k in range(a, b + 1)] for a, b in zip(at, [*at[1:], at[0] + len(ring)])]
    pieces = [piece[::-1] if draw.random() < 0.5 else piece for piece in pieces]
    draw.shuffle(pieces)
    return pieces


def same_ring(found, ring):
    """Equal but for the start and the direction."""
    assert found[0] == found[-1] and len(found) == len(ring) + 1
    at = found.index(ring[0])
    turned = found[at:-1] + found[:at]
    return turned in (list(ring), [ring[0], *ring[:0:-1]])


def test_rings_of_many_open_ways(spark):
    """Several rings per relation and role, one to forty ways each, in two documents with equal ids."""
    draw = random.Random(7)
    documents, expected = {}, {}
    for document in ("a", "b"):
        number, way, found = 0, 100, []
        for relation in range(4):
            listed = []
            for k, parts in enumerate([2, 3, draw.randrange(2, 40)]):
                ring = list(range(number, number + 40))
                number += 40
                role = ["outer", "inner", ""][k]
                pieces = cut(ring, parts, draw)
                numbers = list(range(way, way + parts))
                way += parts
                found += [element("way", i, nodes=piece) for i, piece in zip(numbers, pieces)]
                listed += [{"type": "way", "ref": i, "role": role} for i in numbers]
                expected[document, f"relation/{relation}", role or "outer", numbers[0]] = (ring, pieces[0])
            draw.shuffle(listed)
            found.append(element("relation", relation, members=listed, tags=AREA))
        documents[document] = [*nodes(range(number)), *found]
    areas = rings.areas(frame(spark, documents))
    assert areas.open.count() == 0
    got = {(r.document, r.area, r.role, r.ring): [int(p.lon) for p in r.coordinates] for r in areas.rings.collect()}
    assert got.keys() == expected.keys()
    for key, (ring, first) in expected.items():
        assert same_ring(got[key], ring)
        # from the smallest way, as that is stored
        assert got[key][: len(first)] == first


def test_parts_that_do_not_close(spark):
    members = [{"type": "way", "ref": i, "role": "outer"} for i in (1, 2, 3, 4, 5, 6, 77)]
    members.append({"type": "node", "ref": 1, "role": "label"})
    found = [
        *nodes(range(12)),
        element("way", 1, nodes=[0, 1]),
        element("way", 2, nodes=[1, 2, 0]),  # with 1 a ring
        element("way", 3, nodes=[3, 4]),
        element("way", 4, nodes=[5, 4]),  # with 3 open
        element("way", 5, nodes=[6, 99, 6]),  # lacks a node
        element("way", 6, nodes=[7, 8, 7]),  # there and back
        element("relation", 1, members=members, tags=AREA),
        # two rings that touch in one node
        *(element("way", 10 + i, nodes=own) for i, own in enumerate([[0, 1, 2], [2, 0], [2, 3, 4], [4, 2]])),
        element("relation", 2, members=[{"type": "way", "ref": 10 + i, "role": None} for i in range(4)] * 2, tags=AREA),
        element("relation", 3, members=[{"type": "way", "ref": 3, "role": "outer"}], tags={"landuse": "forest"}),
        element("relation", 4, members=None, tags=AREA),
    ]
    areas = rings.areas(frame(spark, {"d": found, "none": []}))
    whole = [(r.area, r.role, r.ring, [int(p.lon) for p in r.coordinates]) for r in areas.rings.collect()]
    assert whole == [("relation/1", "outer", 1, [0, 1, 2, 0])]
    left = sorted((r.relation, r.role, r.ring, r.ways, r.open_ends, r.branches) for r in areas.open.collect())
    assert left == [(1, "outer", 3, 2, 2, 0), (1, "outer", 6, 1, 0, 0), (2, "outer", 10, 4, 0, 1)]


def test_no_areas(spark):
    areas = rings.areas(frame(spark, {"d": nodes(range(3))}))
    assert areas.rings.count() == 0 and areas.open.count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_connected(spark, seed):
    draw = random.Random(seed)
    pairs = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(25)]
    pairs += [(300, 300 + i) for i in range(1, 20)] + [(400, 400), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in pairs:
        if u is not None:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    got = {r.node: r.root for r in connected(spark.createDataFrame(pairs, "u int, v int")).collect()}
    assert got == {x: find(x) for x in root}


def test_positions(spark):
    steps = [(0, None), *((i, i - 1) for i in range(1, 21)), (50, 51), (51, 50)]
    got = {r.at: r.position for r in positions(spark.createDataFrame(steps, "at int, before int"), 20).collect()}
    assert got == {i: i for i in range(21)}
    assert defaultdict(int, got)[50] == 0
