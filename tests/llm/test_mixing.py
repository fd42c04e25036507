"""Systematic sampling against a plain loop, and odd inputs."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

import pytest
from helpers import documents, odd_rows, prose

from voltscape.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """By the rule: cap, share the excess again by weight, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return {**{s: float(v) for s, v in capped.items()}, **{s: float(v) for s, v in share.items()}}
        capped |= {s: Fraction(most * sizes[s]) for s in above}


@pytest.fixture(scope="module")
def rows():
    found = [(i, prose(i, 5 + i * 7 % 190), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    return found + [(i, prose(0, 40), "en", "copies") for i in range(1000, 1300)]


def test_targets_and_copies(spark, rows, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)  # many buckets
    got = mixing.planned(documents(spark, rows)).collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r.size == len(WORD.findall(r.text))
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 3
    wanted = targets(sizes)
    largest = max(r.size for r in got)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 2 * largest
    assert len(got) == len(rows)


def test_same_for_any_number_of_buckets(spark, rows, monkeypatch):
    once = sorted((r.doc_id, r.copies) for r in mixing.planned(documents(spark, rows)).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 37)
    assert once == sorted((r.doc_id, r.copies) for r in mixing.planned(documents(spark, rows)).collect())


def test_boundaries_crossed(spark, rows):
    """The running sum in order of size class and hash, one step per row."""
    got = [r for r in mixing.planned(documents(spark, rows)).collect() if r.source == "hot"]

    def place(r):
        size, bits = r.size, r.size.bit_length()
        draw = int(hashlib.md5(f"0:{r.doc_id}".encode()).hexdigest()[:8], 16)
        return (size if size < 16 else bits * 16 + (size >> (bits - 4)), draw, r.doc_id)

    each = int(min(got[0].target / got[0].source_size, 3) * mixing.UNIT)
    run = int(hashlib.md5(b"0/hot").hexdigest()[:8], 16) * mixing.UNIT // 2**32
    for r in sorted(got, key=place):
        assert r.copies == (run + each) // mixing.UNIT - run // mixing.UNIT
        run += each


def test_mix_emits_each_copy(spark, rows):
    planned = {r.doc_id: r.copies for r in mixing.planned(documents(spark, rows)).collect()}
    mixed = mixing.mix(documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in mixed) == Counter({k: v for k, v in planned.items() if v})
    assert all(1 <= r.copy <= planned[r.doc_id] for r in mixed)


def test_odd_rows(spark):
    got = mixing.planned(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    assert {r.size for r in got if not (r.text or "").strip()} == {0}
    assert any(r.source is None and r.target > 0 for r in got)
    assert mixing.planned(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [])).count() == 0


def test_native(spark, rows):
    plan = mixing.planned(documents(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
