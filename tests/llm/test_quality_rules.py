"""Counts against plain loops, the estimate against numpy, planted junk and odd inputs."""

import re
from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_rows, prose

from voltscape.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


TEXTS = [
    "",
    " \n ",
    "a b c a b c",
    "a a a a",
    "a b c d e a b d a b c",
    "x\n\n\nx\n x\nx\r\nx",
    "é ü ß # $ <b>",
    "one two\x1cthree\x85four",
    prose(1, 300, 2),
    prose(2, 500),
]


def test_counts():
    for text in TEXTS:
        assert qr.counts_of(text)[:5] == plain_counts(text), text


def clean(i):
    words = prose(i, 60 + i * 13 % 200).split()
    return " ".join(w.capitalize() + "." if j % 9 == 0 else w for j, w in enumerate(words))


def junk(i):
    text = clean(i)
    return [text.upper().replace(" ", "!! "), text.replace(" ", " | "), " ".join(w + "$$$" for w in text.split())][i % 3]


def test_junk_goes_and_clean_stays(spark):
    rows = [(i, clean(i), "en" if i % 2 else "de", "hot" if i % 3 else "cold") for i in range(400)]
    rows += [(1000 + i, junk(i), "en" if i % 2 else "de", "hot" if i % 3 else "cold") for i in range(60)]
    rows += [(2000, "word again " * 100, "en", "hot"), (2001, prose(1, 49), "en", "hot"), (2002, prose(1, 90), "en", "alone")]
    got = {r.doc_id: r for r in qr.quality(documents(spark, rows)).collect()}
    assert all(got[i].kept for i in range(400))
    assert not any(got[i].kept for i in range(1000, 1060))
    assert got[2000].base_failed and got[2001].base_failed and not got[2000].kept
    assert got[2002].kept
    docs = documents(spark, rows)
    kept = qr.good_rows(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def lower(values, share):
    return np.sort(values, axis=0)[int(np.ceil(share * len(values))) - 1]


def plain_mcd(x):
    """The search in numpy: (centre, inverse, log determinant) of every start, to its end."""
    floors = np.array(list(qr.STATISTICS.values()))
    middle, low, high = (lower(x, s) for s in (0.5, 0.25, 0.75))
    u = (x - middle) / floors
    signs = u / np.maximum(np.linalg.norm(u, axis=1), 1e-9)[:, None]
    turned = signs.T @ signs / len(x) * len(floors) * np.outer(floors, floors) + np.diag(floors**2)
    plain = np.diag(1 / floors**2)
    starts = [(middle, plain), (low, plain), (high, plain),
              (middle, np.diag(1 / np.maximum((high - low) / 1.349, floors) ** 2)), (middle, np.linalg.inv(turned))]
    out = []
    for centre, inverse in starts:
        path = []
        while len(path) <= qr.FIRST_STEPS or path[-1][2] < path[-2][2] - qr.SETTLED:
            d2 = np.einsum("ni,ij,nj->n", x - centre, inverse, x - centre)
            half = x[d2 <= lower(d2, 0.5)]
            centre = half.mean(axis=0)
            scatter = np.cov(half.T, bias=True) + np.diag(floors**2)
            inverse = np.linalg.inv(scatter)
            path.append((centre, inverse, np.linalg.slogdet(scatter)[1]))
        # the determinant never rises
        assert all(b[2] <= a[2] + 1e-9 for a, b in zip(path, path[1:]))
        out.append(path)
    return out


@pytest.mark.parametrize("case", ["one", "two clusters"])
def test_least_determinant_of_all_starts(spark, case):
    """The start with the least determinant after the first steps is followed to its end."""
    odd = 8 if case == "one" else 2
    rows = [(i, clean(i) if i % odd else junk(3 * i if odd == 2 else i), "en", "one") for i in range(1, 300)]
    counted = qr.statistics(documents(spark, rows), "doc_id", "lang", "source")
    shape = qr.fit(counted).first()
    x = np.array([r.q for r in qr._vectors(counted).collect()]) / qr.UNIT
    paths = plain_mcd(x)
    best = min(paths, key=lambda path: round(path[qr.FIRST_STEPS - 1][2], 9))
    centre, inverse, logdet = best[-2]
    assert shape.logdet == pytest.approx(logdet, abs=1e-6)
    assert shape.logdet <= min(path[qr.FIRST_STEPS - 1][2] for path in paths) + 1e-6
    assert np.allclose(shape.centre, centre, atol=1e-6)
    assert np.allclose(np.array(shape.inverse).reshape(inverse.shape), inverse, rtol=1e-4, atol=1e-4)


def test_partitions_change_nothing(spark):
    rows = [(i, clean(i) if i % 8 else junk(i), "en", "ab"[i % 2]) for i in range(1, 200)]
    docs = documents(spark, rows)
    one, many = (sorted(map(tuple, qr.quality(docs.repartition(n)).collect())) for n in (1, 13))
    assert one == many


def test_ranked_is_exact(spark):
    draw = np.random.default_rng(2)
    values = [(g, float(v)) for g in "ab" for v in [*draw.normal(0, 50, 301), *[0.0] * 200, *draw.integers(-5, 5, 100)]]
    frame = spark.createDataFrame([*values, ("c", 7.0)], "g string, v double")
    got = {(r.g, r.share): r.v for r in qr.ranked(frame, ["g"], "v", (0.25, 0.5, 0.75)).collect()}
    for g in "ab":
        own = np.array([v for h, v in values if h == g])
        assert [got[g, s] for s in (0.25, 0.5, 0.75)] == [lower(own, s) for s in (0.25, 0.5, 0.75)]
    assert [got["c", s] for s in (0.25, 0.5, 0.75)] == [7.0] * 3


def test_odd_rows(spark):
    got = qr.quality(documents(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        assert r.kept is not None and (r.n_words >= 50 or (r.base_failed and not r.kept and r.d2 is None))
    assert len([r for r in got if r.doc_id == 4 and r.kept]) == 3
    assert qr.quality(documents(spark, [])).count() == 0
    assert qr.good_rows(documents(spark, [])).count() == 0
