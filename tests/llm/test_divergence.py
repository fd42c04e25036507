"""The source audit: transducer, recount, exact shares, odd input."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_rows

from voltscape.llm import divergence

WORDS = ["tap", "taps", "top", "tops", "stop", "stops", "été", "ét", "a", "zz", "ça"]


def plain(rows, least=3, top=200):
    """The definition, in whole numbers of any size."""
    docs = [(la or "", s or "", Counter(divergence.terms_of((t or "").encode()))) for _, t, la, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        within = Counter(term for _, _, terms in own for term in terms)
        kept = sorted(term for term, n in within.items() if n >= least)
        counts = {s: sum((t for _, x, t in own if x == s), Counter()) for s in {d[1] for d in own}}

        def shares(count):
            total = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // total for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s]
            for rank, (value, o) in enumerate(sorted(pairs, key=lambda x: (-x[0], x[1].encode())), 1):
                out.append((lang, s, "pair", o, value, rank))
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for rank, (value, t) in enumerate(sorted(terms, key=lambda x: (-x[0], x[1]))[:top], 1):
                out.append((lang, s, "term", t.decode(), value, rank))
    return sorted(out)


def some_rows(seed, n):
    draw = random.Random(seed)
    return [
        (i, " ".join(draw.choices(WORDS, range(len(WORDS), 0, -1), k=draw.randrange(9))) + ".", draw.choice(["en", "fr", None]), draw.choice("abc"))
        for i in range(n)
    ]


def found(spark, rows):
    return sorted(tuple(r) for r in divergence.divergence(documents(spark, rows)).collect())


def test_as_defined(spark):
    rows = some_rows(1, 90)
    assert found(spark, rows) == plain(rows)


def test_small_ranges_blocks_and_passes_change_nothing(spark, monkeypatch):
    rows = some_rows(2, 90)
    whole = found(spark, rows)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 4)
    kept = divergence.kept_terms
    vocabulary = divergence.vocabulary
    monkeypatch.setattr(divergence, "vocabulary", lambda terms: vocabulary(terms, range_bytes=20, pass_bytes=1000))
    assert len(divergence.vocabulary(kept(documents(spark, rows).selectExpr("lang", "cast(text as binary) as text")))) > 1
    assert found(spark, rows) == whole == plain(rows)


def test_only_the_first_terms(spark, monkeypatch):
    rows = some_rows(3, 60)
    monkeypatch.setattr(divergence, "TOP_TERMS", 2)
    got = sorted(tuple(r) for r in divergence.divergence(documents(spark, rows), top=2).collect())
    assert got == plain(rows, top=2)


def test_transducer_is_minimal_and_counts_in_order():
    draw = random.Random(4)
    for n in (0, 1, 2, 7, 300):
        terms = sorted({bytes(draw.choices(b"ab\xc3\xa9s", k=draw.randrange(1, 7))) for _ in range(n)})
        machine = divergence.transducer(terms)
        others = [bytes(t) + b"z" for t in terms] + [t[:-1] for t in terms] + [b"", b"q", b"zzzzzzzzzz"]
        asked = terms + others
        place = {t: i for i, t in enumerate(terms)}
        assert machine.ordinals(asked).tolist() == [place.get(t, -1) for t in asked]
        assert [machine.term(i) for i in range(len(terms))] == terms
        # as many states as there are different sets of endings
        prefixes = {t[:i] for t in terms for i in range(len(t) + 1)} or {b""}
        endings = {frozenset(t[len(p) :] for t in terms if t.startswith(p)) for p in prefixes}
        assert len(machine.final) == len(endings)


def test_shares_are_exact():
    count, total = [0, 5, 10**14, 3 * 10**12], [7, 6, 9 * 10**14, 4 * 10**12]
    wanted = [1 + 10**9 * (c + 1) // t for c, t in zip(count, total)]
    assert divergence.shares(np.array(count), np.array(total)).tolist() == wanted


def test_terms():
    assert divergence.terms_of("Ab-Çd9É x_y ΩÅ".encode()) == [w.encode() for w in ["ab", "Çd", "É", "x", "y", "ΩÅ"]]
    text = "".join(map(chr, itertools.chain(range(128), [160, 255])))
    assert divergence.terms_of(text.encode()) == [b"abcdefghijklmnopqrstuvwxyz", b"abcdefghijklmnopqrstuvwxyz", "\xa0ÿ".encode()]


@pytest.mark.parametrize("extra", [[], [(20, "solo solo solo", "xx", "only")] * 3, [(21, "once", "yy", s) for s in "ab"]])
def test_odd_rows(spark, extra):
    rows = [*odd_rows(), (30, "n" * 200_000 + " one", "en", "a"), (31, "One 1 one", "en", None), (32, "ONE", "en", ""), *extra]
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    frame = documents(spark, some_rows(1, 3)).limit(0)
    assert divergence.divergence(frame).collect() == []
