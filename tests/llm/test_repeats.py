"""Repeated strings against a count of all strings, and odd inputs."""

from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_rows, prose

from voltscape.llm import repeats

SIZE = 40


def plain(texts, size):
    """Per text: removed flags of every byte."""
    often = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    found = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if often[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        found.append(bytes(gone))
    return found


def check(spark, rows, size=SIZE):
    data = [(t or "").encode() for _, t, *_ in rows]
    wanted = []
    for (i, *_), t, gone in zip(rows, data, plain(data, size)):
        runs = sum(1 for j in range(len(gone)) if gone[j] and not (j and gone[j - 1]))
        wanted.append((i or -1, len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    got = repeats.without_repeats(documents(spark, rows), size).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(wanted)
    return sum(w[2] for w in wanted)


def mixed_rows():
    passage, line = prose(500, 40), "é" + prose(501, 5)
    rows = [(i, prose(i, 60), "en", "a") for i in range(40)]
    rows += [(100 + i, prose(i, 30) + passage[i : 200 - i] + prose(900 + i, 20), "en", "a") for i in range(30)]
    rows += [(200 + i, f"{prose(700 + i, 9)}\n{line}\n{prose(800 + i, 9)}\n{line}", "en", "a") for i in range(30)]
    rows += [(300 + i, prose(7, 80), "en", "a") for i in range(20)]
    rows += [(400 + i, prose(7, 80)[: 300 + i] + "#" + prose(7, 80)[301 + i :], "en", "a") for i in range(20)]
    return [*rows, (450, "a" * 300, "en", "a"), (451, "ab" * 100 + "a" * 100, "en", "a"), (452, passage * 2, "en", "a")]


@pytest.mark.parametrize("contexts", [4096, 3])
def test_equals_brute_force(spark, monkeypatch, contexts):
    monkeypatch.setattr(repeats, "BUCKET_CONTEXTS", contexts)
    monkeypatch.setattr(repeats, "SORT_STARTS", 500)
    assert check(spark, mixed_rows()) > 10_000


def occurrences(texts, string):
    return [(i, at) for i, t in texts.items() for at in range(len(t) - len(string) + 1) if t.startswith(string, at)]


@pytest.mark.parametrize("contexts", [4096, 1])
def test_groups_are_strings_with_all_their_places(spark, monkeypatch, contexts):
    monkeypatch.setattr(repeats, "BUCKET_CONTEXTS", contexts)
    rows = mixed_rows()
    texts = {i: t.encode() for i, t, *_ in rows}
    groups = [tuple(r) for r in repeats.repeats(documents(spark, rows), SIZE).drop("hash").collect()]
    assert len(groups) == len(set(groups)) > 100
    spans = {i: [] for i in texts}
    for first, start, length, often in groups:
        string = texts[first][start : start + length]
        found = occurrences(texts, string)
        assert len(string) == length >= SIZE and len(found) == often > 1 and found[0] == (first, start)
        for i, at in found:
            spans[i].append((at, at + length))
    got = repeats.without_repeats(documents(spark, rows), SIZE).collect()
    assert {i: sum(b - a for a, b in repeats.merged(own)) for i, own in spans.items()} == {r.doc_id: r.n_removed for r in got}
    for r in got:
        own = [(length, often) for first, _, length, often in groups if first == r.doc_id]
        assert (r.n_groups, r.longest_group, r.occurrences) == (len(own), *max(own, default=(0, 0)))
        assert r.repeated == (r.n_removed > 0)


def test_full_buckets_give_the_same_groups(spark):
    docs = documents(spark, mixed_rows())
    few, many = (sorted(map(tuple, repeats.repeats(docs, SIZE, bucket).collect())) for bucket in (1, 4096))
    assert few == many


def test_a_text_held_twice_is_one_group(spark):
    whole, part = prose(1, 900), prose(2, 40)
    rows = [(1, whole, "en", "a"), (2, f"{part}|{whole}", "en", "a"), (3, f"{prose(3, 30)}~{whole} {prose(4, 30)}", "en", "a")]
    got = repeats.repeats(documents(spark, rows)).collect()
    assert [(r.doc_id, r.start, r.length, r.occurrences) for r in got] == [(1, 0, len(whole), 3)] and len(whole) > 4000
    # a passage of it in a third text is a group of its own; the rest lies on either side
    middle = whole[1500:4000]
    rows = [(1, whole, "en", "a"), (2, whole, "en", "a"), (3, f"{prose(5, 90)}|{middle}~{prose(6, 90)}", "en", "a")]
    got = sorted((r.start, r.length, r.occurrences) for r in repeats.repeats(documents(spark, rows)).collect())
    assert (1500, 2500, 3) in got and len(got) == 3
    assert got[0][0] == 0 and got[-1][0] + got[-1][1] == len(whole) and {g[2] for g in got if g != (1500, 2500, 3)} == {2}


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PART", 128)
    check(spark, mixed_rows()[:80] + [(900, prose(1, 3000), "en", "a"), (901, "x" + prose(1, 3000), "en", "a")])


def test_odd_rows(spark):
    check(spark, [*odd_rows()[:9], (10, prose(2, 120) + "!", None, None)], 400)
    assert repeats.without_repeats(documents(spark, [])).count() == 0
    assert repeats.repeats(documents(spark, [(1, "short", "en", "a")])).count() == 0


def test_rolling_hash_depends_on_content_alone():
    data = np.frombuffer(prose(1, 200).encode() * 2, np.uint8)
    hashes = repeats.rolling(data, 50)
    half = len(data) // 2
    assert (hashes[: half - 50] == hashes[half : 2 * half - 50]).all()
    assert len(set(hashes[:half].tolist())) == half


def naive_nodes(suffixes, least):
    """(bytes, members) of every string that ends a common prefix and has different bytes before."""
    found = {}
    for i, (a, *_) in enumerate(suffixes):
        for b, *_ in suffixes[i + 1 :]:
            n = repeats._common(a, b)
            if n >= least:
                own = [s for s in suffixes if s[0][:n] == a[:n]]
                if len({s[1] for s in own}) > 1:
                    found[a[:n]] = (sum(s[2][0] for s in own), min(s[3] for s in own))
    return found


def test_tree_nodes():
    rng = np.random.default_rng(0)
    for _ in range(200):
        made = [bytes(rng.integers(97, 99, rng.integers(2, 9)).tolist()) for _ in range(rng.integers(0, 12))]
        suffixes = [(s, int(rng.integers(0, 2)), [int(rng.integers(1, 4)), 0, 0, 0, 0], (i, 0, 0)) for i, s in enumerate(sorted(made))]
        nodes, shared = [], []
        for node, common in repeats.tree_nodes(suffixes, 2):
            nodes += [node] if node else []
            shared += [] if node else [common]
        texts = [s[0] for s in suffixes]
        assert {texts[n.at[0]][: n.length]: (n.sums[0], n.at) for n in nodes} == naive_nodes(suffixes, 2)
        assert len(nodes) == len(naive_nodes(suffixes, 2))
        neighbours = [
            max([repeats._common(t, texts[j]) for j in (i - 1, i + 1) if 0 <= j < len(texts)], default=0) for i, t in enumerate(texts)
        ]
        assert shared == neighbours


def test_starts_of_maximal_repeats():
    core = prose(3, 30).encode()
    texts = [b"1" + core[:90] + b"x", b"2" + core[:90] + b"y", b"1" + core[:60] + b"z" * 40]
    windows = [len(t) - SIZE + 1 for t in texts]
    assert sorted(repeats.diverse_starts(texts, [1, 1, 1], windows, SIZE)) == [(1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 2, 0), (1, 2, 1)]
    # equal strings of other buckets don't meet
    assert not repeats.diverse_starts(texts[:2], [1, 2], [40, 40], SIZE)


def test_shifted_sums_are_those_of_the_shifted_places():
    def sums(places):
        key = {1: 123456789, 2: 2000000011}
        return [len(places), sum(key[d] for d, _ in places), sum(s for _, s in places), *(sum(key[d] * s for d, s in places) % p for p in repeats.PRIMES)]

    places = [(1, 5), (1, 900), (2, 10**9)]
    assert repeats.shifted(sums(places), 77) == sums([(d, s + 77) for d, s in places])
