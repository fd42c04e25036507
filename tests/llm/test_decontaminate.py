"""Alignment against a plain table, planted copies and odd inputs."""

import random

import numpy as np
from helpers import documents, odd_rows, prose

from voltscape.llm import decontaminate as dc


def plain_score(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[-1] - 1))
        above = row
        best = max(best, *row)
    return best


def test_align_equals_plain():
    rng = random.Random(0)
    for _ in range(200):
        a = np.array([rng.randrange(4) for _ in range(rng.randrange(1, 12))])
        b = np.array([rng.randrange(4) for _ in range(rng.randrange(1, 20))])
        score, end = dc.align(a, b)
        assert score == plain_score(a, b)
        assert plain_score(a, b[:end]) == score


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def edited(words, rng, share):
    out = []
    for w in words:
        draw = rng.random()
        out += [] if draw < share / 3 else [w, "extra"] if draw < 2 * share / 3 else ["other"] if draw < share else [w]
    return out


def test_copies_and_edits_are_found(spark):
    rng = random.Random(5)
    items = [(i, prose(1000 + i, 40, 60)) for i in range(20)]
    rows, wanted = [], set()
    for i, text in items:
        for k, share in enumerate((0.0, 0.1, 0.2)):
            passage = " ".join(edited(text.split(), rng, share))
            rows.append((10 * i + k, f"{prose(i, 300, 60)}\n{passage.upper()}. {prose(i + 50, 200, 60)}", "en", "a"))
            wanted.add((10 * i + k, i))
    rows += [(1000 + i, prose(5000 + i, 400, 60), "en", "a") for i in range(50)]
    got = dc.contaminated(documents(spark, rows), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == wanted
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert texts[r.doc_id][r.start : r.end] == r.passage
        if r.doc_id % 10 == 0:
            assert r.score == 1.0 and dc.tokens(r.passage) == dc.tokens(items[r.item_id][1])


def test_found_as_by_aligning_everything(spark):
    """Seeds lose nothing on these tables: every document against every item."""
    items = [(i, prose(70 + i, 25, 30)) for i in range(6)]
    rows = [(i, prose(i, 60, 30) + " " + " ".join(prose(70 + i % 9, 25, 30).split()[: 25 - i]), "en", "a") for i in range(18)]
    wanted = {}
    for doc_id, text, *_ in rows:
        for item_id, item in items:
            a, b = dc.tokens(item), dc.tokens(text)
            if plain_score(a, b) >= dc.THRESHOLD * 2 * len(a):
                wanted[doc_id, item_id] = plain_score(a, b) / (2 * len(a))
    got = {(r.doc_id, r.item_id): r.score for r in dc.contaminated(documents(spark, rows), benchmark(spark, items)).collect()}
    assert got == wanted and len(wanted) > 3


def test_common_passage_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(dc, "CHUNK_WORDS", 50)
    items = [(i, prose(300 + i, 30)) for i in range(5)]
    rows = [(i, prose(i, 20) + " " + items[3][1] + " " + prose(i + 900, 20), "en", "a") for i in range(60)]
    rows += [(i, prose(i, 90), "en", "a") for i in range(100, 120)]
    got = dc.contaminated(documents(spark, rows), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, 3) for i in range(60)}


def test_odd_rows(spark):
    items = [(1, None), (2, ""), (3, "two words"), (None, prose(2, 40)), (4, prose(2, 40)), (5, prose(99, 50))]
    docs = documents(spark, odd_rows())
    got = [(r.doc_id, r.item_id) for r in dc.contaminated(docs, benchmark(spark, items)).collect()]
    assert sorted(got, key=str) == sorted([(d, i) for d in (4, 4, 5) for i in (None, 4)] + [(6, 5)], key=str)
    kept = dc.clean_rows(docs, benchmark(spark, items))
    assert kept.columns == docs.columns
    # the other text of document 4 is clean and stays
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (i or 0, t or "") for i, t, *_ in odd_rows() if t not in (prose(2, 120), prose(99, 30_000))
    )
    assert dc.contaminated(documents(spark, []), benchmark(spark, items)).count() == 0
    assert dc.contaminated(docs, benchmark(spark, [])).count() == 0
    assert dc.clean_rows(docs, benchmark(spark, [])).count() == len(odd_rows())


def test_parts_of_long_items(spark):
    items = [(1, prose(41, 300)), (2, prose(42, 60)), (3, prose(43, 300))]
    words = [text.split() for _, text in items]
    parts = [(1, words[0][150:250]), (2, words[1][:20]), (3, words[2][100:113])]
    rows = [(i, f"{prose(i, 80)} {' '.join(part)} {prose(i + 50, 80)}", "en", "a") for i, part in parts]
    rows += [(10, f"{prose(7, 80)} {' '.join(words[2][100:108])} {prose(8, 80)}", "en", "a")]
    docs = documents(spark, rows)
    got = {(r.doc_id, r.item_id): r for r in dc.contaminated(docs, benchmark(spark, items)).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3)}
    for i, part in parts:
        row = got[i, i]
        assert row.passage == " ".join(part) and row.part_score == 1.0 and row.score == len(part) / len(words[i - 1])
    assert [r.doc_id for r in dc.clean_rows(docs, benchmark(spark, items)).collect()] == [10]


def test_regular_and_random_edits_are_found(spark):
    """What the alignment accepts, the seeds find: every k-th word replaced, and random edits up to
    the threshold."""
    rng = random.Random(9)
    items = [(i, prose(400 + i, 60, 300)) for i in range(12)]
    rows, wanted = [], set()
    for i, text in items:
        words = text.split()
        copies = [[f"new{rng.randrange(999)}" if j % k == k - 1 else w for j, w in enumerate(words)] for k in (3, 4, 5)]
        copies += [edited(words, rng, share) for share in (0.2, 0.3, 0.4)]
        for k, copy in enumerate(copies):
            rows.append((100 * i + k, f"{prose(i * 7 + k, 150, 300)} {' '.join(copy)} {prose(i * 9 + k, 90, 300)}", "en", "a"))
            if plain_score(words, [w.lower() for w in rows[-1][1].split()]) >= 2 * min(dc.THRESHOLD * len(words), dc.PASSAGE_WORDS):
                wanted.add((100 * i + k, i))
    rows += [(5000 + i, prose(6000 + i, 300, 300), "en", "a") for i in range(60)]
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(documents(spark, rows), benchmark(spark, items)).collect()}
    assert len(wanted) > 60 and got <= wanted
    assert {(100 * i, i) for i, _ in items} <= got  # every third word
    assert len(got) >= 0.95 * len(wanted)


def test_blocks_are_bounded_by_words(monkeypatch):
    from pyspark.sql import Row

    rows = [Row(item_id=i, text="a b " * 10) for i in range(10)]
    monkeypatch.setattr(dc, "BLOCK_WORDS", 50)
    assert [len(block) for block in dc._blocks(iter(rows))] == [3, 3, 3, 1]
    monkeypatch.setattr(dc, "BLOCK_ITEMS", 2)
    assert [len(block) for block in dc._blocks(iter(rows))] == [2] * 5
