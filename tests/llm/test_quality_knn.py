"""Held-out accuracy, exact votes, and odd inputs."""

import zlib

import numpy as np
import pytest
from helpers import documents, odd_rows, prose

from voltscape.llm import quality_knn as knn


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def tables(spark):
    rows, marks = [], []
    for i in range(400):
        good = i % 4 != 0
        text = prose(i, 40 + i * 7 % 200)
        bad = [text.upper().replace(" ", "!! "), text.replace(" ", " | "), text.split()[0].join([" "] * 90)][i % 3]
        rows.append((i, text if good else bad, "en", "a"))
        if i % 5:
            marks.append((i, int(good), 0, "x"))
    return documents(spark, [*rows, *odd_rows()]), labels(spark, marks)


def test_held_out_accuracy(tables):
    docs, marks = tables
    got = knn.predictions(docs, marks).collect()
    assert len(got) == 400 + len(odd_rows())
    held = [r for r in got if r.held_out and r.doc_id >= 10]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    right = sum(r.predicted == int(r.doc_id % 4 != 0) for r in held)
    assert right >= 0.97 * len(held) > 50
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    # the empty texts of the odd rows stand beside documents of the same id
    assert sum(r.score == 0 for r in got if r.doc_id is None or r.doc_id < 4) >= 4


def test_held_out_labels_have_no_part(spark, tables):
    docs, marks = tables
    flipped = marks.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality")
    def scores(m):
        return sorted((r.doc_id or -1, r.score) for r in knn.predictions(docs, m).collect())

    assert scores(marks) == scores(flipped)


def test_votes_are_exact():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.1, (40, knn.TERMS)).astype(np.float32)
    model = knn.Model(np.ones(knn.TRIGRAMS, np.float32), knn._basis(knn._weighted(counts, np.ones(knn.TRIGRAMS, np.float32))), np.zeros((0, 0)), rng.integers(0, 2, 40))
    model.vectors = model.latent(counts)
    for row, score in zip(counts, model.scores(counts)):
        cosine = model.vectors @ model.latent(row[None])[0]
        near = np.argsort(-cosine)[: knn.NEIGHBOURS]
        votes = np.clip(cosine[near].astype(float), 0, 1) ** knn.SHARPNESS
        assert score == pytest.approx((votes * model.labels[near]).sum() / votes.sum(), abs=1e-5)


def test_empty_tables(spark, tables):
    docs, marks = tables
    assert knn.predictions(documents(spark, []), marks).count() == 0
    got = knn.predictions(docs, marks.limit(0)).collect()
    assert {r.score for r in got} == {0.0}


def test_equally_near_neighbours_go_by_column():
    draw = np.random.default_rng(0)
    cosine = draw.integers(0, 4, (50, 30)).astype(np.float32)
    got = knn.nearest(cosine, 7)
    for row, columns in zip(cosine, got):
        assert columns.tolist() == sorted(sorted(range(30), key=lambda j: (-row[j], j))[:7])


def test_repeated_ids_fit_one_text_each(spark):
    rows = [(i % 6, prose(i, 30), "en", "a") for i in range(60)]
    docs = documents(spark, rows, clashing=False)
    marks = spark.createDataFrame([(i, i % 2) for i in range(6)] * 3, "doc_id long, label int")
    one, two = (knn.fit(docs.repartition(n), marks, 6) for n in (1, 5))
    assert len(one.labels) == 6 and (one.labels == two.labels).all()
    assert np.allclose(one.vectors @ one.vectors.T, two.vectors @ two.vectors.T, atol=1e-4)
