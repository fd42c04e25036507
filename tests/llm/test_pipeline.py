"""Every stage against a plain loop over its own input, the whole run, and odd inputs."""

import pytest
from helpers import documents, odd_rows, prose
from test_decontaminate import plain_score
from test_mixing import targets
from test_quality_rules import clean, junk
from test_simhash import plain_fingerprint, plain_roots

import corpus_pipeline
from voltscape.llm import decontaminate, pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ITEMS = [(1, prose(1, 40, 70)), (2, prose(2, 30, 70)), (3, None)]


def rows():
    found = [(i, clean(i), "en", f"s{i % 3}") for i in range(200)]
    found += [(300 + i, junk(i), "en", f"s{i % 3}") for i in range(20)]
    found += [(400 + i, clean(i), "en", "s1") for i in range(40)]
    found += [(500 + i, clean(i) + " " + ITEMS[i % 2][1], "en", "s2") for i in range(12)]
    found += [(600 + i, clean(700 + i).replace(" ", f" user{i}@mail.example ", 1), "en", "s0") for i in range(12)]
    return found


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    documents(spark, rows(), clashing=False).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def stage(spark, name, docs, folder):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, folder)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = stage(spark, "quality rules", docs, folder).cache()
    assert first.columns == COLUMNS
    assert {r.doc_id for r in first.collect()} == {i for i, *_ in rows() if not 300 <= i < 400}

    second = stage(spark, "near-duplicates", first, folder).cache()
    assert second.columns == COLUMNS
    prints = {r.doc_id: plain_fingerprint(r.text) for r in first.collect()}
    root = plain_roots(list(dict.fromkeys(prints.values())))
    groups = {}
    for i, fp in sorted(prints.items()):
        groups.setdefault(root[fp - (1 << 64) if fp >> 63 else fp], i)
    assert sorted(r.doc_id for r in second.collect()) == sorted(groups.values())

    third = stage(spark, "benchmark decontamination", second, folder).cache()
    assert third.columns == COLUMNS
    tokens = decontaminate.tokens
    bad = {
        r.doc_id
        for r in second.collect()
        for _, item in ITEMS
        if item and plain_score(tokens(item), tokens(r.text)) >= decontaminate.THRESHOLD * 2 * len(tokens(item))
    }
    assert bad == set(range(500, 512))
    assert {r.doc_id for r in third.collect()} == {r.doc_id for r in second.collect()} - bad

    fourth = stage(spark, "personal data", third, folder).cache()
    assert fourth.columns == COLUMNS
    texts = {r.doc_id: r.text for r in third.collect()}
    assert fourth.count() == len(texts)
    for r in fourth.collect():
        found = pii.base_spans(texts[r.doc_id])
        assert (r.text == texts[r.doc_id]) == (not found) and not pii.base_spans(r.text)

    last = stage(spark, "mix", fourth, folder)
    sizes = {}
    for r in fourth.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    taken = dict.fromkeys(sizes, 0)
    for r in last.collect():
        taken[r.source] += len(r.text.split())
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) < 600


def test_run(spark, folder):
    once = corpus_pipeline.run(spark, folder)
    again = corpus_pipeline.run(spark, folder)
    assert once.columns == [*COLUMNS, "copy"]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("table", [odd_rows(), []])
def test_odd_rows(spark, folder, table):
    docs = documents(spark, table)
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, folder)
        assert kept.columns == docs.columns, name
        assert kept.count() <= len(table)
    mixed = stage(spark, "mix", docs, folder)
    assert set(mixed.columns) - {"copy"} <= set(docs.columns) and mixed.count() <= 3 * len(table)
