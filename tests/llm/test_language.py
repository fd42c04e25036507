"""Language identification: brute-force Viterbi, held-out accuracy, mixed texts, odd input."""

import itertools
import random
from zlib import crc32

import numpy as np
import pytest
from helpers import documents, odd_rows

from voltscape.llm import language

SYLLABLES = {
    "en": "th wh sh ing er and ould the of".split(),
    "es": "ción ñ ll qu os as mente ar el".split(),
    "ru": "про ста ени ова ти на ск ого".split(),
    "uk": "про ї є ння ти на ськ ого".split(),
}


def prose(lang: str, seed: int, words: int) -> str:
    draw = random.Random(f"{lang}{seed}")
    return " ".join("".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def known(spark):
    rows = [(i, prose(lang, i, 60), lang, "a") for i, lang in enumerate(itertools.islice(itertools.cycle(SYLLABLES), 400))]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def model(known):
    return language.fit(known)


def test_viterbi_is_the_best_labelling():
    draw = np.random.default_rng(3)
    for _ in range(40):
        scores = draw.integers(-6, 1, (9, 3)).astype(float)
        rows = [draw.integers(0, 9, n) for n in (0, 1, 5, 3, 6)]
        for row, labels in zip(rows, language.viterbi(rows, scores, 3.0)):

            def worth(path):
                return sum(scores[r, p] for r, p in zip(row, path)) - 3 * sum(a != b for a, b in zip(path, path[1:]))

            best = max(worth(path) for path in itertools.product(range(3), repeat=len(row)))
            assert len(labels) == len(row)
            assert worth(labels.tolist()) == pytest.approx(best)


def test_word_scores_are_means_over_its_features(model):
    words = ["thing", "a", "ción", "пронаская"]
    together = model.scores(words)
    for i, word in enumerate(words):
        buckets, owner = language.features([word])
        assert set(owner) == {0}
        letters = f" {word} "
        assert len(buckets) == 1 + sum(max(0, len(letters) - n + 1) for n in language.ORDERS)
        plain = language.TRUST * model.logs[buckets].mean(axis=0)
        allowed = model.allowed[language.scripts_of([word])[0]]
        assert together[i][allowed] == pytest.approx(plain[allowed], rel=1e-5)
        assert (together[i][~allowed] == language.BARRED).all()


def test_scripts_narrow_the_candidates(model):
    assert model.langs == ["en", "es", "ru", "uk"]
    words = ["the", "на", "ελ", "日本"]
    assert [language.SCRIPTS[i] for i in language.scripts_of(words)] == ["latin", "cyrillic", "greek", "han"]
    allowed = model.allowed[language.scripts_of(words)].tolist()
    assert allowed == [[True, True, False, False], [False, False, True, True], [False] * 4, [False] * 4]
    # a script of no language decides nothing
    assert (model.scores(words)[2:] == 0).all()


def test_script_table_is_in_order():
    starts = [start for start, _ in language.SCRIPT_STARTS]
    assert starts == sorted(set(starts))


def test_held_out_accuracy(spark, known):
    found = {r.doc_id: r for r in language.predictions(known).collect()}
    assert all(r.held_out == (crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    truth = {r.doc_id: r.lang for r in known.collect()}
    held = [i for i, r in found.items() if r.held_out]
    assert len(held) > 50
    assert np.mean([found[i].lang_pred == truth[i] for i in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in found.values())


def test_labels_of_held_out_rows_and_sources_are_not_used(spark, known):
    """Other labels on held-out rows, and other sources everywhere, change no prediction."""
    other = known.selectExpr(
        "doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'xx', lang) as lang", "'z' as source"
    )
    assert sorted(language.predictions(known).collect()) == sorted(language.predictions(other).collect())


def test_mixed_text_is_cut_into_spans(spark, model):
    parts = [("en", 20), ("ru", 12), ("es", 15), ("uk", 14)]
    texts = [prose(lang, 1000 + i, n) for i, (lang, n) in enumerate(parts)]
    docs = documents(spark, [(1, " ".join(texts), None, None), (2, texts[0] + " 日本", None, None)])
    first, second = sorted(language.languages(docs, model).collect())
    assert [s.lang for s in first.spans] == [lang for lang, _ in parts]
    joined = " ".join(texts)
    hits = 0
    for span, text in zip(first.spans, texts):
        start = joined.index(text)
        hits += max(0, min(span.end, start + len(text)) - max(span.start, start))
    assert hits / len(joined) > 0.9
    assert first.score < 0.6
    # letters of an unknown script belong to no language
    letters = len(texts[0].replace(" ", ""))
    assert second.lang_pred == "en" and second.score == pytest.approx(letters / (letters + 2))


def test_odd_rows(spark, model):
    rows = [*odd_rows(), (8, "12 % 34", "en", "a"), (9, "日本", "en", "a")]
    found = language.languages(documents(spark, rows), model).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(r[0]) for r in rows)
    by_id: dict = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for i in (1, 2, 3, 8):
        assert by_id[i] == [("und", 0.0)]
    assert by_id[9] == [("en", 0.0)]
    assert len(by_id[4]) == 3 and len(set(by_id[4])) <= 2
    assert len(by_id[None]) == 2 and ("und", 0.0) in by_id[None]


def test_empty_and_unlabelled_tables(spark, known):
    assert language.predictions(known.limit(0)).collect() == []
    plain = known.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language.predictions(plain).collect()} == {("und", 0.0)}


def test_a_word_list_beyond_the_kept_words(spark, model, monkeypatch):
    texts = [prose("en", i, 30) for i in range(6)]
    words = language._Words(model)
    whole = [language.spans_of([text], words) for text in texts]
    monkeypatch.setattr(language, "KEPT_WORDS", 10)
    words = language._Words(model)
    assert [language.spans_of([text], words) for text in texts] == whole
