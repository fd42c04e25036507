"""Base patterns against plain regular expressions, disclosure against plain counts."""

import math
import random
import re

import pytest
from helpers import documents, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from voltscape.llm import pii
from voltscape.llm.decontaminate import tokens

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [(a, b, k) for a, k, b in sorted(found)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a@.%x-+ ()0123456789é", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c%x@d.e",
        "a@b.c@d.e.",
        "1.2.3.4.5.6.7.8",
        "300.1.1.1 01.002.0003.4 0000000000255.1.1.1",
        "4111 1111 1111 1111, 4111-1111-1111-1112",
        "+1 (988) 555-2485 and +49.30.123456)",
        "x" * 50_000 + "@" + "y" * 50_000,
        "1" * 50_000 + ".2.3",
        "+1" + " " * 50_000,
    ],
)
def test_base_spans_by_hand(text):
    assert pii.base_spans(text) == plain(text)


def rows_with_values():
    """Names said near an address in many documents, others in one only, and rare words of all kinds."""
    rng = random.Random(1)
    rows = []
    for i in range(400):
        words = prose(i, 60, 200).split() + [f"seldom{i % 130}", f"never{i}"]
        if i % 10 == 0:
            words[30:30] = [f"Rare{i // 80}", f"user{i // 80}@mail.example", f"unique{i}"]
        if i % 25 == 0:
            words[5:5] = ["call", "+1 (319) 555-5132", "now"]
        if i % 97 == 0:
            words[9:9] = ["Wendeline", "wendeline.k@mail.example"]
        if rng.random() < 0.01:
            words.append(f"Rare{i // 80}")
        rows.append((i, " ".join(words), "en", "a"))
    # copies are no evidence
    rows += [(500 + i, f"{prose(1, 20)} copied d@mail.example {prose(2, 20)}", "en", "a") for i in range(6)]
    return rows


def plain_terms(rows):
    """{doc_id: {(start, end)}} of the terms that give enough away."""
    base = {i: pii.base_spans(t) for i, t, *_ in rows}
    spans = {i: list(pii.outside(t, base[i])) for i, t, *_ in rows}
    near = {}
    for i, text, *_ in rows:
        for a, b, kind in base[i]:
            before = [s for s in spans[i] if s[0] < a][-pii.NEAR :]
            after = [s for s in spans[i] if s[0] > a][: pii.NEAR]
            around = [text[x:y].lower() for x, y in before + after]
            for term in around:
                near.setdefault((kind, pii.value_of(text[a:b], kind), term), {}).setdefault(i, set()).add(tuple(around))
    total, told = len(rows), set()
    for (kind, value, term), where in near.items():
        both = len({frozenset(c) for c in where.values()})
        n_value = sum(any((k, pii.value_of(t[a:b], k)) == (kind, value) for a, b, k in base[j]) for j, t, *_ in rows)
        n_term = sum(term.encode() in tokens(t) for _, t, *_ in rows)
        named = kind == 0 and len(term) >= 4 and term in value.split("@")[0]
        table = [[both, n_value - both], [n_term - both, total - n_value - n_term + both]]
        expected = [[n_value * n_term / total, n_value * (total - n_term) / total],
                    [n_term * (total - n_value) / total, (total - n_value) * (total - n_term) / total]]
        g = 2 * sum(o * math.log(o / e) for r, q in zip(table, expected) for o, e in zip(r, q) if o > 0)
        enough = math.log(total * both / (n_value * n_term)) >= pii.GENERALISE * math.log(total / n_value)
        if enough and (named or (both >= 3 and g >= 10.83)):
            told.add(term)
    return {
        i: hits for i, t, *_ in rows if (hits := {(a, b) for a, b in spans[i] if t[a:b].lower() in told})
    }


def test_disclosing_terms(spark):
    rows = rows_with_values()
    got = pii.personal_data(documents(spark, rows)).collect()
    assert {r.doc_id: [(s.start, s.end, s.kind) for s in r.base] for r in got} == {i: pii.base_spans(t) for i, t, *_ in rows}
    wanted = plain_terms(rows)
    assert {r.doc_id: {(s.start, s.end) for s in r.terms} for r in got if r.terms} == wanted
    texts = {i: t for i, t, *_ in rows}
    words = {texts[i][a:b] for i, hits in wanted.items() for a, b in hits}
    assert words == {"Wendeline", "call", "now", *(f"Rare{k}" for k in range(5))}


def test_sanitised_rows(spark):
    rows = rows_with_values()
    docs = documents(spark, rows)
    frame = pii.sanitised_rows(docs)
    assert frame.columns == docs.columns
    got = {r.doc_id: r.text for r in frame.collect()}
    assert len(got) == len(rows)
    clean = [(i, text) for i, text, *_ in rows if not pii.base_spans(text)]
    # rare words are no disclosure: only the names go from documents without a value
    assert all(got[i] == text for i, text in clean if "Rare" not in text)
    assert sum(got[i] == text for i, text in clean) >= 0.95 * len(clean)
    for i, text, *_ in rows:
        assert "Rare" not in got[i] and "Wendeline" not in got[i] and not pii.base_spans(got[i])
        assert (f"never{i} " in text + " ") == (f"never{i} " in got[i] + " ")


def test_overlaps():
    text = "+4111111111111111 Bob"
    base = [{"start": 0, "end": 17, "kind": 3}, {"start": 1, "end": 17, "kind": 2}]
    assert pii.sanitised(text, base, [{"start": 18, "end": 21, "share": 0.95}]) == "[PHONE] [NAME]"


def test_odd_rows(spark):
    rows = [*odd_rows(), (8, "a@b.cc", "en", "a"), (8, "a@b.cc", "en", "a"), (8, "x", None, None), (None, "c@d.ee near", "en", None)]
    docs = documents(spark, rows)
    got = pii.personal_data(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, len(r.base)) for r in got if r.base) == [(0, 1), (8, 1), (8, 1)]
    clean = pii.sanitised_rows(docs).collect()
    assert len(clean) == len(rows) and [r.text for r in clean if r.doc_id == 8].count("[EMAIL]") == 2
    assert pii.personal_data(documents(spark, [])).count() == 0
    assert pii.sanitised_rows(documents(spark, [])).count() == 0


def test_terms_far_from_the_value(spark):
    far = prose(1, 20)
    rows = [(i, prose(100 + i, 40), "en", "a") for i in range(200)]
    rows += [(300, f"Zorkan zorkan7@mail.example {far} Zorkan said", "en", "a")]
    rows += [(301, f"{far} Belmar, +1 (377) 555-0271, 10.20.30.40, b@mail.example", "en", "a")]
    # in four documents with the value and one without
    rows += [(310 + i, f"{prose(i, 9)} tarvik {prose(i, 12)} c@mail.example", "en", "a") for i in range(4)]
    rows += [(320, f"{prose(7, 12)} Tarvik {prose(8, 12)}", "en", "a")]
    docs = documents(spark, rows)
    texts = {r[0]: r[1] for r in rows}
    marked = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.terms] for r in pii.personal_data(docs).collect()}
    # part of the address; a word that occurs once beside one address is no estimate
    assert marked[300] == ["Zorkan", "Zorkan"] and marked[301] == []
    assert marked[320] == ["Tarvik"] and all("tarvik" in marked[310 + i] for i in range(4))
    clean = {r.doc_id: r.text for r in pii.sanitised_rows(docs).collect()}
    assert "Zorkan" not in clean[300] and "Tarvik" not in clean[320] and clean[0] == texts[0]
