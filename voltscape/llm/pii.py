"""Personal data: base patterns, and terms that disclose them by corpus co-occurrence."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltscape.functions.staging import stage
from voltscape.llm.common import PIECE_BYTES, attach, map_rows
from voltscape.llm.decontaminate import tokens

KINDS = ("email", "ip", "card", "phone")
#: Share of a value's information that a term may give away: above the first it is generalised,
#: above the second it is removed.
GENERALISE, REMOVE = 0.9, 0.99
#: Terms on either side of a value that count as said with it.
NEAR = 16
#: Different surroundings in which a term must be said with a value, and the G-test's least value (one
#: in a thousand by chance).
SUPPORT, SIGNIFICANT = 3, 10.83
#: Letters of a term that needs less support if an address contains it.
NAMED = 4
#: Marks for hashes of disclosing terms, by which words of the documents are passed over before the join.
MARKS = 1 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MANY_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9]){11}")
_TERM = regex.compile(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+")
Span = tuple[int, int, int]


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @: the local part is the run before it, as far back as
    the last match, so long runs without an address cost nothing."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free))
        at = text.find("@", max(at + 1, free))
    return found


def _ips(text: str) -> list[tuple[int, int]]:
    """A start inside a run of digits can't match where the run's start didn't, and possessive
    runs don't try shorter ones."""
    found, at = [], 0
    while m := _IP_START.search(text, at):
        full = _IP.match(text, m.start())
        if full:
            found.append(full.span())
            at = full.end()
        else:
            at = m.end()
    return [(a, b) for a, b in found if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text[a:b].split("."))]


_IP_START = re.compile(r"[0-9]++")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _cards(text: str) -> list[tuple[int, int]]:
    if not _MANY_DIGITS.search(text):
        return []
    spans = (m.span() for m in _CARD.finditer(text))
    return [(a, b) for a, b in spans if b - a >= 12 and 12 <= len(d := _digits(text[a:b])) <= 19 and luhn(d)]


def _phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns, by start and kind."""
    ips = _ips(text) if text.count(".") >= 3 and _IP.search(text) else []
    each = (_emails(text), ips, _cards(text), _phones(text))
    return sorted(((a, b, kind) for kind, spans in enumerate(each) for a, b in spans), key=lambda s: (s[0], s[2], s[1]))


def value_of(text: str, kind: int) -> str:
    """The protected value behind a match, however it is written."""
    return text.lower() if kind < 2 else _digits(text)


def outside(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """(start, end) of the terms that no base span touches."""
    at, ends = 0, 0
    for m in _TERM.finditer(text):
        # `ends`: the furthest end of the spans that start before the term's end
        while at < len(base) and base[at][0] < m.end():
            ends = max(ends, base[at][1])
            at += 1
        if ends <= m.start():
            yield m.span()


def contexts(text: str, base: list[Span]) -> list[dict]:
    """kind, value, term, context, named: the different terms within NEAR terms of each value, outside
    all base spans; of several places the one with the smallest context, the hash of all terms
    there. named: an e-mail address whose local part contains the term."""
    if not base:
        return []
    spans = list(outside(text, base))
    terms = [text[a:b].lower() for a, b in spans]
    starts = [a for a, _ in spans]
    found: dict[tuple[int, str, str], int] = {}
    for a, b, kind in base:
        at = bisect_left(starts, a)
        around = terms[max(0, at - NEAR) : at + NEAR]
        context = xxhash.xxh64_intdigest("\n".join(around)) - (1 << 63)
        value = value_of(text[a:b], kind)
        for term in set(around):
            key = (kind, value, term)
            found[key] = min(found.get(key, context), context)
    return [
        {"kind": kind, "value": value, "term": term, "context": context, "named": _names(kind, value, term)}
        for (kind, value, term), context in found.items()
    ]


def _names(kind: int, value: str, term: str) -> bool:
    return kind == 0 and len(term) >= NAMED and term in value.partition("@")[0]


def _base(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): the spans of the base patterns, the protected values and the
    terms near them. `hash` tells texts of one doc_id apart."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    near = "array<struct<kind: int, value: string, term: string, context: long, named: boolean>>"
    schema = f"doc_id {id_type}, hash long, base array<struct<start: int, end: int, kind: int>>, found array<struct<kind: int, value: string>>, near {near}"

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "hash": batch["hash"], "base": [], "found": [], "near": []}
        for text in batch["text"]:
            base = base_spans(text) if text else []
            out["base"].append([dict(zip(("start", "end", "kind"), s)) for s in base])
            out["found"].append([{"kind": k, "value": value_of(text[a:b], k)} for a, b, k in base])
            out["near"].append(contexts(text, base))
        return out

    return map_rows(docs.selectExpr("doc_id", "xxhash64(text) as hash", "text"), schema, kernel)


def _marked(terms: DataFrame) -> Broadcast:
    """Marks of the hashes of all terms, MARKS bytes."""
    marks = bytearray(MARKS)
    for row in terms.selectExpr(f"crc32(encode(term, 'UTF-8')) % {MARKS} as mark").distinct().toLocalIterator():
        marks[row.mark] = 1
    return terms.sparkSession.sparkContext.broadcast(bytes(marks))


def _term_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n_term): documents with the term, for the `wanted` terms. Words whose hash none of
    them has are passed over where they are read; counts are made per batch before the shuffle."""
    shared = _marked(wanted)

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        own, counts = shared.value, Counter()
        for text in batch["text"]:
            if text:
                counts.update(word for word in set(tokens(text)) if own[crc32(word) % MARKS])
        return {"term": [t.decode("utf-8", "replace") for t in counts], "n": list(counts.values())}

    # the more texts are counted together, the fewer rows are shuffled
    found = map_rows(docs.select("text"), "term string, n long", kernel, 4 * PIECE_BYTES)
    return attach(found.groupBy("term").agg(F.sum("n").alias("n_term")), wanted, ["term"])


def _g(total: int) -> str:
    """The G-test's value for a term and a value in n_both documents together."""
    cells = {
        "n_both": "cast(n_value as double) * n_term",
        "(n_value - n_both)": f"cast(n_value as double) * ({total} - n_term)",
        "(n_term - n_both)": f"cast(n_term as double) * ({total} - n_value)",
        f"({total} - n_value - n_term + n_both)": f"cast({total} - n_value as double) * ({total} - n_term)",
    }
    parts = (f"if({o} > 0 and {e} > 0, {o} * ln({o} * {total}D / ({e})), 0D)" for o, e in cells.items())
    return f"2 * ({' + '.join(parts)})"


def disclosures(docs: DataFrame, found: DataFrame, threshold: float = GENERALISE) -> DataFrame:
    """(kind, value, term, share): terms that give away at least `threshold` of a value's
    information.

    Over all N documents, the information of a value is ln(N / n_value); a term gives away their
    pointwise mutual information ln(N n_both / (n_value n_term)). n_both counts the different
    surroundings, one per document at most, in which the term stands within NEAR terms of the value, so copies of a passage
    are no evidence; n_value and n_term count documents. One co-occurrence is no estimate: n_both
    must be SUPPORT at least and significant by the G-test, or the term part of the address
    itself. A value in every document carries no information and is disclosed by nothing.
    """
    total = found.count()
    near = found.selectExpr("inline(near)").groupBy("kind", "value", "term").agg(
        F.count_distinct("context").alias("n_both"), F.max("named").alias("named")
    )
    both = stage(near.where(f"n_both >= {SUPPORT} or named"), "both")
    terms = stage(both.select("term").distinct(), "terms")
    values = found.selectExpr("inline(array_distinct(found))").groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_value"))
    known = stage(attach(values, stage(both.select("kind", "value").distinct(), "values"), ["kind", "value"]), "values")
    counted = attach(attach(both, known, ["kind", "value"]), stage(_term_counts(docs, terms), "counts"), ["term"])
    # surroundings and whole texts may be cut into words differently
    counted = counted.withColumn("n_term", F.greatest("n_term", "n_both"))
    share = f"ln({total}D * n_both / (cast(n_value as double) * n_term)) / nullif(ln({total}D / n_value), 0D)"
    shares = counted.selectExpr("kind", "value", "term", f"{share} as share", f"named or {_g(total)} >= {SIGNIFICANT}D as sure")
    return shares.where(f"sure and share >= {threshold}").drop("sure")


def _occurrences(docs: DataFrame, told: DataFrame) -> DataFrame:
    """(doc_id, hash, start, end, share) of every occurrence of the terms of `told` outside base
    spans. Words whose hash no term has are passed over where they are read; the join decides."""
    shared = _marked(told)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        own, rows = shared.value, []
        for doc_id, key, text in zip(batch["doc_id"], batch["hash"], batch["text"]):
            if text and any(own[crc32(word) % MARKS] for word in set(tokens(text))):
                for a, b in outside(text, base_spans(text)):
                    term = text[a:b].lower()
                    if own[crc32(term.encode("utf-8", "replace")) % MARKS]:
                        rows.append((doc_id, key, term, a, b))
        names = ("doc_id", "hash", "term", "start", "end")
        return dict(zip(names, map(list, zip(*rows)))) if rows else {name: [] for name in names}

    schema = f"doc_id {kind}, hash long, term string, start int, end int"
    seen = map_rows(docs.selectExpr("doc_id", "xxhash64(text) as hash", "text"), schema, kernel)
    return attach(seen, told, ["term"])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, base, terms) for every row of `docs` (doc_id, text, any more).

    base: start, end, kind (position in KINDS) of the base patterns, by start and kind; terms:
    start, end, share of disclosing terms, wherever they stand, in documents without a base value
    too; the share is the largest that the term gives away of any value. Positions are code points,
    end exclusive. NULL and empty texts have none. Rows repeated with the same text get the same
    spans; rows of one doc_id with different texts are told apart by the hash of the text; a NULL
    doc_id is an id like others. An empty table gives an empty result; other columns are ignored.
    """
    found = stage(_base(docs), "personal")
    told = stage(disclosures(docs, found).groupBy("term").agg(F.max("share").alias("share")), "disclosures")
    nothing = "cast(array() as array<struct<start: int, end: int, share: double>>) as terms"
    if told.isEmpty():
        return found.selectExpr("doc_id", "hash", "base", nothing)
    spans = _occurrences(docs, told).groupBy("doc_id", "hash", "start", "end").agg(F.max("share").alias("share"))
    per_doc = spans.groupBy("doc_id", "hash").agg(F.expr("array_sort(collect_list(struct(start, end, share))) as _terms"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_id", "hash": "_hash"})
    kind = "array<struct<start: int, end: int, share: double>>"
    return found.join(per_doc, F.expr("doc_id <=> _id and hash <=> _hash"), "left").selectExpr(
        "doc_id", "hash", "base", f"coalesce(_terms, cast(array() as {kind})) as terms"
    )


def sanitised(text: str, base: list, terms: list) -> str:
    """`text` with base values replaced by their kind, and disclosing terms generalised to what
    they look like or removed. Overlapping spans become one, named by the first."""
    marks = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base]
    for s in terms:
        word = text[s["start"] : s["end"]]
        kind = "[NUMBER]" if word[:1].isdigit() else "[NAME]" if word[:1].isupper() else "[TERM]"
        marks.append((s["start"], s["end"], "[REMOVED]" if s["share"] >= REMOVE else kind))
    out, at = [], 0
    for start, end, label in sorted(marks):
        if start >= at:
            out += [text[at:start], label]
        at = max(at, end)
    return "".join([*out, text[at:]]) if marks else text


@F.pandas_udf(T.StringType())
def _sanitised(texts: pd.Series, base: pd.Series, terms: pd.Series) -> pd.Series:
    rows = zip(texts, base, terms)
    return pd.Series([None if t is None else sanitised(t, b, s) for t, b, s in rows], dtype=object)


def sanitised_rows(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with personal data and disclosing terms taken out of `text`; rows
    without any are unchanged, and no row goes. All columns are kept."""
    found = personal_data(docs).where("size(base) > 0 or size(terms) > 0").distinct().withColumnsRenamed({"doc_id": "_id", "hash": "_same"})
    packed = docs.select(F.struct("*").alias("_row"), "doc_id", "text", F.xxhash64("text").alias("hash"))
    joined = packed.join(found, F.expr("doc_id <=> _id and hash = _same"), "left")
    # only the texts that change go through Python
    clean = _sanitised(F.when(F.col("base").isNotNull(), F.col("text")), "base", "terms")
    changed = joined.withColumn("_clean", F.coalesce(clean, F.col("text")))
    return changed.select(F.col("_row").withField("text", F.col("_clean")).alias("_row")).select("_row.*")
