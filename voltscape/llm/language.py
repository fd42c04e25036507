"""Language identification: script ranges narrow the candidates of each word, then Viterbi over
per-word scores with a switching penalty labels the spans of mixed-language text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltscape.llm.common import PIECE_BYTES, map_rows

#: Documents per language that are learnt from, about: the bound of the fitted sample.
FIT_ROWS = 4000
#: Hashed features of a word; the model holds this many numbers per language value.
BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
#: A word counts as much as this many independent features.
TRUST = 3.0
#: What a change of language costs, in natural logarithms.
SWITCH = 8.0
SMOOTHING = 0.2
#: Share of a language's words that a script needs to be one of the language's.
SCRIPT_SHARE = 0.01
#: Score of a word in a language that does not use its script.
BARRED = -1e6
#: Different words whose scores a task keeps.
KEPT_WORDS = 300_000
UNKNOWN = "und"

# First code points of script ranges, and the script from there on ("" for none).
SCRIPT_STARTS = [
    (0x0000, ""), (0x0041, "latin"), (0x0250, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x07C0, "nko"),
    (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"), (0x1400, "canadian"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1D00, "latin"), (0x1F00, "greek"), (0x2000, ""),
    (0x2C60, "latin"), (0x2C80, "coptic"), (0x2D00, "georgian"), (0x2D30, "tifinagh"), (0x2DE0, "cyrillic"), (0x2E80, "han"),
    (0x3040, "kana"), (0x3100, "bopomofo"), (0x3130, "hangul"), (0x31F0, "kana"), (0x3400, "han"), (0xA000, "yi"),
    (0xA640, "cyrillic"), (0xA720, "latin"), (0xAC00, "hangul"), (0xD800, ""), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE70, "arabic"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"),
    (0x10000, ""), (0x20000, "han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_STARTS = np.array([start for start, _ in SCRIPT_STARTS])
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def scripts_of(words: list[str]) -> np.ndarray:
    """Position in SCRIPTS of each word's first letter."""
    first = _codes("".join(word[0] for word in words))
    return _SCRIPT[np.searchsorted(_STARTS, first, "right") - 1]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * _MIX
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, word): the hashed letter runs of ORDERS of each lower-case word, its ends
    included, and the whole word."""
    codes = _codes(f" {' '.join(words)} ").astype(np.uint64)
    space = codes == 32
    word = np.cumsum(space) - 1
    buckets, owners = [], []
    for n in ORDERS:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        hashes = np.full(count, n, np.uint64)
        inner = np.zeros(count, bool)
        for j in range(n):
            hashes = hashes * _STEP + codes[j : j + count]
            if 0 < j < n - 1:
                inner |= space[j : j + count]
        use = np.flatnonzero(~inner)
        buckets.append(_bucket(hashes[use]))
        owners.append(word[use])
    starts = np.flatnonzero(space)[:-1]
    with np.errstate(over="ignore"):
        place = (np.arange(len(codes)) - starts[np.minimum(word, len(starts) - 1)]).astype(np.uint64)
        mixed = (codes * _MIX) ^ (place * _STEP)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _STEP
        whole = np.add.reduceat(np.where(space, np.uint64(0), mixed), starts)
    return np.concatenate([*buckets, _bucket(whole)]), np.concatenate([*owners, np.arange(len(words))])


@dataclass
class Model:
    """What is broadcast: BUCKETS numbers and a row of script marks for each language."""

    langs: list[str]
    logs: np.ndarray  # buckets x languages
    allowed: np.ndarray  # scripts x languages

    def scores(self, words: list[str]) -> np.ndarray:
        """Score of each lower-case word in each language: the mean log probability of its
        features times TRUST, barred where the language does not use its script. A word in a script
        of no language scores the same in all."""
        buckets, owner = features(words)
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(words))
        sums = np.add.reduceat(self.logs[buckets[order]], np.r_[0, counts.cumsum()[:-1]], axis=0)
        found = TRUST * sums / counts[:, None]
        allowed = self.allowed[scripts_of(words)]
        found = np.where(allowed, found, BARRED)
        found[~allowed.any(axis=1)] = 0
        return found

    def known(self, words: list[str]) -> np.ndarray:
        """Whether any language uses the word's script."""
        return self.allowed[scripts_of(words)].any(axis=1)


def _counted(docs: DataFrame) -> DataFrame:
    """(lang, feature, n): features of the words of `docs` (lang, text), summed; features from
    BUCKETS on count words by script."""

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        words: dict[str, Counter[str]] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            words.setdefault(lang, Counter()).update(_WORD.findall(text.lower()))
        out: dict[str, list] = {"lang": [], "feature": [], "n": []}
        for lang, own in words.items():
            if own:
                listed, often = list(own), np.fromiter(own.values(), np.int64, len(own))
                buckets, owner = features(listed)
                total = np.bincount(buckets, often[owner], BUCKETS + len(SCRIPTS))
                total[BUCKETS:] = np.bincount(scripts_of(listed), often, len(SCRIPTS))
                used = np.flatnonzero(total)
                out["lang"] += [lang] * len(used)
                out["feature"] += used.tolist()
                out["n"] += total[used].astype(np.int64).tolist()
        return out

    found = map_rows(docs, "lang string, feature int, n long", kernel, 2 * PIECE_BYTES)
    return found.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Word model of each language value in `docs` (doc_id, text, lang), from about `rows` documents
    of each: those whose hash of id and text lies below rows / (documents of the language). The
    counts are made where the texts are; the driver gets their sums, BUCKETS per language at most.
    Rows without text or language are not learnt from; an empty table gives a model without
    languages."""
    known = docs.where("text is not null and lang is not null").select("doc_id", "lang", "text")
    totals = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    sampled = known.join(F.broadcast(totals), "lang").where(
        f"pmod(xxhash64(doc_id, text), 1000003) < 1000003D * {rows} / _n"
    )
    langs = sorted(row.lang for row in totals.collect())
    place = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(langs)))
    if langs:
        table = _counted(sampled.select("lang", "text")).toArrow()
        column = np.array([place[lang] for lang in table["lang"].to_pylist()], np.int64)
        counts[table["feature"].to_numpy(), column] = table["n"].to_numpy()
    hits, by_script = counts[:BUCKETS], counts[BUCKETS:]
    logs = np.log((hits + SMOOTHING) / (hits.sum(axis=0) + SMOOTHING * BUCKETS))
    allowed = (by_script > 0) & (by_script >= SCRIPT_SHARE * by_script.sum(axis=0))
    return Model(langs, logs.astype(np.float32), allowed)


def viterbi(rows: list[np.ndarray], scores: np.ndarray, penalty: float = SWITCH) -> list[np.ndarray]:
    """The best language of every word of each text; `rows` points into `scores`, words x languages.

    The best labelling has the largest sum of scores less `penalty` for each change. All texts go
    word by word together, longest first. Ties keep the language, else the first one counts.
    """
    order = sorted(range(len(rows)), key=lambda i: -len(rows[i]))
    lengths = np.array([len(rows[i]) for i in order])
    longest = int(lengths[0]) if len(rows) else 0
    flat = np.concatenate([rows[i] for i in order]) if longest else np.zeros(0, np.int64)
    starts = np.r_[0, lengths.cumsum()[:-1]] if len(rows) else lengths
    # texts with more than t words
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    best = scores[flat[starts[: active[0]]]].astype(float) if longest else np.zeros((0, 0))
    last = best.copy()
    for t in range(1, longest):
        now = best[: active[t]]
        peak = now.max(axis=1, keepdims=True)
        stay = now >= peak - penalty
        kept.append((stay, now.argmax(axis=1)))
        best = np.where(stay, now, peak - penalty) - peak + scores[flat[starts[: active[t]] + t]]
        last[: active[t]] = best
    labels = np.zeros(len(flat), np.int64)
    current = last.argmax(axis=1) if longest else np.zeros(0, np.int64)
    each = np.arange(len(current))
    for t in range(longest - 1, -1, -1):
        n = active[t]
        labels[starts[:n] + t] = current[:n]
        if t:
            stay, peak = kept[t - 1]
            current[:n] = np.where(stay[each[:n], current[:n]], current[:n], peak)
    out: list[np.ndarray] = [labels[:0]] * len(rows)
    for i, start, length in zip(order, starts, lengths):
        out[i] = labels[start : start + length]
    return out


@dataclass
class _Words:
    """Scores of the words a task has met."""

    model: Model
    place: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Rows of `scores` for the words of each text."""
        if len(self.place) > KEPT_WORDS:
            self.place, self.scores, self.known = {}, self.scores[:0], self.known[:0]
        fresh = list({word for words in texts for word in words} - self.place.keys())
        if fresh:
            found = self.model.scores(fresh)
            self.scores = np.concatenate([self.scores, found]) if len(self.scores) else found
            self.known = np.r_[self.known, self.model.known(fresh)]
            at = len(self.place)
            self.place.update(zip(fresh, range(at, at + len(fresh))))
        place = self.place
        return [np.fromiter((place[word] for word in words), np.int64, len(words)) for words in texts]


def spans_of(texts: list[str | None], words: _Words) -> list[list[dict]]:
    """Spans of one language of each text: start, end, lang, letters, known (letters of words whose
    script a language uses)."""
    model = words.model
    found = [[m.span() for m in _WORD.finditer(text)] if text else [] for text in texts]
    listed = [[text[a:b].lower() for a, b in own] if own else [] for text, own in zip(texts, found)]
    rows = words.rows(listed)
    out = []
    for own, row, labels in zip(found, rows, viterbi(rows, words.scores)):
        ends = np.array(own, np.int64).reshape(-1, 2)
        if len(ends) == 0:
            out.append([])
            continue
        letters = ends[:, 1] - ends[:, 0]
        first = np.r_[0, np.flatnonzero(labels[1:] != labels[:-1]) + 1]
        last = np.r_[first[1:], len(labels)] - 1
        totals = zip(
            ends[first, 0].tolist(),
            ends[last, 1].tolist(),
            labels[first].tolist(),
            np.add.reduceat(letters, first).tolist(),
            np.add.reduceat(np.where(words.known[row], letters, 0), first).tolist(),
        )
        out.append([{"start": a, "end": b, "lang": model.langs[i], "letters": n, "known": k} for a, b, i, n, k in totals])
    return out


def verdict(spans: list[dict]) -> tuple[str, float]:
    """The language of most letters, and its share of all of them; `und` without a letter."""
    if not spans:
        return UNKNOWN, 0.0
    by_lang: Counter[str] = Counter()
    for span in spans:
        by_lang[span["lang"]] += span["known"]
    lang = min(by_lang, key=lambda name: (-by_lang[name], name))
    return lang, by_lang[lang] / sum(span["letters"] for span in spans)


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, spans) for every row of `docs` (doc_id, text, any more).

    spans: start, end (code points, end exclusive) and lang of the stretches of one language, by
    Viterbi over the words of the whole text; lang_pred is the language of most letters, of equal
    ones the first by code point, and score its share of all letters. NULL and empty texts, and
    those without a letter, are `und` with score 0; a text all in scripts of no language scores 0.
    Without any learnt language every text is `und`. Repeated rows come out repeated with equal
    values; a NULL doc_id is an id like others; an empty table gives an empty result; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    part = "start: int, end: int, lang: string"
    wanted = StructType.fromDDL(f"doc_id {kind}, lang_pred string, score double, spans array<struct<{part}>>")
    arrow = to_arrow_schema(wanted)
    # the more languages, the fewer words at a time
    piece = PIECE_BYTES * 8 // max(8, len(model.langs))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(shared.value)
        for batch in batches:
            rows = max(1, batch.num_rows * piece // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                own = batch.slice(at, rows)
                texts = own["text"].to_pylist()
                spans = spans_of(texts, words) if words.model.langs else [[] for _ in texts]
                names, scores = zip(*map(verdict, spans))
                plain = [[{k: s[k] for k in ("start", "end", "lang")} for s in each] for each in spans]
                columns = [own["doc_id"], pa.array(names), pa.array(scores), pa.array(plain, arrow.field("spans").type)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(label, wanted)


def predictions(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans): languages of all of `docs` (doc_id, text, lang),
    learnt only where crc32(doc_id as text) % 5 is not 0; a NULL doc_id is held out."""
    held = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, true)"
    found = languages(docs, fit(docs.where(f"not {held}"), rows))
    return found.selectExpr("doc_id", f"{held} as held_out", "lang_pred", "score", "spans")
