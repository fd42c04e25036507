"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltscape.llm.common import map_rows

NGRAM = 3
#: An n-gram of an item is a seed unless it is among the item's most frequent ones in the corpus.
SEED_SHARE = 0.75
#: Pairs of neighbouring words are seeds too, where they are rarer than this share of the item's own: they
#: survive where every third word is replaced. So many of them count as two seeds of three words.
PAIR_SHARE, PAIRS = 0.5, 3
#: So many n-grams at one distance between item and text are seeds too, however frequent they are:
#: those of a copied part are the most frequent ones of an item of which nothing else occurs.
RUN_GRAMS = 4
MATCH, MISMATCH, GAP = 2, -1, -1
#: Alignment score over the score of a verbatim copy.
THRESHOLD = 0.4
#: An alignment that scores as much as this many verbatim words counts, however long the item is.
PASSAGE_WORDS = 13
#: Items, and words of items, that are broadcast at a time.
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 1_000_000
#: Words that are searched at a time.
CHUNK_WORDS = 1_000_000

# everything but letters, digits and bytes of longer characters parts words
_TO_SPACE = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
# the same words in the text as it is; lower-casing may add characters, but none that part a word
_SPAN = regex.compile(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+")
_END = b"\x80"  # never a word of valid UTF-8


def tokens(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


@dataclass
class Grams:
    """The n-grams of all items: `rare` marks those that are seeds of the item."""

    n: int
    grams: np.ndarray  # sorted distinct n-grams
    item_of: np.ndarray  # (n-gram number, item, offset), by n-gram number
    offset_of: np.ndarray
    rare: np.ndarray
    first: np.ndarray  # where each n-gram's entries begin
    table: np.ndarray  # which hash values have an n-gram

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a known n-gram starts, and its number."""
        if len(numbers) < self.n or not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        value = _grams(numbers, self.n)
        at = np.flatnonzero(self.table[_spot(value, len(self.table))])
        gram = np.searchsorted(self.grams, value[at])
        good = (gram < len(self.grams)) & (self.grams[np.minimum(gram, len(self.grams) - 1)] == value[at])
        return at[good], gram[good]

    def entries(self, at: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(item, position, offset in the item, rare) of all items' n-grams that were hit."""
        counts = self.first[gram + 1] - self.first[gram]
        entry = np.repeat(self.first[gram] - np.r_[0, counts.cumsum()[:-1]], counts) + np.arange(counts.sum())
        return self.item_of[entry], np.repeat(at, counts), self.offset_of[entry], self.rare[entry]


@dataclass
class Items:
    """Benchmark items as word numbers, with their n-grams of three words and their pairs."""

    ids: list
    words: dict[bytes, int]
    texts: list[np.ndarray]
    triples: Grams
    pairs: Grams

    def numbered(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))


def _grams(numbers: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each n words; -1 where one is no item's."""
    count = len(numbers) - n + 1
    value, known = np.zeros(count, np.uint64), np.ones(count, bool)
    for j in range(n):
        own = numbers[j : j + count]
        value = (value ^ (value >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + (own + 1).view(np.uint64)
        known &= own >= 0
    return np.where(known, value.view(np.int64), -1)


def _spot(value: np.ndarray, size: int) -> np.ndarray:
    return ((value.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).view(np.int64)


def _indexed(texts: list[np.ndarray], n: int, kept: dict[int, np.ndarray] | None, only: bool) -> Grams:
    value, item, offset, rare = ([np.zeros(0, kind)] for kind in (np.int64, np.int64, np.int64, bool))
    for i, numbers in enumerate(texts):
        if len(numbers) >= n:
            v = _grams(numbers, n)
            seed = np.ones(len(v), bool) if kept is None else np.isin(v, kept[i])
            use = np.flatnonzero(seed) if only else np.arange(len(v))
            for column, found in zip((value, item, offset, rare), (v[use], np.full(len(use), i), use, seed[use])):
                column.append(found)
    value, item, offset, rare = map(np.concatenate, (value, item, offset, rare))
    order = np.argsort(value, kind="stable")
    grams, first = np.unique(value[order], return_index=True)
    size = 1 << max(16, (16 * max(1, len(grams))).bit_length())
    table = np.zeros(size, bool)
    table[_spot(grams, size)] = True
    return Grams(n, grams, item[order], offset[order], rare[order], np.r_[first, len(value)], table)


def _items(rows: list[tuple], seeds: tuple[dict, dict] | None = None) -> Items:
    """`seeds`: for each item the rare n-grams and the rare pairs; all if None."""
    split = [tokens(text or "") for _, text in rows]
    words = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    texts = [np.array([words[w] for w in ws], np.int64) for ws in split]
    triples, pairs = seeds or (None, None)
    # frequent n-grams may make a run, frequent pairs are no use
    return Items([i for i, _ in rows], words, texts, _indexed(texts, NGRAM, triples, False), _indexed(texts, 2, pairs, True))


def _joined(texts: list[str | None]) -> list[tuple[int, list[bytes]]]:
    """Words of many texts in a few long lists, each text ended by a mark: (first text, words)."""
    found, words, first = [], [], 0
    for i, text in enumerate(texts):
        words += tokens(text or "")
        words.append(_END)
        if len(words) > CHUNK_WORDS:
            found.append((first, words))
            words, first = [], i + 1
    if words:
        found.append((first, words))
    return found


def gram_counts(docs: DataFrame, items: Items) -> dict[int, dict[int, int]]:
    """In how many documents each n-gram and pair of the items occurs, by its words; the rest are 0."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        own = shared.value
        totals = {index.n: np.zeros(len(index.grams), np.int64) for index in (own.triples, own.pairs)}
        for _, words in _joined(batch["text"]):
            numbers = own.numbered(words)
            ends = np.flatnonzero(np.fromiter(map(_END.__eq__, words), bool, len(words)))
            for index in (own.triples, own.pairs):
                at, gram = index.hits(numbers)
                total, text = totals[index.n], np.searchsorted(ends, at)
                total += np.bincount(np.unique(text * len(total) + gram) % max(1, len(total)), minlength=len(total))
        out: dict[str, list] = {"words": [], "gram": [], "n": []}
        for n, total in totals.items():
            found = np.flatnonzero(total)
            for column, values in zip(out.values(), ([n] * len(found), found.tolist(), total[found].tolist())):
                column += values
        return out

    counted = map_rows(docs.select("text"), "words int, gram long, n long", kernel)
    found: dict[int, dict[int, int]] = {NGRAM: {}, 2: {}}
    # at most one row for each n-gram of a block of items
    for row in counted.groupBy("words", "gram").agg(F.sum("n").alias("n")).collect():
        found[row.words][row.gram] = row.n
    return found


def seeds_of(items: Items, counts: dict[int, dict[int, int]]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """For each item its rare n-grams and its rare pairs: those not above the SEED_SHARE or PAIR_SHARE
    quantile of the item's own document counts. So a passage that is copied everywhere keeps its
    seeds, as all its n-grams are about equally frequent, and phrases of common words drop out."""

    def rare(index: Grams, share: float) -> dict[int, np.ndarray]:
        seen = np.zeros(len(index.grams), np.int64)
        seen[list(counts[index.n])] = list(counts[index.n].values())
        found = {}
        for i, numbers in enumerate(items.texts):
            value = _grams(numbers, index.n) if len(numbers) >= index.n else np.zeros(0, np.int64)
            often = seen[np.searchsorted(index.grams, value)]
            found[i] = value[often <= np.quantile(often, share)] if len(value) else value
        return found

    return rare(items.triples, SEED_SHARE), rare(items.pairs, PAIR_SHARE)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and where it ends in `text` (exclusive)."""
    steps = np.arange(len(text) + 1) * GAP
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(text == word, MATCH, MISMATCH), out=new[1:])
        # gaps along the text: the best earlier cell less its distance
        row = np.maximum.accumulate(new - steps) + steps
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _clusters(at: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Stretches (first, last) of sorted positions with no gap above `reach`."""
    cut = np.flatnonzero(np.diff(at) > reach)
    return list(zip(np.r_[0, cut + 1].tolist(), np.r_[cut, len(at) - 1].tolist()))


def aligned(items: Items, numbers: np.ndarray, triples: tuple, pairs: tuple, threshold: float):
    """(item, score, score over the aligned part of the item, first word, last word, seeds) of the
    best passage of each item in one text, from the hits (position, n-gram) of both kinds; of equal
    scores the first passage."""
    item, where, offset, rare = items.triples.entries(*triples)
    _, line, length = np.unique((item << 40) + where - offset, return_inverse=True, return_counts=True)
    run = length[line] >= RUN_GRAMS
    use = np.flatnonzero(rare | run)
    more, places, *_ = items.pairs.entries(*pairs)
    kind = np.r_[np.where(run[use], 2, 0) + rare[use], np.full(len(more), 4)]
    item, where = np.r_[item[use], more], np.r_[where[use], places]
    if not len(item):
        return
    use = np.lexsort((where, item))
    item, where, kind = item[use], where[use], kind[use]
    rare, run, pair = kind & 1 > 0, kind & 2 > 0, kind & 4 > 0
    cuts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(item)]):
        own = items.texts[item[a]]
        long = len(own)
        # as many seeds as the score needs at least: two, or one for items too short for that
        needed = 2 if long >= 2 * NGRAM else 1
        least = MATCH * min(threshold * long, PASSAGE_WORDS)
        best = None
        for i, j in _clusters(where[a:b], long):
            first, last = int(where[a + i]), int(where[a + j])
            part = slice(a + i, a + j + 1)
            seeds, loose = len(np.unique(where[part][rare[part]])), len(np.unique(where[part][pair[part]]))
            if seeds < needed and loose < PAIRS and not run[part].any():
                continue
            seeds = len(np.unique(where[part]))
            low, high = max(0, first - long), last + NGRAM + long
            around = numbers[low:high]
            score, end = align(own, around)
            if score >= least and (best is None or score > best[0]):
                back = align(own[::-1], around[:end][::-1])[1]
                best = (score, low + end - back, low + end - 1, seeds)
        if best:
            score, first, last, seeds = best
            # the aligned part of the item: the passage against it the other way round
            passage = numbers[first : last + 1]
            stop = align(passage, own)[1]
            size = align(passage[::-1], own[:stop][::-1])[1]
            yield int(item[a]), score / (MATCH * long), score / (MATCH * size), first, last, seeds


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, part_score, start, end, n_seeds, passage) for every document and
    item that share a passage: the best local alignment of words, its score over that of a verbatim
    copy of the item and of the aligned part of the item, its code points in the text (end
    exclusive) and the text there. A passage counts if its score is at least `threshold`, or if
    it scores as much as PASSAGE_WORDS verbatim words, so that a part of a long item is found too.

    Seeds are n-grams of three words that are rare among the item's n-grams, counted over all
    documents, or stand in a run of RUN_GRAMS, and rare pairs of words. Wherever two seeds of an item,
    or PAIRS pairs, lie within its length of each other, the words around them are aligned with
    the whole item (match 2, mismatch -1, gap -1), so edited and paraphrased copies are found, also
    where every third word is replaced. Words are lower-cased runs of letters and digits. One passage
    is told per item and document: the one of the highest score, of equal ones the first.

    The items are the stated queries: they are broadcast in blocks of at most BLOCK_ITEMS items and
    about BLOCK_WORDS words, and every block meets all documents, which are never shuffled. Whole texts are searched, whatever their
    length, and a passage that a third of all documents share costs one alignment in each.
    NULL and empty texts and items of fewer than three words match nothing. Repeated rows come
    out repeated; an empty table gives an empty result; other columns are ignored.
    """
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {kind}, item_id {item_kind}, score double, part_score double, start long, end long, n_seeds long, passage string"
    rows = benchmark.select("item_id", "text").where("text is not null").toLocalIterator()
    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(rows):
        everything = _items(block)
        seeds = _items(block, seeds_of(everything, gram_counts(docs, everything)))
        found = found.union(_search(docs, seeds, threshold, schema))
    return found


def _blocks(rows: Iterator) -> Iterator[list[tuple]]:
    block, words = [], 0
    for row in rows:
        block.append(tuple(row))
        words += len(row.text) // 2 + 1
        if len(block) == BLOCK_ITEMS or words >= BLOCK_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


def _search(docs: DataFrame, items: Items, threshold: float, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    columns = ["doc_id", "item_id", "score", "part_score", "start", "end", "n_seeds", "passage"]

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        own, found = shared.value, []
        for first, words in _joined(batch["text"]):
            numbers = own.numbered(words)
            hits = [own.triples.hits(numbers), own.pairs.hits(numbers)]
            if not any(len(at) for at, _ in hits):
                continue
            ends = np.flatnonzero(np.fromiter(map(_END.__eq__, words), bool, len(words)))
            of_text = [np.searchsorted(ends, at) for at, _ in hits]
            for n in np.union1d(*of_text).tolist():
                begin = int(ends[n - 1]) + 1 if n else 0
                here = []
                for (at, gram), text in zip(hits, of_text):
                    a, b = np.searchsorted(text, [n, n + 1])
                    here.append((at[a:b] - begin, gram[a:b]))
                for item, score, share, start, last, seeds in aligned(own, numbers[begin : ends[n]], *here, threshold):
                    whole = batch["text"][first + n]
                    low, high = _points(whole, start, last)
                    found.append((batch["doc_id"][first + n], own.ids[item], score, share, low, high, seeds, whole[low:high]))
        return dict(zip(columns, map(list, zip(*found)))) if found else {c: [] for c in columns}

    return map_rows(docs.select("doc_id", "text"), schema, kernel)


def _points(text: str, first: int, last: int) -> tuple[int, int]:
    """Code points of words `first` to `last`."""
    low = high = 0
    for i, m in enumerate(_SPAN.finditer(text)):
        if i == first:
            low = m.start()
        if i == last:
            high = m.end()
            break
    return low, high


def clean_rows(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` without a contaminated passage, with all columns."""
    key = F.struct("doc_id", F.xxhash64("text").alias("hash"))
    packed = docs.select(F.struct("*").alias("_row"), key.alias("doc_id"), "text")
    bad = contaminated(packed, benchmark, threshold).selectExpr("doc_id as _bad").distinct()
    return packed.join(bad, F.expr("doc_id = _bad"), "left_anti").select("_row.*")
