"""Source divergence audit: how far the word use of each source is from the others of its language.

The vocabulary is a minimal acyclic transducer, built from the sorted kept terms: it accepts a
term and adds up the term's lexicographic ordinal on the way. The vocabulary is cut into ranges of
terms, a transducer each, so no task builds a large one. Texts are streamed through the
transducers for recounting, which gives numbers instead of words; ties go by ordinal.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltscape.functions.staging import stage
from voltscape.llm.common import PIECE_BYTES, attach

#: Documents of a language that a kept term is in.
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Bytes of term text in one transducer.
RANGE_BYTES = 2 << 20
#: Bytes of transducers that are broadcast at a time; a larger vocabulary takes more passes.
PASS_BYTES = 64 << 20
#: Different terms a task counts before it passes the counts on.
HELD_TERMS = 300_000
#: Terms x sources of one block of the comparison.
BLOCK_CELLS = 200_000

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters A-Z (lower-cased) and non-ASCII characters, in order."""
    return text.translate(_KEEP).split()


# ---------------------------------------------------------------- the transducer


@dataclass
class Transducer:
    """Edges sorted by (state, byte), each with its target and what it adds to the ordinal."""

    keys: np.ndarray  # state * 256 + byte
    target: np.ndarray
    adds: np.ndarray
    final: np.ndarray  # by state
    root: int
    size: int  # terms

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """Position of each term in the sorted vocabulary, -1 for others. All terms go through
        byte by byte together."""
        found = np.full(len(terms), -1, np.int64)
        if not len(self.keys):
            found[[i for i, term in enumerate(terms) if not term and self.size]] = 0
            return found
        lengths = np.fromiter(map(len, terms), np.int64, len(terms))
        starts = np.r_[0, lengths.cumsum()[:-1]].astype(np.int64)
        text = np.frombuffer(b"".join(terms), np.uint8)
        live = np.arange(len(terms))
        state = np.full(len(terms), self.root, np.int64)
        total = np.zeros(len(terms), np.int64)
        at = 0
        while len(live):
            ended = lengths[live] == at
            done = ended & self.final[state]
            found[live[done]] = total[done]
            live, state, total = live[~ended], state[~ended], total[~ended]
            key = state * 256 + text[starts[live] + at]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[edge] == key
            live, edge = live[goes], edge[goes]
            state, total = self.target[edge], total[goes] + self.adds[edge]
            at += 1
        return found

    def term(self, ordinal: int) -> bytes:
        """The term with this ordinal."""
        out, state, rest = bytearray(), self.root, ordinal
        while not (rest == 0 and self.final[state]):
            first, end = np.searchsorted(self.keys, [state * 256, state * 256 + 256])
            edge = first + int(np.searchsorted(self.adds[first:end], rest, "right")) - 1
            out.append(int(self.keys[edge]) & 255)
            state, rest = int(self.target[edge]), rest - int(self.adds[edge])
        return bytes(out)


def transducer(terms: list[bytes]) -> Transducer:
    """The minimal transducer of sorted, different terms. A state is done when a term leaves its
    branch; states with the same finality and edges are one."""
    known: dict[tuple, int] = {}
    words: list[int] = []  # terms from each state on
    edges: list[tuple] = []
    final: list[bool] = []
    # the states of the term last added: [final, its done edges]
    path: list[list] = [[False, []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            ends, own = path.pop()
            key = (ends, *own)
            state = known.get(key)
            if state is None:
                state = known[key] = len(final)
                final.append(ends)
                edges.append(tuple(own))
                words.append(ends + sum(words[t] for _, t in own))
            path[-1][1].append((last[len(path) - 1], state))

    for term in terms:
        shared = 0
        while shared < min(len(term), len(last)) and term[shared] == last[shared]:
            shared += 1
        close(shared)
        path += [[False, []] for _ in term[shared:]]
        path[-1][0] = True
        last = term
    close(0)
    root = len(final)
    final.append(path[0][0])
    edges.append(tuple(path[0][1]))
    keys, target, adds = [], [], []
    for state, own in enumerate(edges):
        before = int(final[state])
        for byte, to in own:
            keys.append(state * 256 + byte)
            target.append(to)
            adds.append(before)
            before += words[to]
    arrays = (np.array(x, np.int64) for x in (keys, target, adds))
    return Transducer(*arrays, np.array(final, bool), root, len(terms))


# ---------------------------------------------------------------- vocabulary


def _counted(
    docs: DataFrame, keys: list[str], schema: str, count: Callable, rows_of: Callable, entries: int = HELD_TERMS
) -> DataFrame:
    """Counts made where the texts are: `count(counts, key, text)` adds one text to a Counter, one per
    key; `rows_of(counts)` gives batches of rows whenever a task holds `entries` different entries."""
    wanted = StructType.fromDDL(schema)
    arrow = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for columns in rows_of(counts):
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)
            counts.clear()

        for batch in batches:
            step = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step).to_pydict()
                for *key, text in zip(*(part[name] for name in (*keys, "text"))):
                    count(counts.setdefault(tuple(key), Counter()), text)
                if sum(map(len, counts.values())) > entries:
                    yield from passed_on()
        yield from passed_on()

    return docs.select(*keys, "text").mapInArrow(run, wanted)


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term): the terms in at least `least` documents of a language; terms as UTF-8 bytes."""

    def count(counts: Counter, text: bytes) -> None:
        counts.update(set(terms_of(text)))

    def rows_of(counts: dict) -> Iterator[dict]:
        for (lang,), own in counts.items():
            yield {"lang": pa.repeat(lang, len(own)), "term": list(own), "n": np.fromiter(own.values(), np.int64, len(own))}

    found = _counted(docs, ["lang"], "lang string, term binary, n long", count, rows_of)
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(f"n >= {least}").select("lang", "term")


def vocabulary(terms: DataFrame, range_bytes: int = RANGE_BYTES, pass_bytes: int = PASS_BYTES) -> list[DataFrame]:
    """(lang, first, size, base, automaton): transducers of the terms (lang, term) by range, in
    blocks of about `pass_bytes`, one block at least.

    Terms are sorted over the cluster by language and bytes; a task takes its stretch in order and
    closes a transducer at `range_bytes` of text or where the language changes. `base` is the
    ordinal of the range's first term in its language. All is written.
    """
    kept = stage(terms, "terms")
    total = kept.agg(F.sum(F.length("term") + 1)).first()[0] or 0
    wanted = StructType.fromDDL("lang string, first binary, size long, automaton binary")
    arrow = to_arrow_schema(wanted)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        lang, size = None, 0

        def closed() -> pa.RecordBatch:
            blob = pickle.dumps(transducer(held), protocol=5)
            return pa.RecordBatch.from_pylist([dict(zip(arrow.names, (lang, held[0], len(held), blob)))], schema=arrow)

        for batch in batches:
            for name, term in zip(batch["lang"].to_pylist(), batch["term"].to_pylist()):
                if held and (name != lang or size >= range_bytes):
                    yield closed()
                    held, size = [], 0
                lang = name
                held.append(term)
                size += len(term) + 1
        if held:
            yield closed()

    parts = int(total // range_bytes) + 1
    ordered = kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    built = stage(ordered.mapInArrow(build, wanted), "automata")
    # one narrow row per range of terms meets in these windows
    before = "rows between unbounded preceding and 1 preceding"
    places = stage(
        built.selectExpr("lang", "first", "size", "length(automaton) as bytes").selectExpr(
            "lang as _lang", "first as _first",
            f"coalesce(sum(size) over (partition by lang order by first {before}), 0L) as base",
            f"coalesce(sum(bytes) over (order by lang, first {before}), 0L) div {pass_bytes} as _at",
        ).selectExpr("_lang", "_first", "base", "dense_rank() over (order by _at) - 1 as _pass"),
        "places",
    )
    count = (places.agg(F.max("_pass")).first()[0] or 0) + 1
    same = F.expr("lang = _lang and first = _first")
    return [
        built.join(places.where(f"_pass = {i}"), same).select("lang", "first", "size", "base", "automaton")
        for i in range(count)
    ]


@dataclass
class Vocabulary:
    """Transducers of some ranges, by language in order."""

    firsts: dict[str, list[bytes]]
    parts: dict[str, list[tuple[int, Transducer]]]

    @classmethod
    def of(cls, rows: list) -> Vocabulary:
        own = cls({}, {})
        for row in sorted(rows, key=lambda r: (r.lang, bytes(r.first))):
            own.firsts.setdefault(row.lang, []).append(bytes(row.first))
            own.parts.setdefault(row.lang, []).append((row.base, pickle.loads(bytes(row.automaton))))
        return own

    def ordinals(self, lang: str, terms: list[bytes]) -> np.ndarray:
        """Ordinals of sorted terms in the language, -1 where the ranges here lack one."""
        found = np.full(len(terms), -1, np.int64)
        firsts = self.firsts.get(lang, [])
        cuts = [0, *(bisect_left(terms, first) for first in firsts[1:]), len(terms)]
        for (base, part), a, b in zip(self.parts.get(lang, []), cuts, cuts[1:]):
            if b > a:
                own = part.ordinals(terms[a:b])
                found[a:b] = np.where(own >= 0, own + base, -1)
        return found

    def term(self, lang: str, ordinal: int) -> bytes | None:
        parts = self.parts.get(lang, [])
        at = bisect_right([base for base, _ in parts], ordinal) - 1
        if at < 0 or ordinal >= parts[at][0] + parts[at][1].size:
            return None
        return parts[at][1].term(ordinal - parts[at][0])


def recounted(docs: DataFrame, vocab: list[DataFrame]) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of the kept terms in each group, where any. Every
    text is streamed through the transducers of its language, block by block of the vocabulary."""
    out = None
    for block in vocab:
        shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.of(block.collect()))

        def count(counts: Counter, text: bytes) -> None:
            counts.update(terms_of(text))

        def rows_of(counts: dict, shared=shared) -> Iterator[dict]:
            by_lang: dict[str, set[bytes]] = {}
            for (lang, _), own in counts.items():
                by_lang.setdefault(lang, set()).update(own)
            for lang, seen in by_lang.items():
                listed = sorted(seen)
                place = dict(zip(listed, shared.value.ordinals(lang, listed).tolist()))
                for (name, source), own in counts.items():
                    if name == lang:
                        ordinals = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
                        kept = ordinals >= 0
                        n = np.fromiter(own.values(), np.int64, len(own))[kept]
                        yield {"lang": pa.repeat(lang, len(n)), "source": pa.repeat(source, len(n)), "ordinal": ordinals[kept], "n": n}

        found = _counted(docs, ["lang", "source"], "lang string, source string, ordinal long, n long", count, rows_of)
        out = found if out is None else out.union(found)
    return out.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- comparison


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exactly: three decimals of the quotient at a time."""
    rest, found = count + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + rest // total
        rest = rest % total
    return found + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q)"""
    return (p - q) * (p - q) // q


def _compared(cells: DataFrame) -> DataFrame:
    """(part, lang, no, item, value) of blocks of terms: cells (lang, block, ordinal, no, n), led by a
    row with ordinal -1 and n = N + V for each source."""
    wanted = StructType.fromDDL("part string, lang string, no int, item long, value long")
    arrow = to_arrow_schema(wanted)
    names = ("ordinal", "no", "n", "occurrences")

    def block_of(lang: str, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ordinal, no, n, occurrences = columns
        lead = ordinal < 0
        sources = int(no[lead].max()) + 1
        totals = np.ones(sources, np.int64)
        totals[no[lead]] = n[lead]
        terms, row = np.unique(ordinal[~lead], return_inverse=True)
        counts = np.zeros((len(terms), sources), np.int64)
        counts[row, no[~lead]] = n[~lead]
        p = shares(counts, totals)
        # V is in each of the totals, but once in that of the language
        kept = int(n[lead][0] - occurrences[lead][0])
        q = shares(counts.sum(axis=1), np.int64(totals.sum() - (sources - 1) * kept))
        for i in range(sources):
            sums = excess(p[:, i : i + 1], p).sum(axis=0)
            others = np.delete(np.arange(sources), i)
            yield _rows(arrow, "pair", lang, i, others, sums[others])
            more = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
            values = excess(p[more, i], q[more])
            # only the first of a block can be the first of all
            best = np.lexsort((more, -values))[:TOP_TERMS]
            yield _rows(arrow, "term", lang, i, terms[more[best]], values[best])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            yield from block_of(key[0], [table[name].to_numpy().astype(np.int64) for name in names])

        for batch in batches:
            keys = list(zip(batch["lang"].to_pylist(), batch["block"].to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if held and keys[a] != key:
                        yield from done()
                        held = []
                    key = keys[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    placed = cells.repartition("lang", "block").sortWithinPartitions("lang", "block", "ordinal", "no")
    return placed.select("lang", "block", *names).mapInArrow(run, wanted)


def _rows(schema: pa.Schema, part: str, lang: str, no: int, items: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    columns = [[part] * len(items), [lang] * len(items), [no] * len(items), items, values]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _named(found: DataFrame, vocab: list[DataFrame]) -> DataFrame:
    """`found` (lang, item, ...) with the term of each ordinal, read back from the transducers."""
    wanted = StructType([*found.schema.fields]).add("term", "string")
    arrow = to_arrow_schema(wanted)
    out = None
    for block in vocab:
        shared = found.sparkSession.sparkContext.broadcast(Vocabulary.of(block.collect()))

        def decode(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                terms = [shared.value.term(*at) for at in zip(batch["lang"].to_pylist(), batch["item"].to_pylist())]
                texts = pa.array([None if t is None else t.decode() for t in terms], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], schema=arrow)

        own = found.mapInArrow(decode, wanted).where("term is not null")
        out = own if out is None else out.union(own)
    return out


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of language and source in `docs`
    (text, lang, source, any more).

    Terms are runs of letters and non-ASCII characters, A-Z lower-cased; a language keeps the V
    terms in at least `least` of its documents. A group gives each kept term the share
    p = 1 + floor(10^9 (count + 1) / (N + V)), its language likewise with all its counts; the value
    of p against q is floor((p - q)^2 / q). Part `pair`: each other source of the language, q its
    shares, summed over all kept terms; part `term`: the terms the group has more of than the
    language, q the language's share, the first `top`. Ranks from 1 by value, ties by item in byte
    order. All whole numbers, so reruns agree.

    NULL text, lang and source read as ''. Groups without terms take part with counts of 0. A
    language with one source has no pairs. Repeated rows are documents of their own. An empty
    table gives an empty result; other columns are ignored. By its definition the part `pair` has
    a row for each two sources of a language.
    """
    texts = docs.selectExpr(
        "coalesce(lang, '') as lang", "coalesce(source, '') as source", "cast(coalesce(text, '') as binary) as text"
    )
    vocab = vocabulary(kept_terms(texts, least))
    counts = stage(recounted(texts, vocab), "counts")
    sizes = reduce(DataFrame.union, vocab).groupBy("lang").agg(F.sum("size").alias("v"))
    found = texts.select("lang", "source").distinct()
    # one row per group; a language's groups, not its documents, meet in the window
    numbered = found.selectExpr(
        "lang", "source", "cast(row_number() over (partition by lang order by source) - 1 as int) as no",
        "count(*) over (partition by lang) as s",
    )
    occurrences = counts.groupBy("lang", "source").agg(F.sum("n").alias("occurrences"))
    groups = numbered.join(sizes, "lang", "left").join(occurrences, ["lang", "source"], "left")
    groups = stage(groups.na.fill(0, ["v", "occurrences"]), "groups")
    rows = f"greatest({BLOCK_CELLS} div s, 1)"
    # a language without kept terms has one block, in which all its sources are alike
    leads = groups.selectExpr(
        "lang", f"explode(sequence(0L, greatest(v - 1, 0L) div {rows})) as block", "-1L as ordinal", "no",
        "greatest(occurrences + v, 1L) as n", "occurrences",
    )
    cells = attach(counts, groups.select("lang", "source", "no", "s"), ["lang", "source"]).selectExpr(
        "lang", f"ordinal div {rows} as block", "ordinal", "no", "n", "0L as occurrences"
    )
    values = stage(_compared(leads.union(cells)), "values")
    summed = values.where("part = 'pair'").groupBy("lang", "no", F.col("item").cast("int").alias("other")).agg(
        F.sum("value").alias("value")
    )
    names = groups.select("lang", "no", "source")
    pairs = attach(summed, names, ["lang", "no"])
    pairs = attach(pairs, names.selectExpr("lang", "no as other", "source as item"), ["lang", "other"])
    by_item = "row_number() over (partition by lang, source order by value desc, item)"
    ranked = pairs.selectExpr("lang", "source", "'pair' as part", "item", "value", f"cast({by_item} as int) as rank")
    first = attach(values.where("part = 'term'"), names, ["lang", "no"]).selectExpr(
        "lang", "source", "item", "value", f"cast({by_item} as int) as rank"
    )
    first = stage(first.where(f"rank <= {top}"), "first")
    terms = _named(first, vocab).selectExpr("lang", "source", "'term' as part", "term as item", "value", "rank")
    return ranked.union(terms)
