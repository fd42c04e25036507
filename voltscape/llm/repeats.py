"""Long repeated byte strings: maximal repeats by an enhanced suffix array, bucketed by anchors.

A string of `size` bytes holds `size - k + 1` strings of k = size / 2 bytes. The one with the
smallest hash (the leftmost of equal ones) is its anchor: equal strings have equal anchors at the
same place, wherever they stand. So a text is cut into contexts: stretches of consecutive starts
whose strings have one anchor, about one per size / 4 bytes. Only contexts with the same anchor
bytes can share a string of `size` bytes, and they are compared in buckets of one anchor.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltscape.functions.staging import stage
from voltscape.llm.common import attach, map_rows

SIZE = 400
#: Starts whose anchors are looked for at a time; longer texts are taken in overlapping parts.
PART = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
#: Different contexts of one anchor that one task compares in memory; fuller buckets are sorted by Spark
#: and scanned, with the same result.
BUCKET_CONTEXTS = 4096
#: Strings sorted at a time.
SORT_STARTS = 100_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(400).integers(0, 1 << 64, 256, np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        all_ = np.full(max(n, 1 << 16), base, np.uint64)
        all_[0] = 1
        _powers[name] = np.multiply.accumulate(all_)
    return _powers[name][:n]


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each k bytes of `data`."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power("up", _BASE, n), out=sums[1:])
    found = (sums[k:] - sums[:-k]) * _power("down", _INVERSE, n - k + 1)
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(29)
    return found


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(rows, axis=1).ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def contexts_of(data: bytes, size: int = SIZE) -> dict[tuple[int, int], list]:
    """{(anchor, context): [anchor's place, starts in the context, [first starts]]} of one text;
    contexts that occur several times in it are one entry."""
    found: dict[tuple[int, int], list] = {}
    k = size // 2
    for base in range(0, len(data) - size + 1, PART):
        part = data[base : base + PART + size - 1]
        hashes = rolling(np.frombuffer(part, np.uint8), k)
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        at = (_least(keys, size - k + 1) & _PLACE).astype(np.int64)
        cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
        firsts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(at)]
        anchors = hashes[at[firsts]].view(np.int64).tolist()
        for anchor, first, end, place in zip(anchors, firsts, ends, at[firsts].tolist()):
            context = xxhash.xxh64_intdigest(part[first : end - 1 + size], place - first) - (1 << 63)
            known = found.setdefault((anchor, context), [place - first, end - first, []])
            known[2].append(base + first)
    return found


def _occurrences(docs: DataFrame, size: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "hash", "anchor", "context", "place", "windows", "starts"]
    schema = f"doc_id {kind}, hash long, anchor long, context long, place int, windows int, starts array<long>"

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in names}
        for doc_id, hashed, text in zip(batch["doc_id"], batch["hash"], batch["text"]):
            for (anchor, context), (place, windows, starts) in contexts_of(text, size).items():
                for c, value in zip(names, (doc_id, hashed, anchor, context, place, windows, starts)):
                    out[c].append(value)
        return out

    return map_rows(_texts(docs).where(f"length(text) >= {size}"), schema, kernel)


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, hash, text) with the text as bytes; the hash tells texts of one id apart."""
    return docs.selectExpr("doc_id", "cast(coalesce(text, '') as binary) as text").selectExpr(
        "doc_id", "xxhash64(text) as hash", "text"
    )


def _left_diverse(groups: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Marks members of groups whose members don't all follow the same group; -1 follows none."""
    order = np.argsort(groups, kind="stable")
    g, b = groups[order], before[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    same = (np.minimum.reduceat(b, start) == np.maximum.reduceat(b, start)) & (np.minimum.reduceat(b, start) >= 0)
    out = np.empty(len(groups), bool)
    out[order] = np.repeat(~same, np.diff(np.r_[start, len(g)]))
    return out


#: What is summed over the occurrences of a context: their number, a hash of their texts, their
#: starts, and hash times start modulo two primes. From these follows which groups have the same
#: occurrences, some bytes further on, without listing any.
PRIMES = (2147483647, 2147483629)
_HASH_BITS = 31


@dataclass
class Node:
    """Suffixes that share `length` bytes: sums of their occurrences, the byte before all of them
    (None if they differ) and the first occurrence."""

    length: int
    left: int | None
    sums: list[int]
    at: tuple

    def add(self, left: int | None, sums: list[int], at: tuple) -> None:
        self.left = self.left if self.left == left else None
        self.sums = [x + y for x, y in zip(self.sums, sums)]
        self.at = min(self.at, at, key=_order)


def _order(at: tuple) -> tuple:
    return tuple((x is not None, x if x is not None else 0) for x in at)


def shifted(sums: list[int], by: int) -> list[int]:
    """The sums of the same occurrences, each `by` bytes further on."""
    n, texts, starts, *moments = sums
    return [n, texts, starts + by * n, *((m + by * texts) % p for m, p in zip(moments, PRIMES))]


def tree_nodes(suffixes: Iterable[tuple[bytes, int | None, list[int], tuple]], least: int) -> Iterator[tuple[Node | None, int]]:
    """Stack scan of the common-prefix interval tree of sorted suffixes (bytes, byte before, sums of
    occurrences, first occurrence): the nodes of at least `least` bytes whose suffixes don't all
    follow the same byte, and, as (None, length), how much each suffix in turn shares with either
    neighbour. Only the open nodes are held."""
    stack: list[Node] = []
    last, before = None, 0
    for suffix, left, sums, at in suffixes:
        shared = _common(suffix, last[0]) if last else 0
        if last:
            yield None, max(before, shared)
            yield from _closed(stack, shared, last, least)
        before, last = shared, (suffix, left, sums, at)
    if last:
        yield None, before
        yield from _closed(stack, 0, last, least)


def _closed(stack: list[Node], shared: int, last: tuple, least: int) -> Iterator[tuple[Node, int]]:
    """Adds the suffix before to its node and closes the nodes longer than what the next one shares."""
    done = Node(len(last[0]), *last[1:])
    while stack and stack[-1].length > shared:
        node = stack.pop()
        node.add(done.left, done.sums, done.at)
        done = node
        if done.left is None:
            yield done, 0
    if shared >= least:
        if stack and stack[-1].length == shared:
            stack[-1].add(done.left, done.sums, done.at)
        else:
            stack.append(Node(shared, done.left, done.sums, done.at))
    elif stack:
        stack[-1].add(done.left, done.sums, done.at)


def diverse_starts(texts: list[bytes], buckets: list[int], windows: list[int], size: int) -> list[tuple[int, int, int]]:
    """(bucket, text, start) of the strings of `size` bytes that a maximal repeat may start with: a
    64-bit hash of each sorts out those without a partner in their bucket, and those whose equals
    all follow equal strings one byte on."""
    counts = np.array(windows, np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(owner)) - np.repeat(np.r_[0, counts.cumsum()[:-1]], counts)
    hashes = np.concatenate([rolling(np.frombuffer(t, np.uint8), size)[:n] for t, n in zip(texts, windows)])
    bucket = np.array(buckets, np.int64)[owner]
    mixed = hashes ^ (bucket.view(np.uint64) * np.uint64(_BASE))
    _, group, often = np.unique(mixed, return_inverse=True, return_counts=True)
    before = np.r_[-1, group[:-1]]
    before[start == 0] = -1
    shared = often[group] > 1
    use = np.flatnonzero(shared)
    use = use[_left_diverse(group[use], np.where(shared[use - 1] & (use > 0), before[use], -1))] if len(use) else use
    return list(zip(bucket[use].tolist(), owner[use].tolist(), start[use].tolist()))


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    apart = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    first = int(apart.argmax()) if n else 0
    return first if n and apart[first] else n


#: What the comparison tells: `spans`, which of its own bytes a context repeats, or a `grp`, a
#: maximal repeat within contexts.
FOUND = (
    "anchor long, context long, spans array<struct<a: int, b: int>>, "
    "grp struct<n: long, texts: long, starts: decimal(38,0), m1: long, m2: long, length: int, doc_id: {kind}, hash: long, start: long>"
)
SUMS = ("n", "texts", "starts", "m1", "m2")


def _schema(kind: str) -> tuple[StructType, pa.Schema]:
    wanted = StructType.fromDDL(FOUND.format(kind=kind))
    return wanted, to_arrow_schema(wanted)


def _sums(row: dict) -> list[int]:
    return [int(row[name]) for name in SUMS]


def _place(row: dict, by: int) -> tuple:
    return (row["doc_id"], row["hash"], row["first"] + by)


def _group(sums: list[int], length: int, at: tuple) -> dict:
    own = dict(zip(SUMS, sums)) | dict(zip(("doc_id", "hash", "start"), at))
    return own | {"starts": Decimal(own["starts"]), "length": length}


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _in_buckets(contexts: DataFrame, size: int, kind: str) -> DataFrame:
    """Rows of FOUND for the contexts of a partition, whole buckets at a time."""
    wanted, arrow = _schema(kind)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {(r["anchor"], r["context"]): r for batch in batches for r in batch.to_pylist()}
        rows = [found[key] for key in sorted(found)]
        at = 0
        while at < len(rows):
            stop, starts = at, 0
            while stop < len(rows) and (starts < SORT_STARTS or rows[stop]["anchor"] == rows[stop - 1]["anchor"]):
                starts += rows[stop]["windows"]
                stop += 1
            yield _batch(_bucket_rows(rows[at:stop], size), arrow)
            at = stop

    return contexts.repartition("anchor").mapInArrow(compare, wanted)


def _bucket_rows(part: list[dict], size: int) -> list[dict]:
    texts = [r["data"] for r in part]
    starts = diverse_starts(texts, [r["anchor"] for r in part], [r["windows"] for r in part], size)
    out: list[dict] = []
    # a context that occurs several times is a repeat as a whole, of its own if no other shares all of it
    spans: dict[int, list[tuple[int, int]]] = {t: [(0, len(r["data"]))] for t, r in enumerate(part) if r["n"] > 1}
    alone = dict.fromkeys(spans, 0)
    ordered = sorted((bucket, texts[t][start:], t, start) for bucket, t, start in starts)
    for _, own in groupby(ordered, key=itemgetter(0)):
        listed = list(own)
        told = iter(listed)
        for node, shared in tree_nodes((_suffix(part[t], start) for _, _, t, start in listed), size):
            if node:
                out.append({"grp": _group(node.sums, node.length, node.at)})
                continue
            _, _, t, start = next(told)
            if shared >= size:
                spans.setdefault(t, []).append((start, start + shared))
            if start == 0 and t in alone:
                alone[t] = shared
    for t, shared in alone.items():
        if shared < len(texts[t]):
            out.append({"grp": _group(_sums(part[t]), len(texts[t]), _place(part[t], 0))})
    for t, own in spans.items():
        both = [{"a": a, "b": b} for a, b in merged(own)]
        out.append({"anchor": part[t]["anchor"], "context": part[t]["context"], "spans": both})
    return out


def _suffix(row: dict, start: int) -> tuple[bytes, int | None, list[int], tuple]:
    # what stands before a context is not known here
    left = row["data"][start - 1] if start else None
    return row["data"][start:], left, shifted(_sums(row), start), _place(row, start)


def _by_digest(contexts: DataFrame, size: int, kind: str) -> DataFrame:
    """The same for anchors with very many contexts, as far as one task's memory need not hold them:
    every string of `size` bytes becomes a narrow row with a 128-bit digest; digests that all follow
    one digest, or occur once, go; the rest, with their suffixes, are sorted by digest and bytes
    by Spark and scanned one after another. The result is that of the buckets."""
    wanted, arrow = _schema(kind)
    columns = ("anchor", "context", "start", "high", "low", "before")

    def digests(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in columns}
        for anchor, context, windows, data in zip(*(batch[c] for c in ("anchor", "context", "windows", "data"))):
            before = None
            for start in range(windows):
                digest = xxhash.xxh3_128_intdigest(data[start : start + size])
                high, low = (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63)
                for c, value in zip(columns, (anchor, context, start, high, low, before)):
                    out[c].append(value)
                before = high ^ low
        return out

    schema = "anchor long, context long, start int, high long, low long, before long"
    strings = stage(map_rows(contexts.select("anchor", "context", "windows", "data"), schema, digests), "strings")
    shared = strings.groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("_often"), F.count("before").alias("_known"), F.min("before").alias("_a"), F.max("before").alias("_b")
    )
    use = strings.join(shared.where("_often > 1 and (_known < _often or _a <> _b)"), ["high", "low"])
    rows = use.select("anchor", "context", "start", "high", "low").join(contexts, ["anchor", "context"])
    rows = rows.withColumn("suffix", F.expr("substring(data, start + 1, length(data))")).withColumn(
        "left", F.expr("if(start > 0, substring(data, start, 1), null)")
    ).drop("data")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = (r for batch in batches for r in batch.to_pylist())
        for _, own in groupby(listed, key=itemgetter("high", "low")):
            seen: deque[dict] = deque()

            def suffixes(own=own, seen=seen) -> Iterator[tuple]:
                for r in own:
                    seen.append(r)
                    left = r["left"][0] if r["left"] else None
                    yield r["suffix"], left, shifted(_sums(r), r["start"]), _place(r, r["start"])

            out: list[dict] = []
            for node, common in tree_nodes(suffixes(), size):
                if node:
                    out.append({"grp": _group(node.sums, node.length, node.at)})
                else:
                    r = seen.popleft()
                    span = [{"a": r["start"], "b": r["start"] + common}]
                    if common >= size:
                        out.append({"anchor": r["anchor"], "context": r["context"], "spans": span})
                    if r["start"] == 0 and r["n"] > 1 and common < len(r["suffix"]):
                        out.append({"grp": _group(_sums(r), len(r["suffix"]), _place(r, 0))})
                if len(out) > 1000:
                    yield _batch(out, arrow)
                    out = []
            yield _batch(out, arrow)

    ordered = rows.repartition("high", "low").sortWithinPartitions("high", "low", "suffix")
    told = ordered.mapInArrow(scan, wanted)
    # a context that occurs several times is repeated as a whole, and a group if no other starts alike
    several = contexts.where("n > 1").join(use.where("start = 0").selectExpr("anchor", "context", "true as _told"), ["anchor", "context"], "left")
    whole = several.selectExpr(
        "anchor", "context", "array(struct(0 as a, length(data) as b)) as spans", f"if(_told, null, {_grp('length(data)')}) as grp"
    )
    return told.unionByName(whole.select(*wanted.names))


def _grp(length: str) -> str:
    return f"struct({', '.join(SUMS)}, cast({length} as int) as length, doc_id, hash, first as start)"


@dataclass
class Compared:
    """`alike`, `differ`: occurrences of contexts whose anchor occurs elsewhere, in the same context
    only or also in others. `found`: rows of FOUND of the latter. `whole`: groups of the former."""

    alike: DataFrame
    differ: DataFrame
    found: DataFrame
    whole: DataFrame


def _compared(docs: DataFrame, size: int, bucket: int | None = None) -> Compared:
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = stage(_occurrences(docs, size), "contexts")
    anchors = found.groupBy("anchor").agg(
        F.sum(F.size("starts")).alias("_n"), F.min("context").alias("_a"), F.max("context").alias("_b")
    )
    anchors = anchors.where("_n > 1").selectExpr("anchor", "_a = _b as _same")
    shared = stage(found.join(anchors, "anchor"), "shared")
    alike, differ = shared.where("_same"), shared.where("not _same")
    # one context is a tree of one node
    whole = _summed(alike).where("n > 1").selectExpr(f"{_grp(f'windows - 1 + {size}')} as grp")
    texts = _texts(docs).withColumnsRenamed({"doc_id": "_id", "hash": "_hash"}).where(f"length(text) >= {size}")
    # equal rows give a context twice
    placed = _summed(differ).join(texts, F.expr("doc_id <=> _id and hash = _hash")).selectExpr(
        "anchor", "context", "windows", *SUMS, "doc_id", "hash", "first",
        f"substring(text, cast(first + 1 as int), windows - 1 + {size}) as data",
    )
    contexts = stage(placed, "bytes")
    most = BUCKET_CONTEXTS if bucket is None else bucket
    full = stage(contexts.groupBy("anchor").count().where(f"count > {most}").select("anchor"), "full")
    told = _in_buckets(attach(contexts, full, ["anchor"], "left_anti"), size, kind)
    if not full.isEmpty():
        beyond = attach(contexts, full, ["anchor"], "left_semi").dropDuplicates(["anchor", "context"])
        told = told.unionByName(_by_digest(stage(beyond, "full"), size, kind))
    return Compared(alike, differ, stage(told, "found"), whole)


def _summed(occurrences: DataFrame) -> DataFrame:
    """One row per context: the sums over its occurrences, and the first of them."""
    key = f"pmod(xxhash64(doc_id, hash), {1 << _HASH_BITS})"
    # modulo the primes before they are summed, so that no sum overflows
    moments = (f"aggregate(starts, 0L, (x, s) -> x + {key} * pmod(s, {p}) % {p}) as m{i + 1}" for i, p in enumerate(PRIMES))
    rows = occurrences.selectExpr(
        "anchor", "context", "windows", "cast(size(starts) as bigint) as n", f"size(starts) * {key} as texts",
        "aggregate(starts, 0L, (x, s) -> x + s) as starts", *moments, "struct(doc_id, hash, array_min(starts) as first) as _at",
    )
    sums = rows.groupBy("anchor", "context", "windows").agg(
        F.sum("n").alias("n"),
        F.sum("texts").alias("texts"),
        F.sum(F.col("starts").cast("decimal(28,0)")).cast("decimal(38,0)").alias("starts"),
        *(F.expr(f"sum(m{i + 1}) % {p} as m{i + 1}") for i, p in enumerate(PRIMES)),
        F.min("_at").alias("_at"),
    )
    return sums.select("anchor", "context", "windows", *SUMS, "_at.doc_id", "_at.hash", "_at.first")


def _chained(groups: DataFrame) -> DataFrame:
    """(doc_id, hash, start, length, occurrences): groups with the same occurrences some bytes further
    on are joined into one where they overlap or touch. n, texts and, as the shift cancels out,
    n m - starts texts modulo two primes and the rest of starts by n tell the same occurrences."""
    kept = [
        f"pmod(pmod(n, {p}) * m{i + 1} - cast(pmod(starts, {p}) as bigint) * pmod(texts, {p}) % {p}, {p}) as _q{i + 1}"
        for i, p in enumerate(PRIMES)
    ]
    rows = groups.selectExpr("grp.*").selectExpr(
        "n", "texts", "cast(starts % n as bigint) as _rest", *kept, "starts div n as _s", "length",
        "struct(doc_id, hash, start) as _at",
    )
    key = "n, texts, _rest, _q1, _q2"
    # a key's groups are a few for each hundred bytes of one text
    reach = f"max(_s + length) over (partition by {key} order by _s, length rows between unbounded preceding and 1 preceding)"
    marked = rows.distinct().withColumn("_reach", F.expr(reach)).selectExpr("*", "if(_s <= _reach, 0, 1) as _new")
    numbered = marked.withColumn("_island", F.expr(f"sum(_new) over (partition by {key} order by _s, length rows unbounded preceding)"))
    islands = numbered.groupBy(*key.split(", "), "_island").agg(
        F.expr("max(_s + length) - min(_s) as length"), F.expr("min_by(_at, struct(_s, _at)) as _at")
    )
    return islands.selectExpr("_at.doc_id", "_at.hash", "_at.start", "length", "n as occurrences")


def repeats(docs: DataFrame, size: int = SIZE, bucket: int | None = None) -> DataFrame:
    """(doc_id, hash, start, length, occurrences): the repeated strings of at least `size` bytes, one
    row per group with its first occurrence (start and length in bytes, hash is that of the text)
    and the number of all.

    Groups found in the contexts of one anchor are joined with those of the neighbouring anchors
    that have the same occurrences, so a text held twice is one group, whatever its length. Part of
    a group that occurs in more places is a group of its own; a longer string of fewer places
    around it comes out on either side of it, overlapping it.
    """
    compared = _compared(docs, size, bucket)
    return _chained(compared.whole.union(compared.found.where("grp is not null").select("grp")))


def _covered(compared: Compared, size: int) -> DataFrame:
    """(doc_id, hash, starts, spans): the contexts with repeats, at which bytes of the text they
    start and which of their own bytes are repeated. One row for each context and text, whatever
    the number of groups."""
    spans = compared.found.where("spans is not null").select("anchor", "context", "spans")
    within = stage(spans.groupBy("anchor", "context").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    whole = compared.alike.selectExpr("doc_id", "hash", "starts", f"array(struct(0 as a, windows - 1 + {size} as b)) as spans")
    return whole.union(compared.differ.join(within, ["anchor", "context"]).select("doc_id", "hash", "starts", "spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unions of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, repeated, n_groups, longest_group, occurrences) for
    every row of `docs` (doc_id, text, any more): the UTF-8 bytes left when every byte goes that a
    string of `size` bytes covers which also starts anywhere else, in this text or another; n_spans
    counts removed runs, `repeated` tells whether there is one. n_groups counts the groups of
    `repeats` whose first occurrence is in this text; longest_group and occurrences are bytes and
    number of places of the longest of them, 0 without any.

    NULL and empty texts, and those shorter than `size`, lose nothing. Repeated rows are other
    places of their strings, so they lose them, as copies do. Rows of one doc_id with different
    texts are told apart. Of equally long groups the one of more places counts. An empty table
    gives an empty result; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for data, found in zip(batch["text"], batch["found"]):
            gone = merged([(at + s["a"], at + s["b"]) for f in found or [] for at in f["starts"] for s in f["spans"]])
            parts, at = [], 0
            for a, b in gone:
                parts.append(data[at:a])
                at = b
            out["n_bytes"].append(len(data))
            out["n_removed"].append(sum(b - a for a, b in gone))
            out["n_spans"].append(len(gone))
            out["kept"].append(b"".join([*parts, data[at:]]))
        return out | {name: batch[name] for name in ("n_groups", "longest_group", "occurrences")}

    compared = _compared(docs, size)
    found = _covered(compared, size).selectExpr("doc_id as _id", "hash as _hash", "struct(starts, spans) as s")
    per_doc = found.groupBy("_id", "_hash").agg(F.collect_list("s").alias("found"))
    groups = _chained(compared.whole.union(compared.found.where("grp is not null").select("grp")))
    led = groups.groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).agg(
        F.count(F.lit(1)).alias("n_groups"), F.max(F.struct("length", "occurrences")).alias("_longest")
    )
    # narrow rows first, so that the texts are shuffled once
    told = per_doc.withColumnsRenamed({"_id": "_i", "_hash": "_h"}).join(led, F.expr("_i <=> _id and _h = _hash"), "left")
    joined = _texts(docs).join(told.drop("_id", "_hash"), F.expr("doc_id <=> _i and hash = _h"), "left").selectExpr(
        "doc_id", "text", "found", "coalesce(n_groups, 0L) as n_groups", "cast(coalesce(_longest.length, 0) as bigint) as longest_group",
        "coalesce(_longest.occurrences, 0L) as occurrences",
    )
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, n_groups long, longest_group long, occurrences long"
    return map_rows(joined, schema, kernel).withColumn("repeated", F.expr("n_spans > 0"))
