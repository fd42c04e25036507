"""WARC archives, and a merge of their locally sorted indexes into capture histories."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltscape.functions.staging import fresh_path, stage
from voltscape.llm.common import attach

#: Uncompressed payload bytes an archive should hold.
ARCHIVE_BYTES = 16 << 20
#: Captures of one range of the merged order, about.
RANGE_ROWS = 200_000
#: Captures of one block of a run, and blocks that a merge reads at a time.
BLOCK_ROWS, WAVE = 500, 32
#: Captures looked at per range to cut the ranges.
SAMPLED = 20
#: Capture time where the pages tell none: a second per page_id, within three years from 2024.
DATE = "timestamp_seconds(1704067200 + pmod(coalesce(cast(page_id as bigint), 0L), 94608000L))"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Two empty lines end a record; the text sink writes them after each.
_RECORD_END = "\r\n\r\n"


def base32(hexadecimal: str) -> str:
    """SQL: 40 hex digits as 32 base32 characters, five bits each."""
    forty = [f"cast(conv(substring({hexadecimal}, {1 + 10 * i}, 10), 16, 10) as bigint)" for i in range(4)]
    letters = [f"substring('{_BASE32}', cast(shiftright({v}, {s}) & 31 as int) + 1, 1)" for v in forty for s in range(35, -1, -5)]
    return f"concat({', '.join(letters)})"


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE, compression: str = "gzip"
) -> None:
    """Write one WARC record per row of `pages` (page_id, url, html, any more) below `path`.

    The payload is the html in UTF-8, NULL empty. Of records with equal payloads of at least
    `min_bytes` bytes the one with the smallest page_id is a response with the payload, the others
    are revisits that name it; smaller payloads are all responses. Rows repeated with that
    smallest page_id are all responses. Digests decide what is equal.

    Only payloads that occur twice are joined with their first page, so unique ones are never
    shuffled; a frequent payload is one row there. Every write task makes its own gzipped
    archives of about ARCHIVE_BYTES. The files are written by Spark's text sink: a record is one
    value, and the record end is the line separator. `date` is SQL for the capture time. The text
    sink packs a file as a whole; with `compression` "none" a record can be fetched by its offset
    and length without reading what stands before it.
    """
    hashed = pages.selectExpr("page_id", "url", "coalesce(html, '') as _html", f"{date} as _date").selectExpr(
        "*", "sha1(cast(_html as binary)) as _sha", "cast(octet_length(_html) as bigint) as _bytes"
    )
    keys = stage(hashed.select("page_id", "_sha", "_bytes"), "payloads")
    firsts = keys.where(f"_bytes >= {min_bytes}").groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    sizes = keys.agg(F.avg("_bytes")).first()[0] or 0
    known = attach(hashed, stage(firsts.where("_n > 1").drop("_n"), "first-pages"), ["_sha"], "left")
    known = known.selectExpr(
        "*",
        # a NULL id is not smaller than any other
        f"coalesce(_bytes >= {min_bytes} and _first is not null and not (page_id <=> _first), false) as _again",
        f"{base32('_sha')} as _digest",
        "coalesce(url, '') as _url",
    )
    crlf = r"'\r\n'"
    http = f"concat('HTTP/1.1 200 OK', {crlf}, 'Content-Type: text/html; charset=utf-8', {crlf}, 'Content-Length: ', _bytes, {crlf}, {crlf})"
    record = known.withColumn("_block", F.expr(f"concat({http}, if(_again, '', _html))")).selectExpr(
        f"""concat_ws({crlf}, 'WARC/1.1',
            concat('WARC-Type: ', if(_again, 'revisit', 'response')),
            concat('WARC-Record-ID: <urn:page:', coalesce(cast(page_id as string), ''), '>'),
            concat('WARC-Target-URI: ', replace(replace(_url, '\\r', '%0D'), '\\n', '%0A')),
            concat('WARC-Date: ', date_format(_date, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            concat('WARC-Payload-Digest: sha1:', _digest),
            concat('X-Payload-Length: ', _bytes),
            if(_again, concat('WARC-Refers-To: <urn:page:', cast(_first as string), '>'), null),
            if(_again, 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest', null),
            'Content-Type: application/http; msgtype=response',
            concat('Content-Length: ', octet_length(_block)), '', _block) as value"""
    )
    per_file = max(1, int(ARCHIVE_BYTES / max(1.0, float(sizes))))
    record.write.option("lineSep", _RECORD_END).option("compression", compression).option("maxRecordsPerFile", per_file).text(path)


_HEADER = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)")


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of every record of an unpacked archive."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at) + 4
        fields = {k.decode().lower(): v.decode() for k, v in _HEADER.findall(data, data.index(b"\r\n", at) + 2, end)}
        stop = end + int(fields["content-length"])
        yield at, stop + 4 - at, fields, data[end:stop]
        at = stop + 4


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the right, then path and query; no scheme, user,
    port, www or fragment."""
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host = (parts.hostname or "").lower()
    except ValueError:
        return url.lower()
    labels = [x for x in host.split(".") if x]
    labels = labels[1:] if labels[:1] == ["www"] and len(labels) > 2 else labels
    return ",".join(reversed(labels)) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


class LoserTree:
    """Merges sorted runs. A node keeps the loser of its match, so each step replays one path."""

    def __init__(self, runs: list[list], key: Callable):
        self.runs, self.key, self.at = runs, key, [0] * len(runs)
        self.heads = [key(run[0]) if run else None for run in runs]
        self.losers = [-1] * len(runs)
        for i in range(len(runs)):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; ended runs go last, ties by run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # the first to come waits for its match
                self.losers[node] = winner
                return
            if self._less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.runs and self.heads[winner := self.losers[0]] is not None:
            run, at = self.runs[winner], self.at[winner]
            yield run[at]
            self.at[winner] = at = at + 1
            self.heads[winner] = self.key(run[at]) if at < len(run) else None
            self._play(winner)


_CAPTURE = (
    "url_key string, timestamp string, page_id string, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to string, file string, offset long, length long"
)


def _captures(name: str, packed: bytes) -> list[dict]:
    data = zlib.decompress(packed, 31) if packed[:2] == b"\x1f\x8b" else packed
    found = []
    for offset, length, fields, block in records(data):
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload digest differs at byte {offset} of {name}")
        url = fields["warc-target-uri"]
        found.append(
            {
                "url_key": url_key(url),
                "timestamp": re.sub("[^0-9]", "", fields["warc-date"]),
                "page_id": fields["warc-record-id"].removeprefix("<urn:page:").removesuffix(">") or None,
                "url": url,
                "record_type": kind,
                "payload_digest": digest,
                "payload_bytes": len(payload) if kind == "response" else int(fields["x-payload-length"]),
                "refers_to": fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">") or None,
                "file": name,
                "offset": offset,
                "length": length,
            }
        )
    return found


def _order(capture: dict) -> tuple:
    return capture["url_key"], capture["timestamp"], capture["page_id"] or "", capture["offset"]


_BLOCK = "file string, block int, captures array<struct<" + ", ".join(part.replace(" ", ": ") for part in _CAPTURE.split(", ")) + ">>"


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below `path`: of every archive one run, sorted by URL key and
    time, in blocks of BLOCK_ROWS. offset and length point into the unpacked archive."""
    wanted = StructType.fromDDL(_BLOCK)
    arrow = to_arrow_schema(wanted)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch["path"][i].as_py().rpartition("/")[2]
                run = sorted(_captures(name, batch["content"][i].as_py()), key=_order)
                blocks = [run[at : at + BLOCK_ROWS] for at in range(0, len(run), BLOCK_ROWS)]
                rows = [{"file": name, "block": k, "captures": block} for k, block in enumerate(blocks)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(index, wanted)


def _cuts(runs: DataFrame) -> list[tuple]:
    """Where the ranges of about RANGE_ROWS captures begin, but for the first: quantiles of at most
    some SAMPLED captures a range."""
    captures, blocks = runs.agg(F.sum(F.size("captures")), F.count(F.lit(1))).first()
    ranges = -(-(captures or 0) // RANGE_ROWS)
    if ranges < 2:
        return []
    one_in = max(1, blocks // (SAMPLED * ranges))
    drawn = runs.where(f"pmod(xxhash64(file, block), {one_in}) = 0").selectExpr("inline(slice(captures, cast(pmod(xxhash64(block, file), size(captures)) as int) + 1, 1))")
    keys = sorted(_order(row.asDict()) for row in drawn.select("url_key", "timestamp", "page_id", "offset").collect())
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)})


def _by_range(runs: DataFrame, cuts: list[tuple]) -> DataFrame:
    """The blocks, cut where a range begins, with their `range` and `first` key."""
    wanted = StructType.fromDDL(f"range int, first struct<url_key: string, timestamp: string, page_id: string, offset: long>, {_BLOCK}")
    arrow = to_arrow_schema(wanted)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                captures, at = row["captures"], 0
                while at < len(captures):
                    own = bisect_right(cuts, _order(captures[at]))
                    stop = bisect_left(captures, cuts[own], at, key=_order) if own < len(cuts) else len(captures)
                    first = dict(zip(("url_key", "timestamp", "page_id", "offset"), _order(captures[at])))
                    out.append(row | {"range": own, "first": first, "captures": captures[at:stop]})
                    at = stop
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return runs.mapInArrow(cut, wanted)


def _seen_before(parts: DataFrame) -> dict[int, tuple[str, int]]:
    """Of each range the URL key it begins with, and how many captures of that lie in earlier
    ranges: one row per range."""
    heads = stage(parts.groupBy("range").agg(F.min("first.url_key").alias("url_key")), "heads")
    held = parts.selectExpr("range", "explode(captures.url_key) as url_key").groupBy("range", "url_key").count()
    counts = attach(held, heads.select("url_key").distinct(), ["url_key"]).withColumnsRenamed({"range": "_range"})
    earlier = heads.join(counts, "url_key").where("_range < range").groupBy("range", "url_key").agg(F.sum("count").alias("n"))
    return {row.range: (row.url_key, row.n) for row in earlier.collect()}


def merged(blocks: Iterator[list[dict]]) -> Iterator[dict]:
    """All captures of sorted blocks in order. Blocks come by their first capture, so whatever lies
    before the next block's first is complete and is merged by a loser tree, one run per archive;
    of each archive only what reaches beyond is held."""
    held: dict[str, list[dict]] = {}
    after = next(blocks, None)
    while after is not None:
        for _ in range(WAVE):
            held.setdefault(after[0]["file"], []).extend(after)
            after = next(blocks, None)
            if after is None:
                break
        runs = []
        for name in sorted(held):
            run = held[name]
            ready = len(run) if after is None else bisect_left(run, _order(after[0]), key=_order)
            runs.append(run[:ready])
            held[name] = run[ready:]
        held = {name: run for name, run in held.items() if run}
        yield from LoserTree(runs, _order)


def merge_index(runs: DataFrame) -> DataFrame:
    """All captures of the blocks of `runs` in the order of URL key, time and page, with `place`, the
    capture's place in the history of its URL key, from 1.

    The partitions are ranges of that order, cut by quantiles of the whole of it, so the captures
    of one URL spread over several tasks if they are many. A task reads the blocks of its range by
    their first capture and holds no more of each run than the blocks that lie across the place
    it has come to.
    """
    written = stage(runs, "runs")
    parts = stage(_by_range(written, _cuts(written)), "parts")
    before = _seen_before(parts)
    ranges = (parts.agg(F.max("range")).first()[0] or 0) + 1
    wanted = StructType.fromDDL(f"{_CAPTURE}, place long")
    arrow = to_arrow_schema(wanted)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
        for number, own in groupby(rows, key=itemgetter("range")):
            key, place = before.get(number, (None, 0))
            out: list[dict] = []
            for capture in merged(row["captures"] for row in own):
                place = place + 1 if capture["url_key"] == key else 1
                key = capture["url_key"]
                out.append(capture | {"place": place})
                if len(out) == 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    ordered = parts.repartitionByRange(ranges, "range").sortWithinPartitions("range", "first", "file", "block")
    return ordered.select("range", "captures").mapInArrow(merge, wanted)


def archived(pages: DataFrame, min_bytes: int = 0, path: str | None = None, compression: str = "gzip") -> DataFrame:
    """Write `pages` as archives, read them back, and return their captures in the merged order.

    NULL html is an empty payload, a NULL url an empty one, line ends in a URL come back
    percent-encoded; a NULL page_id comes back as NULL and
    is never referred to, unless all pages with a payload have none: then all are responses.
    An empty table gives an empty result; other columns are ignored. `path` is below the shared
    folder if not given.
    """
    path = path or fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes, compression=compression)
    return merge_index(capture_runs(pages.sparkSession, path))
