"""Archives read back, the merged order, and odd inputs."""

import base64
import gzip
import hashlib
import random
from pathlib import Path

from voltscape.llm import warc

SCHEMA = "page_id long, url string, html string, _sha string, _html string, value string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (5, "https://www.example.com/b?x=1#top", "<p>é</p>"),
    (3, "http://example.com/a", "same"),
    (4, "http://example.com/a", "same"),
    (9, "http://a.example.com:8080", "same"),
    (1, None, None),
    (2, "", ""),
    (7, "not a url\r\nX: y", "WARC/1.1\r\n\r\nfake\r\n\r\n"),
    (8, "http://[bad", "x" * 200_000),
    (None, "http://example.com/z", "same"),
    (None, "http://example.com/q", "only here"),
    (6, "http://example.com/a", "twice"),
    (6, "http://example.com/a", "twice"),
]


def wanted(rows, min_bytes=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    for i, _, html in rows:
        size, least = len((html or "").encode()), first.get(html or "")
        again = size >= min_bytes and least is not None and i != least
        yield (i or -1, size, digest(html), "revisit" if again else "response", least if again else None)


def found(frame):
    return [
        (int(r.page_id or -1), r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None)
        for r in frame.collect()
    ]


def test_read_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    for min_bytes in (0, 5):
        got = found(warc.archived(pages(spark, ROWS), min_bytes))
        assert sorted(got, key=str) == sorted(wanted(ROWS, min_bytes), key=str)


def test_global_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ROWS", 40)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)
    rng = random.Random(0)
    rows = [(i, f"http://h{rng.randrange(4)}.example.org/{rng.randrange(9)}", f"page {i % 50}") for i in range(400)]
    frame = warc.archived(pages(spark, rows))
    assert frame.rdd.getNumPartitions() >= 8
    got = frame.collect()
    keys = [(r.url_key, r.timestamp, r.page_id, r.offset) for r in got]
    assert keys == sorted(keys) and len(got) == 400
    assert len({r.file for r in got}) > 5
    # places in the history go on where a URL lies in several ranges
    places = {}
    for r in got:
        places.setdefault(r.url_key, []).append(r.place)
    assert all(own == list(range(1, len(own) + 1)) for own in places.values())


def test_one_url_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ROWS", 30)
    monkeypatch.setattr(warc, "BLOCK_ROWS", 7)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, "http://hot.example.org/" if i % 3 else f"http://a.example.org/{i}", f"page {i}") for i in range(300)]
    frame = warc.archived(pages(spark, rows))
    got = frame.collect()
    assert frame.rdd.getNumPartitions() >= 5
    assert [r.place for r in got if r.url_key == "org,example,hot)/"] == list(range(1, 201))


def test_merged_holds_little(monkeypatch):
    """Blocks by their first capture come out in order, however they overlap."""
    monkeypatch.setattr(warc, "WAVE", 2)
    rng = random.Random(4)
    for _ in range(30):
        blocks = []
        for k in range(rng.randrange(1, 6)):
            run = sorted(
                ({"file": f"f{k}", "url_key": f"u{rng.randrange(9)}", "timestamp": str(rng.randrange(9)), "page_id": None, "offset": i} for i in range(rng.randrange(20))),
                key=warc._order,
            )
            blocks += [run[at : at + 3] for at in range(0, len(run), 3)]
        blocks.sort(key=lambda block: (warc._order(block[0]), block[0]["file"]))
        found = list(warc.merged(iter(blocks)))
        assert [warc._order(c) for c in found] == sorted(warc._order(c) for block in blocks for c in block)


def test_a_record_is_fetched_by_its_place(spark, tmp_path):
    path = str(tmp_path / "warc")
    got = warc.archived(pages(spark, ROWS), path=path, compression="none").collect()
    for r in got:
        with open(f"{path}/{r.file}", "rb") as file:
            file.seek(r.offset)
            ((_, length, fields, block),) = warc.records(file.read(r.length))
        assert length == r.length and fields["warc-payload-digest"] == f"sha1:{r.payload_digest}"
        assert r.record_type == "revisit" or block.endswith((dict((i, h) for i, _, h in ROWS).get(int(r.page_id or 0)) or "").encode())


def test_files_are_archives(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(pages(spark, ROWS), path)
    seen = 0
    for file in Path(path).glob("part-*"):
        data = gzip.decompress(file.read_bytes())
        for offset, length, fields, block in warc.records(data):
            record = data[offset : offset + length]
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            assert int(fields["content-length"]) == len(block) and block.startswith(b"HTTP/1.1 200 OK\r\n")
            seen += 1
    assert seen == len(ROWS)


def test_empty_table(spark):
    assert warc.archived(pages(spark, [])).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted((rng.randrange(20), i) for _ in range(rng.randrange(6))) for i in range(k)]
        merged = list(warc.LoserTree(runs, lambda x: x[0]))
        # ties go by run
        assert merged == sorted(x for run in runs for x in run)


def test_url_key():
    assert warc.url_key("https://www.Example.com:80/A?b=1#c") == "com,example)/A?b=1"
    assert warc.url_key("example.com") == "com,example)/"
    assert warc.url_key("") == ")/"
