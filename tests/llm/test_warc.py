import gzip
import hashlib

import pytest
from pyarrow import fs as pafs

from assayer.llm import warc
from assayer.llm.common import new_folder

BIG = "x" * 200


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string, refers_to string")


def expected(rows):
    """By page: size, digest, type, referred page."""
    first = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None and len((html or "").encode()) >= 100:
            first[html] = min(page_id, first.get(html, page_id))
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        least = first.get(html)
        revisit = len(data) >= 100 and least is not None and page_id != least
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r)) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


EDGES = [
    (4, "http://a/4", BIG, "p", "r"),
    (2, None, BIG, "p", "r"),
    (2, None, BIG, "p", "r"),
    (9, "http://a/ 9\r\nX: y", BIG, None, None),
    (None, "http://a/n", BIG, "p", "r"),
    (None, "http://a/n", "only without an id " * 10, "p", "r"),
    (None, "http://a/n", "only without an id " * 10, "p", "r"),
    (5, "u", None, "p", "r"),
    (6, "u", "", "p", "r"),
    (7, "u", "short", "p", "r"),
    (8, "u", "short", "p", "r"),
    (10, "u", "\r\n\r\nWARC/1.1\r\n\x00é" * 300_000, "p", "r"),
]


def test_edge_rows(spark):
    source = pages(spark, EDGES)
    back = warc.round_trip(source)
    assert got(back) == expected(EDGES)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in back.filter("record_type = 'response' and page_id is not null").collect()}
    assert payloads[10] == EDGES[-1][2].encode() and payloads[5] == b"" and payloads[2] == BIG.encode()
    assert {r["url"] for r in back.filter("page_id = 9").collect()} == {"http://a/%209%0D%0AX:%20y"}
    assert warc.round_trip(pages(spark, [])).collect() == []


def test_pages(spark, sf):
    source = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in source.collect()]
    assert got(warc.round_trip(source, with_payload=False)) == expected(rows)


def archived(spark, rows, **options):
    return warc.written(warc.planned(pages(spark, rows).coalesce(1)), new_folder(spark, "test-warc"), **options)


def test_archives_are_gzip_members_and_roll_over(spark):
    archives = archived(spark, EDGES, archive_bytes=1_000).collect()
    assert len(archives) > 3 and sum(r["records"] for r in archives) == len(EDGES)
    files, path = pafs.FileSystem.from_uri(archives[0]["path"])
    with files.open_input_stream(path, compression=None) as stream:
        data = stream.read()
    assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert data.count(b"\x1f\x8b\x08") >= archives[0]["records"]


def damaged(spark, change):
    """One archive of three records with its uncompressed members changed, and read."""
    import zlib

    archives = archived(spark, [(i, "u", f"{i}" * 300, None, None) for i in range(3)])
    place = archives.first()["path"]
    files, path = pafs.FileSystem.from_uri(place)
    with files.open_input_stream(path, compression=None) as stream:
        data, members = stream.read(), []
    while data:
        member = zlib.decompressobj(31)
        members.append(member.decompress(data))
        data = member.unused_data
    out = change(members)
    if isinstance(out, list):
        out = b"".join(gzip.compress(m) for m in out)
    with files.open_output_stream(path + "x", compression=None) as stream:
        stream.write(out)
    return warc.read_archives(spark.createDataFrame([(place + "x",)], "path string"))


@pytest.mark.parametrize(
    "change, why",
    [
        (lambda m: [m[0], m[1].replace(b"1" * 300, b"1" * 299 + b"2"), m[2]], "another block"),
        (lambda m: [m[0], m[1].replace(b"1" * 300, b"1" * 299), m[2]], "two line ends|shorter"),
        (lambda m: [m[0][:40]], "within its head"),
        (lambda m: [b"HTTP" + m[0]], "WARC version"),
        (lambda m: [m[0][:-2]], "two line ends"),
        (lambda m: gzip.compress(m[0])[:-9], "ends within a record|Damaged|two line"),
    ],
)
def test_damage_is_found(spark, change, why):
    with pytest.raises(Exception, match=why):
        damaged(spark, change).collect()


def test_unchanged_members_are_read(spark):
    assert damaged(spark, lambda m: m).count() == 3


def test_members_in_small_pieces(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 7)
    data = b"".join(gzip.compress(warc.record(i, "u", b"p" * i, hashlib.sha256(b"p" * i).hexdigest(), None)) for i in range(30))

    class Stream:
        at = 0

        def read(self, n):
            self.at += n
            return data[self.at - n : self.at]

    assert [warc.read_record(m, True)["payload_bytes"] for m in warc._members(Stream())] == list(range(30))


def test_urls_of_any_length(spark):
    rows = [(1, "http://a/" + "x" * 3_500_000, BIG, None, None), (2, "http://b/" + " " * 400_000, BIG, None, None)]
    back = {r["page_id"]: r for r in warc.round_trip(pages(spark, rows)).collect()}
    assert back[1]["url"] == rows[0][1] and back[2]["url"] == "http://b/" + "%20" * 400_000
    assert back[2]["refers_to"] == 1
