"""WARC archives: a writer with revisit records, and a sequential reader."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import kept, new_folder

#: Payloads from this size on are written once, and revisited after that.
LEAST_REVISITED = 100
#: Uncompressed bytes after which a task begins a new archive.
ARCHIVE_BYTES = 256 << 20
#: Repeated digests up to this number are broadcast: about 20 MB.
BROADCAST_ROWS = 200_000
CHUNK = 1 << 20
#: A record whose head is longer is damaged: a URL of over 300 MB, each byte escaped.
HEAD_BYTES = 1 << 30
#: A block whose HTTP head is longer is damaged.
HTTP_BYTES = 1 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


def planned(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to of each row of `pages` (page_id, url, html).

    Of equal payloads of at least `least` bytes the one with the smallest page_id is a response and the others refer to it;
    rows that repeat that page_id are responses, too. A null html is an empty payload. Among equal payloads a row without page_id
    refers to the smallest there is, and if none has one, all are responses. Digests that occur once are dropped before the
    join; the rest are broadcast up to BROADCAST_ROWS, and joined beyond, where Spark may split a common one.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= least)
    repeated = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = kept(repeated.filter("n > 1 and first is not null").select("payload_digest", "first"), "repeated-payloads")
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    other = ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull()
    return rows.join(repeated, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest", F.when(other, F.col("first")).alias("refers_to")
    )


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record, uncompressed. A revisit has the payload's HTTP head only, with the length of what it stands for."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [VERSION, b"WARC-Type: ", b"response" if refers_to is None else b"revisit", b"\r\n"]
    fields = {
        "WARC-Record-ID": f"<{ID}{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:  # what would end the line is escaped
        fields["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<{ID}{refers_to}>", "WARC-Profile": REVISIT_PROFILE.decode()}
    head += [f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in fields.items()]
    return b"".join([*head, b"\r\n", block, b"\r\n\r\n"])


def written(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes `records` (see `planned`) below `folder` and gives path, records of the archives, as a kept table.

    Every record is a gzip member of its own. A task writes archives under names that its attempt alone uses, and the table of
    archives is committed by Spark: files of an attempt that was lost are not in it and are never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base)
        out, size, count, paths, counts = None, 0, 0, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if out is not None and size >= archive_bytes:
                    out.close()
                    counts.append(count)
                    out = None
                if out is None:
                    name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{len(paths):04d}.warc.gz"
                    out, size, count = files.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                    paths.append(f"{folder}/{name}")
                data = record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["refers_to"])
                member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                out.write(member.compress(data) + member.flush())
                size += len(data)
                count += 1
        if out is not None:
            out.close()
            counts.append(count)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

    columns = records.select(F.col("page_id").cast("bigint"), "url", "payload", "payload_digest", F.col("refers_to").cast("bigint"))
    return kept(columns.mapInArrow(write, "path string, records bigint"), "archives")


class Damaged(ValueError):
    """An archive that is cut off, not framed as it says, or has another content than its digests."""


def _members(stream) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as its data in pieces. A member must be read to its end before the next."""
    rest = stream.read(CHUNK)
    while rest:
        member, last = zlib.decompressobj(31), [b""]

        def pieces(data: bytes = rest, member=member, last=last) -> Iterator[bytes]:
            while True:
                piece = member.decompress(data, CHUNK)
                if piece:
                    yield piece
                if member.eof:
                    last[0] = member.unused_data
                    return
                data = member.unconsumed_tail or stream.read(CHUNK)
                if not data and not piece:
                    raise Damaged("the archive ends within a record")

        yield pieces()
        if not member.eof:
            raise Damaged("a record was not read to its end")
        rest = last[0] or stream.read(CHUNK)


def _head(data: bytes) -> dict[str, str]:
    lines = data.split(b"\r\n")
    out = {}
    for line in lines[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "surrogatepass")
    return out


def read_record(pieces: Iterator[bytes], with_payload: bool) -> dict:
    """The record of one member: framed by Content-Length, digests verified. Holds the payload only if it is asked for."""
    read, end = bytearray(), -1
    while end < 0:
        if len(read) > HEAD_BYTES:
            raise Damaged("a record has no end of its head")
        if not (piece := next(pieces, b"")):
            raise Damaged("a record ends within its head")
        looked = max(0, len(read) - 3)  # the end may lie across two pieces
        read += piece
        end = read.find(b"\r\n\r\n", looked)
    data = bytes(read)
    if not data.startswith(b"WARC/1."):
        raise Damaged("a member does not begin with a WARC version")
    head, data = _head(data[:end]), data[end + 4 :]
    left = int(head["content-length"])
    block, payload, http, kept_payload, n = hashlib.sha256(), hashlib.sha256(), b"", [], 0
    in_payload = False
    while True:
        take, data = data[:left], data[left:]
        left -= len(take)
        block.update(take)
        if not in_payload:
            http += take
            if (end := http.find(b"\r\n\r\n")) >= 0:
                take, http, in_payload = http[end + 4 :], http[:end], True
            elif len(http) > HTTP_BYTES:
                raise Damaged("a block has no end of its HTTP head")
        if in_payload:
            payload.update(take)
            n += len(take)
            if with_payload:
                kept_payload.append(take)
        if not left:
            break
        if not (data := next(pieces, b"")):
            raise Damaged("a record is shorter than its Content-Length")
    data += b"".join(pieces)
    if data != b"\r\n\r\n":
        raise Damaged("a record is not followed by two line ends")
    revisit = head["warc-type"] == "revisit"
    expected = head["warc-payload-digest"].removeprefix("sha256:")
    if head["warc-block-digest"] != f"sha256:{block.hexdigest()}":
        raise Damaged(f"{head['warc-record-id']} has another block than its digest says")
    full = int(_head(b"\r\n" + http.partition(b"\r\n")[2])["content-length"])
    if not revisit and (payload.hexdigest() != expected or n != full):
        raise Damaged(f"{head['warc-record-id']} has another payload than its digest says")

    def page(name: str):
        text = head[name].strip("<>").removeprefix(ID)
        return int(text) if text else None

    return {
        "page_id": page("warc-record-id"),
        "url": head.get("warc-target-uri"),
        "payload_bytes": full,
        "payload_digest": expected,
        "record_type": head["warc-type"],
        "refers_to": page("warc-refers-to") if revisit else None,
        "payload": b"".join(kept_payload) if with_payload and not revisit else None,
    }


def read_archives(paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload of every record of the archives at `paths` (path).

    An archive is read from its beginning to its end by one task, a piece at a time. Damage raises `Damaged`. Revisits have no
    payload; their size and digest are those of the payload that they stand for.
    """
    fields = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([r[f] for r in rows], t) for f, t in zip(fields, types, strict=False)]
        return pa.RecordBatch.from_arrays(arrays, names=fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names in batches:
            for path in names.column(0).to_pylist():
                files, at = pafs.FileSystem.from_uri(path)
                rows, size = [], 0
                with files.open_input_stream(at, compression=None) as stream:
                    for member in _members(stream):
                        rows.append(read_record(member, with_payload))
                        size += len(rows[-1]["payload"] or b"") + 200
                        if size >= 8 * CHUNK:
                            yield batch(rows)
                            rows, size = [], 0
                yield batch(rows)

    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return paths.select("path").mapInArrow(read, schema + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, with_payload: bool = True) -> DataFrame:
    """Writes `pages` as archives in the shared folder and reads these back, see `planned`, `written` and `read_archives`.

    Rows repeated in `pages` are records of their own. Of columns beside page_id, url and html nothing is read. An empty table gives no rows.
    """
    archives = written(planned(pages), new_folder(pages.sparkSession, "warc"))
    files = max(1, archives.count())
    return read_archives(archives.select("path").repartition(files), with_payload)
