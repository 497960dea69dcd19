"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each of a group of records,
and a last, skippable frame with the seek table: the sizes of all frames, in
the public seekable format.  A record is found by its bundle, its frame and its
offset in the frame, so reading one costs one frame.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe.session import new_path, staged

#: Bytes of records in a frame and of frames in a bundle; a longer record has a frame of its own.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 32 << 20
#: Payloads below this size are always stored.
LEAST_SHARED = 100

# Fixed values of the seekable format.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_EOL = b"\r\n"

INDEX = "bundle string, page_id long, frame int, frame_start long, frame_size long, record_start long, record_size long"
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "stored_bytes long, stored_digest string"
)
#: What precedes a payload in a response's block.
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _files(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame with (compressed, plain) sizes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    file.seek(size - 9 - count * entry)
    table, out, start = file.read(count * entry), [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        out.append((start, packed, plain))
        start += packed
    return out


def _header_text(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _headed(kind: str, date: str, lines: list[str], content: bytes) -> bytes:
    own = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{uuid.uuid4().urn}>", f"WARC-Date: {date}", *lines, f"Content-Length: {len(content)}"]
    return _EOL.join(x.encode() for x in own) + _EOL * 2 + content + _EOL * 2


def information(date: str) -> bytes:
    """The record that a bundle begins with."""
    content = b"software: docketframe\r\nformat: WARC File Format 1.1\r\n"
    return _headed("warcinfo", date, ["Content-Type: application/warc-fields"], content)


def record(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes | None, date: str) -> bytes:
    """One record; ``payload`` None: a revisit of the page ``refers_to``.

    Ids of records are new ones; ids of pages have headers of their own.
    """
    lines = ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if payload is None:
        lines += [f"X-Refers-To-Page-ID: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        return _headed("revisit", date, lines, b"")
    return _headed("response", date, lines, HTTP_HEAD % len(payload) + payload)


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(start, end, headers, content) of each record of a frame."""
    start = 0
    while start < len(data):
        body = data.index(_EOL * 2, start) + 4
        lines = data[start : body - 4].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        end = body + int(headers["Content-Length"])
        yield start, end + 4, headers, data[body:end]
        start = end + 4


class _Bundle:
    """A bundle as it is written; complete once closed."""

    def __init__(self, folder: str, date: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        fs, path = _files(self.uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.file, self.frames, self.size = fs.open_output_stream(path, compression=None), [], 0
        self.open, self.held, self.index = io.BytesIO(), [], []
        self.open.write(information(date))

    def add(self, page_id, data: bytes) -> None:
        self.held.append((page_id, self.open.tell(), len(data)))
        self.open.write(data)
        if self.open.tell() >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        packed = zstandard.ZstdCompressor(level=3).compress(self.open.getvalue())
        self.file.write(packed)
        self.index += [(self.uri, p, len(self.frames), self.size, len(packed), s, n) for p, s, n in self.held]
        self.frames.append((len(packed), self.open.tell()))
        self.size += len(packed)
        self.open, self.held = io.BytesIO(), []

    def close(self) -> list[tuple]:
        self.flush()
        self.file.write(seek_table(self.frames))
        self.file.close()
        return self.index


def _payload() -> Column:
    return F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row and return the index: where each record is.

    ``pages`` has page_id, url and html; other columns are ignored.  A null html
    is an empty payload.  Of rows with equal payloads of LEAST_SHARED bytes or
    more those with the smallest page_id are stored and the others refer to it;
    rows repeated with that page_id are each stored.  Rows with a null page_id
    are stored unless one that has an id holds the same.  No rows give no files.

    Files have new names in each attempt of a task.  The index is what tasks
    that ended well returned, so files of lost ones are in no index.
    """
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    # The digest of payloads too small to be shared is left out of the join.
    digest = F.sha2(_payload(), 256)
    shared = F.when(F.octet_length(F.col("html")) >= LEAST_SHARED, digest)
    # The least id of each payload that several rows hold; others need no join.
    first = (
        read.select(shared.alias("shared"), "page_id").where("shared IS NOT NULL")
        .groupBy("shared").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    with_first = read.withColumn("shared", shared).join(first, "shared", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    rows = with_first.select("page_id", "url", F.coalesce("shared", digest).alias("digest"), refers.alias("refers_to"), _payload().alias("payload"))

    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(source):
        bundle, names = None, [c.split()[0] for c in INDEX.split(", ")]

        def out(index):
            return pa.RecordBatch.from_pydict(
                {n: [r[i] for r in index] for i, n in enumerate(names)},
                pa.schema([(n, pa.string() if n == "bundle" else pa.int32() if n == "frame" else pa.int64()) for n in names]),
            )

        for batch in source:
            for page_id, url, digest, refers_to, payload in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "digest", "refers_to", "payload"))):
                bundle = bundle or _Bundle(folder, date)
                bundle.add(page_id, record(page_id, url, digest, len(payload), refers_to, payload if refers_to is None else None, date))
                if bundle.size >= BUNDLE_BYTES:
                    yield out(bundle.close())
                    bundle = None
        if bundle:
            yield out(bundle.close())

    return rows.mapInArrow(write, INDEX)


def read_archive(index: DataFrame) -> DataFrame:
    """All records of the bundles of an index, as rows, a task for each bundle.

    ``payload_bytes`` and ``payload_digest`` are what a record says of its payload; ``stored_bytes`` and
    ``stored_digest`` are taken from the content, and null for revisits, which have none.
    """

    def read(source):
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in RECORD.split(", ")])
        for batch in source:
            for uri in batch["bundle"].to_pylist():
                fs, path = _files(uri)
                with fs.open_input_file(path) as file:
                    for start, packed, plain in read_seek_table(file):
                        file.seek(start)
                        data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=plain)
                        found = [_row(h, content) for _, _, h, content in records(data) if h["WARC-Type"] != "warcinfo"]
                        yield pa.RecordBatch.from_pydict({n: [r[i] for r in found] for i, n in enumerate(names)}, kinds)

    bundles = staged(index.select("bundle").distinct())
    return bundles.repartition(max(1, bundles.count())).mapInArrow(read, RECORD)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def payload_of(headers: dict[str, str], content: bytes) -> bytes:
    """The payload of a response's block: what follows its HTTP head."""
    return content[content.index(_EOL * 2) + 4 :] if headers["WARC-Type"] == "response" else content


def _row(headers: dict[str, str], content: bytes) -> tuple:
    kind = headers["WARC-Type"]
    payload = payload_of(headers, content) if kind == "response" else None
    return (
        _number(headers.get("X-Page-ID")),
        headers.get("WARC-Target-URI"),
        kind,
        _number(headers.get("X-Refers-To-Page-ID")),
        int(headers["X-Payload-Length"]),
        headers["WARC-Payload-Digest"].removeprefix("sha256:"),
        None if payload is None else len(payload),
        None if payload is None else hashlib.sha256(payload).hexdigest(),
    )


def fetch(index: DataFrame) -> DataFrame:
    """page_id and stored payload of the records that an index, or part of one, lists; a frame is read for each."""

    def read(source):
        for batch in source:
            cols = [batch[c].to_pylist() for c in ("bundle", "page_id", "frame_start", "frame_size", "record_start", "record_size")]
            ids, found = [], []
            for uri, page_id, start, size, at, n in zip(*cols):
                fs, path = _files(uri)
                with fs.open_input_file(path) as file:
                    file.seek(start)
                    frame = zstandard.ZstdDecompressor().decompressobj().decompress(file.read(size))
                _, _, headers, content = next(records(frame[at : at + n]))
                found.append(payload_of(headers, content))
                ids.append(page_id)
            yield pa.RecordBatch.from_pydict({"page_id": pa.array(ids, pa.int64()), "payload": pa.array(found, pa.binary())})

    return index.mapInArrow(read, "page_id long, payload binary")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write an archive into the shared folder, or ``folder``, and read it back, :func:`checked`."""
    folder = folder or new_path(pages.sparkSession, "warc")
    return checked(read_archive(staged(write_archive(pages, folder))))


def checked(records: DataFrame) -> DataFrame:
    """Records read back, with size and digest of each payload from the content read: of its own record, or
    of the one that it refers to.  They are null where that content is lost or is not what the record says."""
    back = staged(records)
    said = back.where("record_type = 'response' AND payload_digest = stored_digest")
    columns = ["page_id", "url", "record_type", "refers_to"]
    own = back.where("record_type = 'response'").select(
        *columns, *[F.when(F.col("payload_digest") == F.col("stored_digest"), F.col(c)).alias(f"payload_{c[7:]}") for c in ("stored_bytes", "stored_digest")]
    )
    others = back.where("record_type <> 'response'")
    # One row for each page that others refer to.
    shared = said.select(F.col("page_id").alias("_id"), F.col("stored_digest").alias("_digest"), F.col("stored_bytes").alias("_bytes"))
    shared = shared.join(others.select(F.col("refers_to").alias("_id")).distinct(), "_id", "left_semi").distinct()
    found = others.join(shared, (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return own.unionByName(found.select(*columns, F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest")))
