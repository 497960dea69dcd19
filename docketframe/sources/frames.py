"""Text files that are compressed and can still be read by many tasks each.

A file is a row of Zstandard frames, and behind each lies a skippable frame that holds
``MARK``: any program for Zstandard gives the text.  Spark's text reader, told that ``MARK`` ends a
line, splits such a file between frames, on any file system.  A frame ends behind a separator of the
text (a line end, say), so that tasks can begin with any frame.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII, and its first character occurs in it only once.
MARK = "~docketframe: the end of a frame;"
_MARK = MARK.encode()
_SKIPPED = struct.pack("<II", 0x184D2A5D, len(_MARK))
#: Bytes of text from which a frame is closed.
FRAME_BYTES = 2 << 20
#: A split of a file is by so much smaller than one of plain text, since its text is longer than itself.
PACKED = 32
_SPLIT = "spark.sql.files.maxPartitionBytes"


def _packed(text: bytes) -> bytes:
    """Frames that hold a text, and no ``MARK``; one, unless a frame does by chance."""
    frame = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(text)
    if _MARK not in frame:
        return frame
    half = len(text) // 2
    return _packed(text[:half]) + _packed(text[half:])


def _frames(texts: Iterator[bytes], separator: bytes, frame_bytes: int = FRAME_BYTES) -> Iterator[bytes]:
    """A file's text as frames, each with the head of the skippable frame behind it."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= frame_bytes and separator in text:
            whole = b"".join(held)
            end = whole.rindex(separator) + len(separator)
            yield _packed(whole[:end]) + _SKIPPED
            held, size = [whole[end:]], len(whole) - end
    if size:
        yield _packed(b"".join(held)) + _SKIPPED


def write_frames(
    lines: DataFrame,
    path: str,
    separator: str,
    first: str | None = None,
    ends: tuple[str, str, str] | None = None,
    frame_bytes: int = FRAME_BYTES,
) -> None:
    """The lines of column ``value`` as a file for each task, cut behind ``separator``.

    ``first`` is a line that every file begins with.  ``ends`` are what stands before the first line, before
    every other, and on a last line of its own, which follows both if there is no other.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[bytes]:
            before, other, last = (e.encode() for e in ends or ("", "", ""))
            if first is not None:
                yield first.encode() + b"\n"
            some = False
            for batch in batches:
                for text in batch["value"].to_pylist():
                    yield before + text + b"\n"
                    before, some = other, True
            if ends:
                yield (last if some else before + last) + b"\n"

        for frame in _frames(texts(), separator.encode(), frame_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([frame], pa.binary())], ["value"])

    packed = lines.select(F.col("value").cast("binary")).mapInArrow(pack, "value binary")
    options = {"lineSep": MARK, "maxRecordsPerFile": "0", "compression": "none"}
    packed.select(F.col("value").cast("string")).write.mode("overwrite").options(**options).text(path)


def text_of(row: bytes) -> bytes:
    """The text of a row that Spark's text reader gives."""
    if row[-len(_SKIPPED) :] != _SKIPPED:
        raise ValueError("this file was not written in frames")
    packed, out = row[: -len(_SKIPPED)], []
    while packed:
        reader = zstandard.ZstdDecompressor().decompressobj()
        out.append(reader.decompress(packed))
        if not reader.eof:
            raise ValueError("a frame is cut short")
        packed = reader.unused_data
    return b"".join(out)


def units_of(text: bytes, separator: str) -> pa.Array:
    """What lies between separators of one byte; nothing behind the last."""
    data, mark = np.frombuffer(text, np.uint8), ord(separator)
    at = data == mark
    ends = np.flatnonzero(at)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))])
    if len(data) and data[-1] != mark:
        offsets = np.append(offsets, len(data) - len(ends))
    buffers = pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[~at])
    return pa.StringArray.from_buffers(len(offsets) - 1, *buffers)


def unpacked(batches: Iterator[pa.RecordBatch], separator: str) -> Iterator[pa.RecordBatch]:
    """Rows of frames as rows of units, frame by frame; other columns are repeated."""
    for batch in batches:
        for i in range(len(batch)):
            units = units_of(text_of(batch["value"][i].as_py()), separator)
            repeated = [units if name == "value" else pa.repeat(batch[name][i], len(units)) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays(repeated, batch.schema.names)


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """While files of frames are read: splits that hold about as much text as those of plain files."""
    before = spark.conf.get(_SPLIT)
    plain = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))
    spark.conf.set(_SPLIT, str(max(1, plain // PACKED)))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)
