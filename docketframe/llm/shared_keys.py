"""Which hashed keys occur more than once in a corpus, at a few bytes a key.

Rows of (key, document, position) would be several times the corpus.  Here
tasks pack texts into batches, send each distinct key of a batch once, in
binary blocks dealt by hash, and get back the places, in the batch's own key
order, of those that other batches or texts hold too.  A key that a third of
all texts hold is one entry per batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe.llm import arrays

#: Bytes of text in a batch, unless one text alone is longer.
BATCH_BYTES = 3_000_000
#: Keys that one reducing group holds, about; each takes some 60 bytes there.
GROUP_KEYS = 2_000_000

COUNT = np.uint32(0x7FFFFFFF)
WANTED = np.uint32(0x80000000)

BATCH = "uid long, ids array<long>, sizes binary, texts binary"
BLOCK = "bucket int, uid long, entries int, low binary, more binary, state binary"
REPLY = "uid long, bucket int, places binary, totals binary"


def groups_for(docs: DataFrame, text: str = "text") -> int:
    """How many groups the keys of all words need; reads the lengths only."""
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * parts, 1 + size // (6 * GROUP_KEYS))


class Batch:
    def __init__(self, uid: int, ids: list, data: bytes, sizes: np.ndarray):
        self.uid, self.ids, self.bytes, self.sizes = uid, ids, data, sizes

    def words(self, word_bytes=arrays.BLANK_SEPARATED, lower=False) -> arrays.Words:
        return arrays.Words(np.frombuffer(self.bytes, np.uint8), self.sizes, word_bytes, lower)


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    """Texts of a task's rows (doc_id, text), packed.

    The number of a batch holds its task, its place there and a checksum of
    its texts.  A second reading of the same files gives the same batches.
    """
    arrays.give_back()
    task, held, n, size = TaskContext.get().partitionId(), [], 0, 0

    def close() -> Batch:
        ids = [x for part, _ in held for x in part.to_pylist()]
        data, sizes = arrays.joined(pa.concat_arrays([t.cast(pa.large_string()) for _, t in held]))
        seal = zlib.crc32(data, zlib.crc32(repr(ids).encode())) & 0xFFFFF
        return Batch(task << 40 | n << 20 | seal, ids, data, sizes)

    for rows in source:
        lengths = pc.fill_null(pc.binary_length(rows["text"]), 0).to_numpy(zero_copy_only=False)
        start = 0
        for i, length in enumerate(lengths):
            if size and size + length > BATCH_BYTES:
                held.append((rows["doc_id"][start:i], rows["text"][start:i]))
                yield close()
                held, n, size, start = [], n + 1, 0, i
            size += int(length) + 1
        held.append((rows["doc_id"][start:], rows["text"][start:]))
    if held and size:
        yield close()


def packed(docs: DataFrame) -> DataFrame:
    """The batches as rows, to be joined with replies."""

    def pack(source):
        for b in batches(source):
            texts = zstandard.ZstdCompressor(level=1).compress(b.bytes)
            yield pa.RecordBatch.from_pydict(
                {"uid": [b.uid], "ids": [b.ids], "sizes": [b.sizes.astype(np.int64).tobytes()], "texts": [texts]},
                pa.schema([("uid", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("texts", pa.binary())]),
            )
        arrays.give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pack, BATCH)


def unpacked(row: pa.Table) -> Batch:
    sizes = np.frombuffer(row["sizes"][0].as_py(), np.int64)
    texts = row["texts"][0].as_py()
    data = zstandard.ZstdDecompressor().decompress(texts, max_output_size=int(sizes.sum()) + len(sizes) + 1)
    return Batch(row["uid"][0].as_py(), row["ids"][0].as_py(), data, sizes)


class Keys:
    """The distinct keys of a batch, in the order that replies refer to.

    ``lanes``: a 64-bit hash, or two when equal keys must be equal beyond
    doubt.  Of the first, the bucket and 40 bits are kept, and the second whole.
    """

    def __init__(self, lanes: list[np.ndarray], groups: int):
        first = lanes[0]
        bucket = (first >> np.uint64(40)) % np.uint64(groups)
        hi = bucket << np.uint64(40) | first & arrays.MASK40
        lo = lanes[1] if len(lanes) > 1 else None
        at, self.group, self.counts = arrays.distinct(hi, lo)
        self.hi, self.lo = hi[at], None if lo is None else lo[at]
        self.edges = np.searchsorted(self.hi >> np.uint64(40), np.arange(groups + 1, dtype=np.uint64))

    def __len__(self) -> int:
        return len(self.hi)

    def blocks(self, uid: int, wanted: np.ndarray | None = None, state: str = "<u1", counts=None) -> pa.RecordBatch:
        """A row per bucket.  ``wanted``: of which keys the totals are asked for; default all."""
        low = np.ascontiguousarray(self.hi).view(np.uint8).reshape(-1, 8)[:, :5]
        kept = self.counts if counts is None else counts
        if state == "<u1":
            entry = np.minimum(kept, 2).astype(np.uint8) | (np.uint8(0x80) * (True if wanted is None else wanted)).astype(np.uint8)
        else:
            entry = kept.astype(np.uint32) | (WANTED * (True if wanted is None else wanted)).astype(np.uint32)
        filled = np.flatnonzero(np.diff(self.edges))
        cut = [(int(self.edges[b]), int(self.edges[b + 1])) for b in filled]
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(filled, pa.int32()),
                "uid": pa.array([uid] * len(filled), pa.int64()),
                "entries": pa.array([e - s for s, e in cut], pa.int32()),
                "low": pa.array([low[s:e].tobytes() for s, e in cut], pa.binary()),
                "more": pa.array([b"" if self.lo is None else self.lo[s:e].tobytes() for s, e in cut], pa.binary()),
                "state": pa.array([entry[s:e].tobytes() for s, e in cut], pa.binary()),
            }
        )

    def totals(self, replies: pa.Table) -> np.ndarray:
        """What the replies say of each key; 0 where they say nothing."""
        out = np.zeros(len(self), np.int64)
        for bucket, places, totals in zip(*(replies[c].to_pylist() for c in ("bucket", "places", "totals"))):
            out[self.edges[bucket] + np.frombuffer(places, np.uint32)] = np.frombuffer(totals, np.uint32)
        return out


def repeated(blocks: DataFrame) -> DataFrame:
    """Replies: of the wanted keys of each batch, those with a total of 2 or more."""

    def judge(rows: pa.Table) -> pa.Table:
        sizes = rows["entries"].to_numpy()
        low = np.zeros((int(sizes.sum()), 8), np.uint8)
        low[:, :5] = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(-1, 5)
        hi = low.view(np.uint64).ravel()
        more, state = b"".join(rows["more"].to_pylist()), b"".join(rows["state"].to_pylist())
        if len(state) == len(hi):
            s = np.frombuffer(state, np.uint8)
            count, wanted = (s & 0x7F).astype(np.int64), s >= 0x80
        else:
            s = np.frombuffer(state, np.uint32)
            count, wanted = (s & COUNT).astype(np.int64), s >= WANTED
        del low
        _, group, n = arrays.distinct(hi, np.frombuffer(more, np.uint64) if more else None)
        total = np.bincount(group, count, len(n)).astype(np.int64)[group]
        hit = wanted & (total >= 2)
        out, start = {"uid": [], "bucket": [], "places": [], "totals": []}, 0
        for uid, bucket, size in zip(*(rows[c].to_pylist() for c in ("uid", "bucket", "entries"))):
            own = np.flatnonzero(hit[start : start + size])
            if len(own):
                out["uid"].append(uid)
                out["bucket"].append(bucket)
                out["places"].append(own.astype(np.uint32).tobytes())
                out["totals"].append(np.minimum(total[start + own], 0xFFFFFFFF).astype(np.uint32).tobytes())
            start += size
        return pa.table(out, pa.schema([("uid", pa.int64()), ("bucket", pa.int32()), ("places", pa.binary()), ("totals", pa.binary())]))

    def judged(rows: pa.Table) -> pa.Table:
        out = judge(rows)
        arrays.give_back()
        return out

    return blocks.groupBy("bucket").applyInArrow(judged, REPLY)


def answered(docs: DataFrame, replies: DataFrame, use: Callable[[Batch, pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """``use(batch, its replies)`` for each batch, replies or not."""

    def meet(batch: pa.Table, own: pa.Table) -> pa.Table:
        if batch.num_rows == 0:
            raise RuntimeError("the texts were not read in the same batches again; stage them first")
        out = use(unpacked(batch), own)
        arrays.give_back()
        return out

    return packed(docs).groupBy("uid").cogroup(replies.groupBy("uid")).applyInArrow(meet, schema)


def mapped(docs: DataFrame, use: Callable[[Batch], pa.RecordBatch], schema: str) -> DataFrame:
    def run(source):
        for b in batches(source):
            yield use(b)
        arrays.give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
