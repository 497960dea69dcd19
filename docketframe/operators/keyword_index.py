"""A stored index of texts that answers which of them contain a phrase.

Every two neighbouring characters of a text, whatever its script, are a gram.  The index holds,
for each gram and block of rows, the rows that have it and the segments of their
texts where it stands.  A phrase can only stand in a segment that has all its
grams, so a search reads the lists of these, intersects them, reads the rows
that are left and looks at their texts once.

Segments overlap by ``OVERLAP`` characters: of a phrase no longer than that, all
grams are listed for the segment in which it begins.  Of a longer one the first grams are looked up.

On disk: ``grams`` is partitioned by a bucket of the gram and sorted by gram,
``texts`` is partitioned by block and sorted by key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.session import ship_package

SEGMENT = 4096
OVERLAP = 64
#: Rows of a block; a list of postings covers one block.
BLOCK_ROWS = 16_384
BUCKETS = 64
#: Tasks among which the blocks of one bucket are dealt.
SLICES = 16
#: Grams of a phrase that are looked up.
MOST_GRAMS = 16
#: Up to this many rows left are named in the scan's filter; more are joined.
FEW_ROWS = 10_000

_BITS = 21  # of a code point
#: Of the number of a segment among those of a portion of texts; with two code points it makes 63.
_PLACE_BITS = 21
POSTINGS = "gram long, block long, rows array<struct<key:long,segments:array<int>>>"
_GRAMS_READ = f"{POSTINGS}, bucket int, slice int"
_TEXTS_READ = "key long, text string, block long"


def _bucket(gram: int | np.ndarray) -> int | np.ndarray:
    return ((gram >> _BITS) * 31 + (gram & (1 << _BITS) - 1)) % BUCKETS


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from those before, and the number of rows."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.append(np.flatnonzero(new), len(new)).astype(np.int32)


def _portions(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of about ``size`` bytes of text together, one at least: arrays take some hundred bytes a character."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(batch):
            begun = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, begun + size, "right")))
            yield batch.slice(at, end - at)
            at = end


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _portions(batches):
        # Rows of one block lie together, so their texts' numbers are in the order of the blocks as well.
        batch = batch.take(np.argsort(batch["block"].to_numpy(), kind="stable"))
        texts = batch["text"].to_pylist()
        sizes = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), sizes)
        at = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        after = np.zeros_like(points)
        after[:-1] = points[1:]
        after[np.cumsum(sizes[sizes > 0]) - 1] = 0  # nothing follows the last character of a text
        gram, segment = points << _BITS | after, at // SEGMENT
        again = (at % SEGMENT < OVERLAP) & (segment > 0)
        # Segments of all texts are numbered in the order of their rows: with the gram that is one whole number to sort.
        before = np.cumsum(-(-sizes // SEGMENT))
        first_segment = np.append(0, before[:-1])
        place = first_segment[doc] + segment
        code = gram << _PLACE_BITS | place
        code = np.concatenate([code, code[again] - 1])
        code.sort()
        code = code[_changes(code)[:-1]]
        gram, place = code >> _PLACE_BITS, code & (1 << _PLACE_BITS) - 1
        doc = np.searchsorted(before, place, "right")
        segment, block = place - first_segment[doc], batch["block"].to_numpy()[doc]
        rows = _changes(gram, doc)
        lists = _changes(gram[rows[:-1]], block[rows[:-1]])
        first = rows[:-1][lists[:-1]]
        keys = pa.array(batch["key"].to_numpy()[doc[rows[:-1]]])
        segments = pa.ListArray.from_arrays(rows, pa.array(segment.astype(np.int32)))
        found = pa.StructArray.from_arrays([keys, segments], ["key", "segments"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram[first]), pa.array(block[first]), pa.ListArray.from_arrays(lists, found)], ["gram", "block", "rows"]
        )


def build(docs: DataFrame, key: str, text: str, path: str, block_rows: int = BLOCK_ROWS) -> None:
    """Store the index of a table's texts under ``path``, and the texts with it.

    ``key`` is a column of whole numbers.  Rows without a key or text are left out; rows that share a key
    are found by either text.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key IS NOT NULL AND text IS NOT NULL")
    blocks = max(1, -(-rows.count() // block_rows))
    # By a hash, so that blocks are of one size whatever the keys.
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    rows.repartition("block").sortWithinPartitions("block", "key").write.mode("overwrite").partitionBy("block").parquet(f"{path}/texts")
    stored = docs.sparkSession.read.schema(_TEXTS_READ).parquet(f"{path}/texts")
    low = F.col("gram").bitwiseAND(F.lit((1 << _BITS) - 1))
    bucket = F.pmod(F.shiftright("gram", _BITS) * 31 + low, F.lit(BUCKETS)).cast("int")
    (
        stored.mapInArrow(_postings, POSTINGS)
        .withColumns({"bucket": bucket, "slice": F.pmod("block", F.lit(SLICES)).cast("int")})
        # Tasks hold whole lists: the grouping needs no shuffle of its own.
        .repartition("bucket", "slice")
        .groupBy("bucket", "slice", "gram", "block")
        .agg(F.array_sort(F.flatten(F.collect_list("rows"))).alias("rows"))
        .sortWithinPartitions("bucket", "slice", "gram", "block")
        .write.mode("overwrite")
        .partitionBy("bucket", "slice")
        .parquet(f"{path}/grams")
    )


def grams_of(phrase: str) -> list[int]:
    """The grams by which a phrase of two characters or more is looked up."""
    points = [ord(c) for c in phrase[:OVERLAP]]
    grams = list(dict.fromkeys(a << _BITS | b for a, b in zip(points, points[1:])))
    step = -(-len(grams) // MOST_GRAMS)
    return grams[::step]


def candidates(spark: SparkSession, path: str, phrase: str) -> DataFrame:
    """block, key of the rows that have all grams of a phrase in one segment; a few lists are read."""
    lists = spark.read.schema(_GRAMS_READ).parquet(f"{path}/grams")
    if len(phrase) == 1:
        first = ord(phrase) << _BITS
        return lists.where(F.col("gram").between(first, first | (1 << _BITS) - 1)).select("block", F.explode("rows.key").alias("key")).distinct()
    grams = grams_of(phrase)
    lists = lists.where(F.col("bucket").isin(sorted({_bucket(g) for g in grams})) & F.col("gram").isin(grams))
    rows = lists.select("block", "gram", F.explode("rows").alias("r")).select("block", "gram", "r.key", F.explode("r.segments").alias("segment"))
    if len(grams) > 1:
        rows = rows.groupBy("block", "key", "segment").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams))
    return rows.select("block", "key").distinct()


def search(spark: SparkSession, path: str, phrase: str) -> DataFrame:
    """key, text of the rows whose text contains the phrase, as ``contains`` finds them.  '' is in every text."""
    texts = spark.read.schema(_TEXTS_READ).parquet(f"{path}/texts")
    if phrase:
        left = candidates(spark, path, phrase)
        few = left.limit(FEW_ROWS + 1).collect()
        if len(few) <= FEW_ROWS:
            texts = texts.where(F.col("block").isin(sorted({r.block for r in few})) & F.col("key").isin(sorted({r.key for r in few})))
        else:
            texts = texts.join(left, ["block", "key"], "left_semi")
    return texts.where(F.contains("text", F.lit(phrase))).select("key", "text")
