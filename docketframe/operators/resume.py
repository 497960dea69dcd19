"""What is collected already, kept so that a resumed run need not read all of it.

Keys are stored by bucket of their hash, each bucket with a Bloom filter.  A run
probes the filters with its own keys; a key that no filter knows is new for
certain.  Only for the few that a filter claims to know are the keys of their buckets
read and compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.session import ship_package, staged

#: Keys for which a bucket is laid out; its filter takes ``BITS_PER_KEY`` bits for each.
BUCKET_KEYS = 1_000_000
BITS_PER_KEY = 12
PROBES = 8

FILTER = "bucket int, buckets int, bits binary"


def _texts(df: DataFrame, key: str) -> DataFrame:
    """Keys as text, so that numbers of different types are one key."""
    return df.select(F.col(key).cast("string").alias("key")).where("key IS NOT NULL")


def _hashed(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.select(
        "key", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"),
        F.xxhash64("key", F.lit(1)).alias("h1"), F.xxhash64("key", F.lit(2)).alias("h2"),
    )


def _places(batch: pa.RecordBatch, bits: int) -> np.ndarray:
    """The places in a filter of ``bits`` bits that each key sets: (keys, PROBES)."""
    one, step = (batch[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    return (one[:, None] + np.arange(PROBES, dtype=np.uint64) * (step[:, None] | np.uint64(1))) % np.uint64(bits)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        buckets = batch["bucket"].to_numpy()
        edges = (np.flatnonzero(np.diff(buckets)) + 1).tolist()
        for s, e in zip([0, *edges], [*edges, len(batch)]):
            if s < e:
                yield int(buckets[s]), batch.slice(s, e - s)


def _filters(buckets: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(bucket: int, on: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array([bucket], pa.int32()), pa.array([buckets], pa.int32()), pa.array([np.packbits(on).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "buckets", "bits"])

        here, on = None, None
        for bucket, part in _by_bucket(batches):
            if bucket != here:
                if here is not None:
                    yield made(here, on)
                here, on = bucket, np.zeros(bits, bool)
            on[_places(part, bits).ravel()] = True
        if here is not None:
            yield made(here, on)

    return run


def remember(done: DataFrame, key: str, path: str, bucket_keys: int = BUCKET_KEYS) -> None:
    """Add the keys of ``done`` to those stored under ``path``.

    The first call lays out the buckets for as many keys as it is given; filters that later get far more
    keys let more of them through to the exact comparison, and nothing else changes.
    NULL keys are left out.  A key may be given again.
    """
    spark = done.sparkSession
    ship_package(spark)
    keys = staged(_texts(done, key).distinct())
    n = keys.count()
    known = _layout(spark, path)
    buckets, bits = known or (max(1, -(-n // bucket_keys)), 8 * -(-min(n or 1, bucket_keys) * BITS_PER_KEY // 8))
    hashed = _hashed(keys, buckets).repartition("bucket").sortWithinPartitions("bucket")
    hashed.mapInArrow(_filters(buckets, bits), FILTER).write.mode("append").parquet(f"{path}/filters")
    hashed.select("key", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{path}/keys")


def _layout(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """(number of buckets, bits of a filter) of what is stored, if anything is."""
    try:
        row = spark.read.schema(FILTER).parquet(f"{path}/filters").select("buckets", F.octet_length("bits").alias("n")).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return row and (row["buckets"], 8 * row["n"])


def _claimed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket come the filters first, then the keys, which stream through."""
    here, on = None, None
    for bucket, part in _by_bucket(batches):
        if bucket != here:
            here, on = bucket, None
        filters = part["bits"].drop_null()
        for bits in filters:
            own = np.frombuffer(bits.as_buffer(), np.uint8)
            on = own if on is None else on | own
        asked = part.slice(len(filters))
        if on is not None and len(asked):
            places = _places(asked, 8 * len(on))
            hit = (on[places >> np.uint64(3)] >> (np.uint64(7) - (places & np.uint64(7))).astype(np.uint8) & 1).all(axis=1)
            yield asked.filter(pa.array(hit)).select(["key", "bucket"])


def claimed(todo: DataFrame, key: str, path: str) -> DataFrame:
    """key, bucket: the keys of ``todo``, as text and each once, that a filter claims to know."""
    spark = todo.sparkSession
    ship_package(spark)
    buckets, _ = _layout(spark, path)
    keys = _hashed(_texts(todo, key).distinct(), buckets)
    nothing = {"key": F.lit(None).cast("string"), "h1": F.lit(0).cast("bigint"), "h2": F.lit(0).cast("bigint")}
    filters = spark.read.schema(FILTER).parquet(f"{path}/filters").withColumns(nothing)
    columns = ["bucket", "bits", "key", "h1", "h2"]
    both = filters.select(columns).unionByName(keys.withColumn("bits", F.lit(None).cast("binary")).select(columns))
    ordered = both.repartition("bucket").sortWithinPartitions("bucket", F.col("bits").isNull())
    return ordered.mapInArrow(_claimed, "key string, bucket int")


def not_remembered(todo: DataFrame, key: str, path: str) -> DataFrame:
    """Rows of ``todo`` whose key is not among those stored under ``path``; rows without a key are kept.

    Keys alone are shuffled to the filters.  Of the stored keys only the buckets of claimed ones are read; the
    rows of ``todo`` then meet the keys that were truly found, which Spark broadcasts when they are few.
    """
    spark = todo.sparkSession
    if _layout(spark, path) is None:
        return todo
    hits = staged(claimed(todo, key, path))
    # As many numbers as there are buckets, at most.
    buckets = [r.bucket for r in hits.select("bucket").distinct().collect()]
    stored = spark.read.schema("key string, bucket int").parquet(f"{path}/keys").where(F.col("bucket").isin(buckets))
    found = hits.join(stored, ["bucket", "key"], "left_semi").select(F.col("key").alias("_found"))
    return todo.join(found, F.col(key).cast("string") == F.col("_found"), "left_anti")
