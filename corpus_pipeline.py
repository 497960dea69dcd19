"""A corpus from raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.llm import decontaminate, ngram_join, packing, personal, quality_rules
from docketframe.session import ship_package, small, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Names a row within a stage: rows that a stage reads alike share it, and no others but by chance (64 bits).
KEY = "_row_key"
#: Bytes of a row of keys, at most, where a table of them may be broadcast.
KEY_BYTES = 16


def _keyed(docs: DataFrame, *read: str) -> DataFrame:
    """``docs`` with a key of doc_id and the columns read, null ones included."""
    columns = [F.col(c) for c in ("doc_id", *read)]
    return docs.withColumn(KEY, F.xxhash64(*[x for c in columns for x in (c.isNull(), c)]))


def _by_key(keyed: DataFrame) -> DataFrame:
    """What operators get: the key takes the place of doc_id."""
    return keyed.drop("doc_id").withColumnRenamed(KEY, "doc_id")


def _without(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose key is not in ``gone``; where these are few, texts stay where they are."""
    return keyed.join(small(staged(gone.select(KEY)), KEY_BYTES), KEY, "left_anti")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or are outliers of their kind go."""
    ship_package(spark)
    keyed = _keyed(docs, "text", "lang", "source")
    poor = quality_rules.assess(_by_key(keyed)).where("NOT kept")
    return _without(keyed, poor.withColumnRenamed("doc_id", KEY)).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id; a null one is the largest.

    Rows that share a doc_id but not a text are documents of their own.
    """
    ship_package(spark)
    keyed = _keyed(docs, "text")
    near = ngram_join.near_duplicates(_by_key(keyed).select("doc_id", "text"))
    near = near.select(F.col("doc_id").alias(KEY), "component_id").dropDuplicates([KEY])
    named = keyed.groupBy(KEY).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    members = staged(near.join(named, KEY))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", KEY)).alias("first")
    kept = members.groupBy("component_id").agg(first).select(f"first.{KEY}")
    unlike = _without(keyed, members.join(kept, KEY, "left_anti"))
    # A row given twice is a group as well.
    twice = members.where("rows > 1").select(KEY)
    again = unlike.join(small(staged(twice), KEY_BYTES), KEY, "left_semi").dropDuplicates([KEY])
    return _without(unlike, twice).unionByName(again).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a run of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs, "text")
    hit = decontaminate.contamination(_by_key(keyed), items).where("contaminated")
    return _without(keyed, hit.withColumnRenamed("doc_id", KEY)).select(docs.columns)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    ship_package(spark)
    return personal.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    ship_package(spark)
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", drop_poor),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal),
    ("packing", pack_sequences),
]

#: The covariance estimates and the tokenizer are beyond SQL; tests compare with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
