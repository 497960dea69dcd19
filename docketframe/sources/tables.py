"""Readers."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketframe import schema
from docketframe.session import dealt, local_path, ship_package, staged

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
}


def read_part(
    spark: SparkSession,
    path: str | list[str],
    csv_schema: T.StructType = schema.CASE_CSV,
) -> DataFrame:
    """A CSV part (byte-order mark, quoted multi-line bodies) under engine names.

    Columns go by their header, in any order: those of ``csv_schema`` that a file
    lacks are '', others are ignored.  Files read together must have one header.
    Values stay text with '' for missing, as in the file, but ``seq`` is a
    number.  A multi-line file is read by one task, so keep part files moderate
    and turn them into Parquet once (:func:`ingest_parts`).
    """
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns or csv_schema.names
    # Not enforced: every file's header is then compared with this one.
    raw = spark.read.schema(schema.strings(header)).options(**CSV_OPTIONS, enforceSchema="false").csv(path)
    return part_columns(raw, header, csv_schema)


def part_columns(raw: DataFrame, header: Sequence[str], csv_schema: T.StructType) -> DataFrame:
    """The columns of a part under engine names, from values in the order of its header."""
    place = {h.removeprefix("\ufeff").strip(): i for i, h in enumerate(header)}
    df = raw.toDF(*[f"_{i}" for i in range(len(header))])

    def column(h: str) -> Column:
        return F.coalesce(f"_{place[h]}", F.lit("")) if h in place else F.lit("")

    return df.select(
        *[
            column(h).try_cast("bigint").alias("seq") if schema.COLUMN_OF[h] == "seq" else column(h).alias(schema.COLUMN_OF[h])
            for h in csv_schema.names
        ]
    )


def ingest_parts(spark: SparkSession, paths: Sequence[str], out: str) -> DataFrame:
    """Turn CSV parts into one Parquet table, one folder per part in order."""
    for part_no, path in enumerate(paths, 1):
        read_part(spark, path).write.mode("overwrite").parquet(f"{out}/part_no={part_no}")
    columns = [*schema.CASE.fields, T.StructField("part_no", T.IntegerType())]
    return spark.read.schema(T.StructType(columns)).parquet(out)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored page snapshots."""
    return spark.read.schema(schema.PAGE).parquet(path)


def read_json_records(
    spark: SparkSession, path: str, json_schema: T.StructType | None = None, array_file: bool = True
) -> DataFrame | None:
    """Records from JSON: one array per file, or (``array_file=False``) one
    object per line, which can be split.

    None if there is no such file, or without a schema if none can be found in
    it; under a given schema, what cannot be read is NULL.
    """
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", array_file)
    if json_schema is not None:
        reader = reader.schema(json_schema)
    try:
        df = reader.json(path)
        return None if df.columns == ["_corrupt_record"] else df
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_documents(spark: SparkSession, path: str, keyed: bool = False) -> DataFrame:
    """Whole text files, one document each; with ``keyed``, ``key`` is the first line of each (NULL if blank), and ``body`` what follows."""
    files = _plain_files(spark, path)
    if files is None:
        files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    if not keyed:
        return files
    first = F.substring_index("body", "\n", 1)
    return files.select("path", F.nullif(first, F.lit("")).alias("key"), F.substr("body", F.length(first) + 2).alias("body"))


#: Files that one task reads whole.
FILES_PER_TASK = 5_000
#: Bytes of texts that are handed on at once.
BATCH_BYTES = 4 << 20
# Names that are alike in a path and in its URI, and which no reader takes for compressed.
_PLAIN_NAME = re.compile(r"[A-Za-z0-9=-][A-Za-z0-9_.=-]*\.txt", re.ASCII)


def _plain_files(spark: SparkSession, path: str) -> DataFrame | None:
    """path, body: the text files of one local folder that holds no other; None for anything else.

    As Spark's whole-text reader, which makes a Hadoop configuration for each file and lists all of them on
    the driver; here a task lists the names, and they are dealt to tasks of ``FILES_PER_TASK``.
    """
    folder = local_path(spark, path) if isinstance(path, str) else None
    if folder is None or not os.path.isdir(folder):
        return None
    prefix = spark._jvm.org.apache.hadoop.fs.Path(f"file:{folder}").toUri().toString()
    ship_package(spark)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held: list[str], plain: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"name": held, "plain": [plain] * len(held)}, pa.schema([("name", pa.string()), ("plain", pa.bool_())]))

        for _ in batches:
            held: list[str] = []
            with os.scandir(folder) as found:
                for entry in found:
                    if entry.name[0] in "._":
                        continue
                    if not _PLAIN_NAME.fullmatch(entry.name) or not entry.is_file():
                        yield batch([""], False)
                        return
                    held.append(entry.name)
                    if len(held) == 50_000:
                        yield batch(held, True)
                        held = []
            yield batch(held, True)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(texts: dict[str, bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"{prefix}/{n}" for n in texts], pa.string()), pa.array([*texts.values()], pa.binary())], ["path", "body"])

        held, size = {}, 0
        for part in batches:
            for name in part["name"].to_pylist():
                with open(f"{folder}/{name}", "rb", buffering=0) as f:
                    text = f.read()
                if text:  # Spark passes over empty files
                    held[name] = text
                    size += len(text)
                if size >= BATCH_BYTES:
                    yield batch(held)
                    held, size = {}, 0
        yield batch(held)

    listed = staged(spark.range(1, numPartitions=1).mapInArrow(names, "name string, plain boolean"))
    if not listed.where("NOT plain").isEmpty():
        return None
    return dealt(listed.select("name"), FILES_PER_TASK).mapInArrow(read, "path string, body binary").withColumn("body", F.col("body").cast("string"))
