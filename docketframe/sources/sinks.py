"""Writers.  All write folders of files in parallel."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe import schema
from docketframe.functions.links import file_key
from docketframe.operators.records import export_table, flattened, report_block, text_report
from docketframe.session import dealt, local_path, remove, ship_package, small, staged
from docketframe.sources.frames import write_frames

BYTE_ORDER_MARK = "﻿"
# The writer would escape with a backslash and trim values by default.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


#: As ``compression``: a file for each task, compressed, and read back by many tasks (:mod:`docketframe.sources.frames`).
FRAMES = "frames"

#: Rows of one file.  A compressed file, or one with line breaks in its values, is read back by one task.
ROWS_PER_FILE = 50_000


def file_options(compression: str | None = None, rows_per_file: int = ROWS_PER_FILE) -> dict[str, str]:
    """Options of a text sink: ``compression`` such as ``"gzip"``, and how many rows a file may have (0: any number)."""
    return {"maxRecordsPerFile": str(rows_per_file), "compression": compression or "none"}


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    bom: bool = False,
    compression: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """CSV with header and minimal quoting; ``bom`` starts each file with the
    byte-order mark that spreadsheet programs look for."""
    if bom:
        first, *others = df.columns
        df = df.toDF(BYTE_ORDER_MARK + first, *others)
    if compression == FRAMES:
        _write_csv_frames(df, path, rows_per_file)
        return
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS, **file_options(compression, rows_per_file)).csv(path)


def _write_csv_frames(df: DataFrame, path: str, rows_per_file: int) -> None:
    if rows_per_file:
        raise ValueError("in frames, each task writes one file: rows_per_file has to be 0")
    spark = df.sparkSession
    ship_package(spark)

    def line(df: DataFrame) -> DataFrame:
        return df.select(F.to_csv(F.struct(*df.columns), CSV_WRITE_OPTIONS).alias("value"))

    names = [f"_{i}" for i in range(len(df.columns))]
    header = line(spark.createDataFrame([tuple(df.columns)], schema.strings(names))).first()["value"]
    write_frames(line(df.toDF(*names)), path, "\n", first=header)


def write_cases(df: DataFrame, path: str, **options) -> None:
    """The merged 7-column table."""
    write_csv(export_table(df, schema.CASE_COLUMNS), path, **options)


def write_flattened(df: DataFrame, path: str, **options) -> None:
    """The 9-column table with bodies on one line."""
    write_csv(export_table(flattened(df), schema.REVIEW_COLUMNS), path, **options)


def write_review(df: DataFrame, path: str) -> None:
    """The 9-column review table as Parquet."""
    export_table(df, schema.REVIEW_COLUMNS).write.mode("overwrite").parquet(path)


def write_text_report(
    df: DataFrame, path: str, seq: str = "seq", place: str | None = None, compression: str | None = None
) -> None:
    """The text report; its files, in name order, hold the records in order.

    With ``place``, the column that :func:`corpus.number_rows` gives under that name, the
    rows are in order as they are read, and each task writes a folder of its own; without, they are
    dealt to ranges first.
    """
    codec = compression or "none"
    if place is None:
        in_order = text_report(df, seq).repartitionByRange(seq).sortWithinPartitions(seq).select("value")
        in_order.write.mode("overwrite").text(path, compression=codec)
        return
    rows = df.select(F.col(place).alias("place"), F.col(seq).alias("_seq"), report_block(F.col(seq)).alias("value"))
    rows.sortWithinPartitions("place", "_seq").drop("_seq").write.mode("overwrite").partitionBy("place").text(path, compression=codec)


#: Documents that one task writes, a file each.
DOCUMENTS_PER_TASK = 5_000


def write_documents(df: DataFrame, path: str, key: str, text: str) -> None:
    """A text file for each value of ``key``: the key on the first line (blank if NULL), then the text; NULL is ''.

    All lie in one folder, as a folder for each costs several times what its file does.  Texts that
    share a key share a file, one after the other; rows without a key have a file each.
    """
    rows = df.select(F.col(key).cast("string").alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    again = staged(rows.groupBy("key").count().where("count > 1 AND key IS NOT NULL").select("key"))
    if not again.isEmpty():
        few = small(again, 64)
        shared = rows.join(few, "key", "left_semi").groupBy("key").agg(F.array_join(F.collect_list("text"), "\n").alias("text"))
        rows = rows.join(few, "key", "left_anti").unionByName(shared)
    whole = rows.select(F.concat(F.coalesce("key", F.lit("")), F.lit("\n"), "text").alias("value"))
    parts = dealt(whole, DOCUMENTS_PER_TASK)
    folder = local_path(df.sparkSession, path)
    if folder:
        _write_files(parts, folder)
        return
    # Tasks move their files into place themselves; the second version of the algorithm lets them.
    moved = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    parts.write.mode("overwrite").options(maxRecordsPerFile="1", **moved).text(path)


def _write_files(values: DataFrame, folder: str) -> None:
    """A text file for each value, as Spark's writer gives with one record a file, but made by plain file functions.

    Hadoop's local file system starts a process for each file and for each checksum file, to set its mode.
    Each attempt of a task writes under names of its own, aside; only files of attempts that ended well are moved in.
    """
    spark = values.sparkSession
    ship_package(spark)
    parent, name = os.path.split(folder)
    aside = f"{parent}/.{name}.{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, n = uuid.uuid4().hex, 0
        os.makedirs(f"{aside}/{attempt}")
        for batch in batches:
            for value in batch["value"].to_pylist():
                with open(f"{aside}/{attempt}/{n}", "wb", buffering=0) as f:
                    f.write(value + b"\n")
                n += 1
        yield pa.RecordBatch.from_pydict({"attempt": [attempt], "n": [n]})

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for attempt, n in zip(batch["attempt"].to_pylist(), batch["n"].to_pylist()):
                for i in range(n):
                    to = f"{folder}/part-{attempt}-{i}.txt"
                    try:
                        os.rename(f"{aside}/{attempt}/{i}", to)
                    except FileNotFoundError:
                        if not os.path.exists(to):  # else an attempt before this one moved it
                            raise
            yield batch

    try:
        # One row a task.
        told = values.select(F.col("value").cast("binary")).mapInArrow(write, "attempt string, n long").where("n > 0").collect()
        remove(spark, folder)
        os.makedirs(folder)
        if told:
            spark.createDataFrame(told, "attempt string, n long").repartition(len(told)).mapInArrow(move, "attempt string, n long").collect()
        open(f"{folder}/_SUCCESS", "w").close()
    finally:
        remove(spark, aside)


def write_json_records(
    df: DataFrame, path: str, compression: str | None = None, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Records as JSON lines."""
    df.write.mode("overwrite").options(**file_options(compression, rows_per_file)).json(path)


def write_json_array(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Records as JSON arrays, one element a line and one array a file; plain, or in ``FRAMES``."""
    if compression not in (None, FRAMES):
        raise ValueError(f"JSON arrays are plain or in frames, not {compression}")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = "["
        for batch in batches:
            texts = []
            for text in batch["value"].to_pylist():
                texts.append(before + text)
                before = ","
            yield pa.RecordBatch.from_pydict({"value": texts}, pa.schema([("value", pa.string())]))
        yield pa.RecordBatch.from_pydict({"value": ["]" if before == "," else "[]"]})

    as_text = df.select(F.to_json(F.struct(*df.columns)).alias("value")) if df.columns != ["value"] else df
    ship_package(df.sparkSession)
    if compression == FRAMES:
        write_frames(as_text, path, "}", ends=("[", ",", "]"))
        return
    as_text.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def write_page_store(details: DataFrame, path: str) -> None:
    """Raw HTML of detail records, keyed by a name free of path characters."""
    details.select(
        file_key(F.col("case_no"), F.col("index")).alias("file_key"),
        F.col("html_content").alias("html"),
    ).write.mode("overwrite").parquet(path)
