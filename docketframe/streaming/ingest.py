"""Resumable collection with Structured Streaming.

All field, cleaning and page operators are row-wise, so the same functions run
here.  Rows are numbered batch by batch (:func:`append_numbered`); caps and other counts
run in batch on what a stream has stored.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from docketframe.operators.corpus import number_rows

log = logging.getLogger(__name__)

RowWise = Callable[[DataFrame], DataFrame]


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """New files under a path, each once."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_progress(df: DataFrame, body: str = "body", name: str = "progress") -> DataFrame:
    """Count rows and characters on the way; read from the query's progress."""
    chars = F.length(F.coalesce(body, F.lit(""))).cast("bigint")
    return df.observe(
        name, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(chars), F.lit(0)).alias("chars")
    )


def append(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    transform: RowWise = lambda df: df,
    fmt: str = "parquet",
    **options: str,
) -> StreamingQuery:
    """Process all files there are, append the rows, stop.

    Started again on the same checkpoint it goes on with the files that are
    new; every row is stored exactly once, also after a stop in mid-batch.
    """
    return (
        transform(stream)
        .writeStream.format(fmt)
        .outputMode("append")
        .options(**options)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_batches(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    transform: RowWise = lambda df: df,
) -> StreamingQuery:
    """As :func:`append` for batch-only work: each micro-batch owns one folder,
    which a repeated batch overwrites, so repeating changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_number(spark: SparkSession, numbers: str, batch_id: int, start: int = 0) -> int:
    """The highest number given before a batch; ``start`` before the first.

    Batch ids follow each other without gaps, so one small file is read, however many there are.
    """
    if batch_id == 0:
        return start
    return spark.read.schema("last bigint").parquet(f"{numbers}/batch_id={batch_id - 1}").first()["last"]


def append_numbered(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    order_by: Sequence[str],
    seq: str = "seq",
    start: int = 0,
    then: RowWise = lambda df: df,
    before_commit: Callable[[int], None] = lambda batch_id: None,
) -> StreamingQuery:
    """As :func:`append_batches`, with running numbers ``start + 1`` … that go on from batch to batch.

    Each micro-batch takes the range of numbers after that of the batch before
    it; inside, rows are in the order given.  Where a batch's range ends is kept beside the
    checkpoint.  A batch that was stopped, at whatever point, is repeated with the same
    rows, reads the end of the batch before it and so takes the same range again, and
    overwrites its own folder: there are no gaps and no numbers given twice.

    ``then`` is row-wise work on the ordered rows.  ``before_commit`` is called with
    the batch id when a batch has been stored, before the stream takes note of it.
    """
    numbers = f"{checkpoint}/numbers"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = last_number(spark, numbers, batch_id, start)
        # One folder for the ordered rows of all batches, one after the other.
        rows = number_rows(batch, order_by, seq, base, then, stage_path=f"{checkpoint}/ordered")
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        n = spark.read.parquet(f"{out}/batch_id={batch_id}").count()
        spark.createDataFrame([(base + n,)], "last bigint").coalesce(1).write.mode("overwrite").parquet(f"{numbers}/batch_id={batch_id}")
        before_commit(batch_id)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class ProgressLog(StreamingQueryListener):
    """Logs the observed counts of every micro-batch and keeps the totals."""

    def __init__(self, target: int | None = None, name: str = "progress"):
        self.target, self.name, self.rows = target, name, 0

    def onQueryStarted(self, event) -> None:
        log.info("collection started: %s", event.id)

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics.get(self.name)
        if observed:
            self.rows += observed["rows"]
            log.info("collected %s of %s", self.rows, self.target or "all")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("collection ended: %s", event.id)


class ProgressTable(StreamingQueryListener):
    """Stores the observed counts of every micro-batch as a table: batch_id, rows, chars, input_rows, at.

    A batch owns one folder, so that a repeated one is not counted twice.
    Events come a little after the batch they tell of; ``wait`` returns once the query's last one is stored.
    """

    SCHEMA = "rows bigint, chars bigint, input_rows bigint, at string"

    def __init__(self, spark: SparkSession, path: str, name: str = "progress"):
        self.spark, self.path, self.name, self.over = spark, path, name, threading.Event()

    def onQueryStarted(self, event) -> None:
        self.over.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = p.observedMetrics.get(self.name)
        if observed:
            row = (observed["rows"], observed["chars"], p.numInputRows, p.timestamp)
            table = self.spark.createDataFrame([row], self.SCHEMA).coalesce(1)
            table.write.mode("overwrite").parquet(f"{self.path}/batch_id={p.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.over.set()

    def wait(self, seconds: float = 60) -> bool:
        return self.over.wait(seconds)

    def table(self) -> DataFrame:
        return self.spark.read.schema(f"{self.SCHEMA}, batch_id bigint").parquet(self.path)
