"""Labelled rows to learn from, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """text and label of at most ``max_rows`` labelled rows outside the held-out fold.

    Which rows those are follows from a hash of doc_id, so any bound takes an even share of the table.
    """
    picked = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # At most max_rows rows of two numbers.
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label")
