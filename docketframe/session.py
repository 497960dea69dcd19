"""Session settings and the shared folder for tables written between stages."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# Suited to rows that carry whole documents and pages.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python line of every Column call doubles the time it takes
    # to build the larger rule expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A row may be megabytes: bound Arrow batches by bytes.
    BATCH_SETTING: "8m",
}


def local_session(cores: int | str = "*", name: str = "docketframe", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package wherever the driver found it; once per application.

    Bounds the session's Arrow batches as ``SETTINGS`` does, since ``SETTINGS`` do not reach
    a session that the caller made, whose default suits narrow rows.
    """
    sc = spark.sparkContext
    spark.conf.set(BATCH_SETTING, SETTINGS[BATCH_SETTING])
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="docketframe-")) / package.name
        sc.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares, as the session names it.

    Only a one-machine session may do without: it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="docketframe-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def local_path(spark: SparkSession, path: str) -> str | None:
    """A path as plain file functions take it; None if it does not lie on a file system of the machine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder, if there is one."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/docketframe/{uuid.uuid4().hex}/{name}"


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a table once and go on from what was written.

    Cuts the lineage, so nothing above is computed again when several readers
    follow or executors are lost; later reads prune columns.  The folder is
    the caller's to remove (:func:`discard`).
    """
    spark = df.sparkSession
    path = path or new_path(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


#: Bytes that a table may have to be broadcast.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table with a broadcast hint if its rows, of at most ``row_bytes`` each, are few enough; else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def discard(df: DataFrame) -> None:
    """Remove what :func:`staged` stored of a table that nothing reads any more."""
    path = getattr(df, "staged_at", None)
    if path:
        remove(df.sparkSession, path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly row-wise work on a small scan.

    A few small files come as fewer splits than there are cores.  Such input,
    and only such, is dealt out round-robin; larger scans are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def portions(df: DataFrame, rows: int) -> int:
    """How many portions of about ``rows`` rows a table makes, one at least; for Parquet, counted in its footers."""
    return max(1, -(-df.count() // rows))


def dealt(df: DataFrame, rows_per_task: int) -> DataFrame:
    """Narrow rows from which much is made, dealt out so that no task gets many more than ``rows_per_task``.

    The splits of a scan say little about that: a file of a few large row groups has many
    splits, most of them empty.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, portions(df, rows_per_task)))
