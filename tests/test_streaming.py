import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from docketframe.functions import clean
from docketframe.operators import records
from docketframe.streaming import ingest

SCHEMA = "id bigint, body string"


def add_file(spark, path, a, b):
    body = F.concat(F.lit("目录\n被告人李某，男，"), F.col("id").cast("string"))
    spark.range(a, b).select("id", body.alias("body")).coalesce(1).write.mode("append").parquet(path)


def cleaned(df):
    df = df.select("id", clean.clean_content(F.col("body")).alias("body"))
    return records.parse_records(df)


def test_stream_resumes_and_equals_batch(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for start in (0, 10, 20):
        add_file(spark, src, start, start + 10)
        add_file(spark, src, start + 100, start + 110)
        stream = ingest.file_stream(spark, src, schema, files_per_batch=1)
        ingest.append(stream, out, cp, cleaned).awaitTermination()
    # Started again with nothing new, it adds nothing.
    ingest.append(ingest.file_stream(spark, src, schema), out, cp, cleaned).awaitTermination()
    stored, batch = spark.read.parquet(out), cleaned(spark.read.parquet(src))
    assert stored.count() == 60
    assert stored.exceptAll(batch).count() == batch.exceptAll(stored).count() == 0


def test_batches_are_idempotent(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    add_file(spark, src, 0, 10)
    schema = spark.createDataFrame([], SCHEMA).schema
    # A lost checkpoint makes every batch run again, into the same folder.
    for checkpoint in ("cp1", "cp2"):
        stream = ingest.file_stream(spark, src, schema)
        ingest.append_batches(stream, out, str(tmp_path / checkpoint), cleaned).awaitTermination()
    assert spark.read.parquet(out).count() == 10


def test_stopped_in_mid_batch(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    for i in range(3):
        add_file(spark, src, i * 10, i * 10 + 10)
    schema = spark.createDataFrame([], SCHEMA).schema
    flag = str(tmp_path / "fail")
    open(flag, "w").close()

    @F.udf("string")
    def fragile(x):
        import os

        if os.path.exists(flag) and x.endswith("，25"):
            raise RuntimeError("stopped")
        return x

    def step(df):
        return df.select("id", fragile("body").alias("body"))

    stream = ingest.file_stream(spark, src, schema, files_per_batch=1)
    query = ingest.append(stream, out, cp, step)
    try:
        query.awaitTermination()
        failed = False
    except Exception:
        failed = True
    assert failed
    import os

    os.remove(flag)
    ingest.append(ingest.file_stream(spark, src, schema, files_per_batch=1), out, cp, step).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(30))


def test_progress(spark, tmp_path):
    src = str(tmp_path / "src")
    add_file(spark, src, 0, 10)
    listener = ingest.ProgressLog(target=10)
    spark.streams.addListener(listener)
    try:
        stream = ingest.file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
        query = ingest.append(stream, str(tmp_path / "o"), str(tmp_path / "cp"), ingest.with_progress)
        query.awaitTermination()
        observed = [p.observedMetrics["progress"] for p in query.recentProgress if p.observedMetrics]
        assert sum(o["rows"] for o in observed) == 10
        import time

        for _ in range(50):
            if listener.rows == 10:
                break
            time.sleep(0.1)
        assert listener.rows == 10
    finally:
        spark.streams.removeListener(listener)


def numbered_rows(spark, out):
    return sorted((r.seq, r.batch_id, r.id) for r in spark.read.parquet(out).collect())


@pytest.mark.parametrize("point", ["stored", "numbered"])
def test_numbers_go_on_from_batch_to_batch(spark, tmp_path, point):
    """The second of three batches is stopped: in its work, or when all of it has been stored."""
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    schema = spark.createDataFrame([], SCHEMA).schema
    flag = tmp_path / "fail"
    flag.write_text(str(tmp_path))

    def fail(batch_id):
        if batch_id == 1 and point == "numbered" and flag.exists():
            raise RuntimeError("stopped")

    def then(df):
        broken = F.raise_error(F.lit("stopped")).cast("string")
        stop = point == "stored" and flag.exists()
        return df.withColumn("body", F.when(F.lit(stop) & (F.col("id") == 15), broken).otherwise(F.col("body")))

    def run():
        stream = ingest.file_stream(spark, src, schema, files_per_batch=1)
        ingest.append_numbered(stream, out, cp, ["id"], start=100, then=then, before_commit=fail).awaitTermination()

    for i in (20, 10, 0):  # later batches hold smaller ids
        add_file(spark, src, i, i + 10)
        time.sleep(1.1)  # files are taken by age
    with pytest.raises(StreamingQueryException):
        run()
    flag.unlink()
    run()
    run()
    expected = [(101 + k, b, i) for k, (b, i) in enumerate((b, i) for b, s in enumerate((20, 10, 0)) for i in range(s, s + 10))]
    assert numbered_rows(spark, out) == expected
    assert ingest.last_number(spark, f"{cp}/numbers", 3) == 130 and ingest.last_number(spark, f"{cp}/numbers", 0, 7) == 7


def test_a_lost_checkpoint_numbers_anew(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    add_file(spark, src, 0, 10)
    schema = spark.createDataFrame([], SCHEMA).schema
    for cp in ("cp1", "cp2"):
        ingest.append_numbered(ingest.file_stream(spark, src, schema), out, str(tmp_path / cp), ["id"]).awaitTermination()
    assert [r[0] for r in numbered_rows(spark, out)] == list(range(1, 11))


def test_progress_as_a_table(spark, tmp_path):
    src, out, cp, path = (str(tmp_path / n) for n in ("src", "out", "cp", "progress"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for i in range(3):
        add_file(spark, src, i * 10, i * 10 + 10 + i)
    events = ingest.ProgressTable(spark, path)
    spark.streams.addListener(events)
    try:
        stream = ingest.file_stream(spark, src, schema, files_per_batch=1)
        ingest.append(stream, out, cp, ingest.with_progress).awaitTermination()
        assert events.wait()
    finally:
        spark.streams.removeListener(events)
    rows = events.table().orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == [0, 1, 2] and sorted(r.rows for r in rows) == [10, 11, 12]
    assert sum(r.chars for r in rows) == spark.read.parquet(src).selectExpr("sum(length(body))").first()[0]
