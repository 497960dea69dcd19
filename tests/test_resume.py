from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docketframe.operators import corpus, resume


def links(spark, start, end):
    return spark.range(start, end).select(F.concat(F.lit("http://h/"), F.col("id")).alias("link"), F.col("id").alias("n"))


def spoil(path, keep):
    """Make every bucket of stored keys unreadable but some; returns how many there were."""
    folders = [p for p in Path(path, "keys").glob("bucket=*") if int(p.name.split("=")[1]) not in keep]
    for folder in folders:
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"no table")
            (folder / f".{file.name}.crc").unlink(missing_ok=True)
    return len(folders)


def test_equals_the_anti_join(spark, tmp_path):
    path = str(tmp_path / "done")
    done, todo = links(spark, 0, 5000), links(spark, 4500, 9000).unionByName(links(spark, 4990, 5010))
    todo = todo.unionByName(todo.limit(1).withColumn("link", F.lit(None).cast("string")))
    resume.remember(done.where("n < 2000"), "link", path, bucket_keys=100)
    resume.remember(done.where("n >= 1500"), "link", path, bucket_keys=100)
    left = resume.not_remembered(todo, "link", path)
    expected = corpus.not_collected(todo, done)
    assert left.columns == todo.columns
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    assert left.count() == 4000 + 10 + 1


def test_few_keys_are_claimed_in_vain(spark, tmp_path):
    path = str(tmp_path / "done")
    resume.remember(links(spark, 0, 20_000), "link", path, bucket_keys=1000)
    assert resume.claimed(links(spark, 100_000, 120_000), "link", path).count() < 200
    assert resume.claimed(links(spark, 0, 500), "link", path).count() == 500


def test_buckets_without_hits_are_not_read(spark, tmp_path):
    path = str(tmp_path / "done")
    resume.remember(links(spark, 0, 3000), "link", path, bucket_keys=100)
    todo = links(spark, 2999, 3010)
    hit = {r.bucket for r in resume.claimed(todo, "link", path).collect()}
    assert spoil(path, hit) >= 25
    assert sorted(r.n for r in resume.not_remembered(todo, "link", path).collect()) == list(range(3000, 3010))


def test_nothing_stored_and_nothing_to_do(spark, tmp_path):
    path = str(tmp_path / "done")
    assert resume.not_remembered(links(spark, 0, 5), "link", path).count() == 5
    resume.remember(links(spark, 0, 0), "link", path)
    assert resume.not_remembered(links(spark, 0, 5), "link", path).count() == 5
    resume.remember(links(spark, 0, 3), "link", path)
    assert resume.not_remembered(links(spark, 0, 5), "link", path).count() == 2
    assert resume.not_remembered(links(spark, 0, 0), "link", path).count() == 0


def test_a_hot_key_and_numbers_as_keys(spark, tmp_path):
    path = str(tmp_path / "done")
    resume.remember(spark.range(100), "id", path, bucket_keys=10)
    todo = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"))
    expected = todo.join(spark.range(100), "id", "left_anti")
    assert resume.not_remembered(todo, "id", path).count() == expected.count()
    assert resume.not_remembered(todo.withColumn("id", F.col("id").cast("int")), "id", path).count() == expected.count()


def test_a_key_column_called_key(spark, tmp_path):
    done, todo = (links(spark, a, b).withColumnRenamed("link", "key") for a, b in ((0, 5), (3, 8)))
    resume.remember(done, "key", str(tmp_path / "done"))
    assert sorted(r.n for r in resume.not_remembered(todo, "key", str(tmp_path / "done")).collect()) == [5, 6, 7]


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_filters_know_all_their_keys(spark, tmp_path, n):
    path = str(tmp_path / "done")
    resume.remember(links(spark, 0, n), "link", path, bucket_keys=50)
    assert resume.not_remembered(links(spark, 0, n), "link", path).count() == 0
