import random

import pytest
from pyspark.sql import functions as F

from docketframe.operators import reconcile

SCHEMA = "k string, a string, b bigint"


def expected(source, written):
    out = []
    for k in {r[0] for r in source + written}:
        one, two = (sorted([r for r in side if r[0] == k], key=repr) for side in (source, written))
        if one == two:
            continue
        if not two or not one:
            out.append((k, "extra" if two else "missing", ""))
        elif len(one) != len(two):
            out.append((k, "copies", ""))
        else:
            names = [c for i, c in ((1, "a"), (2, "b")) if sorted([r[i] for r in one], key=repr) != sorted([r[i] for r in two], key=repr)]
            out.append((k, "changed", ",".join(names)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("few_rows, level_bits", [(1_000_000, 8), (0, 8), (5, 2), (0, 1)])
def test_differences_of_random_tables(spark, few_rows, level_bits):
    rng = random.Random(few_rows + level_bits)
    source = [(rng.choice([None, "", "k", f"k{i}"]) if i % 50 == 0 else f"k{i}", f"a{i}", i) for i in range(400)]
    written = [r for r in source if rng.random() > 0.02]
    for i in range(0, len(written), 37):
        k, a, b = written[i]
        written[i] = rng.choice([(k, None, b), (k, a, b + 1), (k, "", None), (k + "x" if k else "n", a, b)])
    written += written[:5] + [("new", "a", 1)]
    rng.shuffle(written)
    one, two = (spark.createDataFrame(side, SCHEMA) for side in (source, written))
    got = reconcile.row_differences(one, two.select("b", "a", "k"), ["k"], few_rows, level_bits)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(source, written)


def test_equal_tables_have_no_differing_buckets(spark):
    df = spark.range(5000).selectExpr("cast(id AS string) AS k", "cast(id % 7 AS string) AS a", "id AS b")
    buckets, bits = reconcile.differing_buckets(df, df.orderBy(F.desc("b")), ["k"])
    assert buckets.count() == 0 and bits == reconcile.LEVEL_BITS
    assert reconcile.row_differences(df, df, ["k"]).count() == 0
    assert reconcile.row_differences(df.limit(0), df.limit(0), ["k"]).count() == 0


def test_only_buckets_that_differ_are_looked_into(spark):
    df = spark.range(200_000).selectExpr("cast(id AS string) AS k", "'x' AS a", "id AS b")
    changed = df.withColumn("a", F.when(F.col("b") % 50_000 == 7, "y").otherwise("x"))
    buckets, bits = reconcile.differing_buckets(df, changed, ["k"], few_rows=100)
    assert bits == 16 and buckets.count() == 4
    # Of 400,000 rows on both sides, those that are shuffled by key:
    assert buckets.agg(F.sum("_rows")).first()[0] < 100
    got = reconcile.row_differences(df, changed, ["k"], few_rows=100).collect()
    assert sorted(map(tuple, got)) == sorted((str(i), "changed", "a") for i in range(7, 200_000, 50_000))


def test_tables_that_differ_all_over_are_not_descended_into(spark):
    df = spark.range(3000).selectExpr("cast(id AS string) AS k", "'x' AS a", "id AS b")
    buckets, bits = reconcile.differing_buckets(df, df.withColumn("a", F.lit("z")), ["k"], few_rows=10)
    assert bits == 16
    assert reconcile.row_differences(df, df.withColumn("a", F.lit("z")), ["k"], few_rows=10).count() == 3000


def test_types_follow_the_source_and_the_key_may_be_several_columns(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "2", 2)], SCHEMA)
    text = df.selectExpr("k", "a", "cast(b AS string) AS b")
    assert reconcile.row_differences(df, text, ["k", "a"]).count() == 0
    got = reconcile.row_differences(df, text.where("a = '1'"), ["k", "a"]).collect()
    assert [tuple(r) for r in got] == [("a", "2", "missing", "")]
