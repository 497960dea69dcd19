import pytest
from pyspark.sql import functions as F

from docketframe.operators import corpus


def test_numbers_run_over_parts_in_order(spark):
    parts = [spark.range(a, b).select(F.col("id").alias("seq"), F.concat(F.lit("正文正文"), "id").alias("body"))
             for a, b in [(5, 105), (0, 50), (7, 8)]]
    rows = corpus.merge_and_clean(*parts).orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(1, 152))
    expected = [(1, i) for i in range(5, 105)] + [(2, i) for i in range(50)] + [(3, 7)]
    assert [(r.part_no, r.body) for r in rows] == [(p, f"正文正文{i}") for p, i in expected]


def test_numbering_survives_a_hot_key_and_copies(spark):
    # A third of the rows share one key and are copies of each other.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"), F.lit("x").alias("body")
    )
    numbered = corpus.number_rows(df.repartition(8), ["key"])
    rows = numbered.orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(1, 3001))
    assert [r.key for r in rows] == sorted(r.key for r in rows)


def test_hot_key_is_cut_into_several_tasks(spark):
    df = spark.range(4000).select(F.lit(1).alias("key"), F.lit("copy").alias("body"))
    stage = f"{spark.conf.get('spark.checkpoint.dir')}/hot"
    # Only the small size of the fixture would make AQE put all into one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        corpus.number_rows(df, ["key"], stage_path=stage)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(stage).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 4 and max(r["count"] for r in files) < 2000


def test_numbering_goes_on(spark):
    done, fresh = spark.range(1, 326).toDF("seq"), spark.range(10).toDF("id")
    assert sorted(r.seq for r in corpus.continue_numbers(done, fresh, ["id"]).collect()) == list(range(326, 336))
    assert corpus.continue_numbers(done.where("false"), fresh, ["id"]).agg(F.min("seq")).first()[0] == 1


def test_slices_caps_and_chunks(spark):
    df = spark.range(1, 13).select(F.col("id").alias("seq"), (F.col("id") * 10).alias("v"))
    assert [r.seq for r in corpus.numbered_slice(df, 3, 4).orderBy("seq").collect()] == [4, 5, 6, 7]
    assert [r.seq for r in corpus.first_rows(df, "seq", 2).collect()] == [1, 2]
    chunks = {r.chunk_id: r.items for r in corpus.chunked(df, 5, "v").collect()}
    assert chunks == {0: [10, 20, 30, 40, 50], 1: [60, 70, 80, 90, 100], 2: [110, 120]}


def test_counts(spark):
    df = spark.createDataFrame([("目录\n甲甲甲",), ("甲甲甲",), ("",), (None,)], "body string")
    got = corpus.corpus_stats(corpus.with_clean_body(df)).first().asDict()
    assert got == {"total_rows": 4, "cleaned_rows": 1, "total_chars": 6, "empty_rows": 2,
                   "valid_rows": 2, "mean_chars": 1}
    empty = corpus.corpus_stats(corpus.with_clean_body(df.where("false"))).first().asDict()
    assert empty["mean_chars"] is None and empty["total_chars"] == 0
    assert corpus.success_counts(df).first().asDict() == {"n_ok": 3, "n_total": 4}
    assert corpus.collected(df, 4).first().reached == 1
    parts = corpus.merge_parts(df, df.limit(1))
    assert {r.part_no: r.n_rows for r in corpus.part_counts(parts).collect()} == {1: 4, 2: 1, None: 5}


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "i int, t string")
    same = corpus.reconcile(a, a.orderBy(F.desc("i"))).first()
    assert (same.difference, same.same_content) == (0, 1)
    other = corpus.reconcile(a, a.withColumn("t", F.lit("x"))).first()
    assert (other.difference, other.same_content) == (0, 0)
    fewer = corpus.reconcile(a, a.limit(1)).first()
    assert (fewer.source_rows, fewer.written_rows, fewer.difference) == (2, 1, 1)


def test_not_collected_keeps_copies_and_splits_skew(spark):
    todo = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("link"), "id")
    done = spark.range(3000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("link"))
    got = corpus.not_collected(todo, done)
    seen = {1 if i % 2 == 0 else i for i in range(3000)}
    links = [0 if i % 3 == 0 else i for i in range(3000)]
    assert got.count() == sum(link not in seen for link in links)
    # The join shuffles both sides itself: nothing but a sort may lie between.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = corpus.not_collected(todo, done)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ENSURE_REQUIREMENTS") >= 3 and "SortMergeJoin" in plan


def test_matching(spark):
    df = spark.createDataFrame([("故意伤害", "2021-01-01"), ("故意伤害", ""), ("盗窃", "2021-01-01")], "body string, date string")
    assert corpus.matching(df).count() == 2
    assert corpus.matching(df, years=(2020, 2025)).count() == 1


def test_preview(spark):
    row = (1, "题" * 60, "院", "号", "", "判" * 70, "正文")
    df = spark.createDataFrame([row], "seq int, title string, court string, case_no string, gender string, verdict string, body string")
    got = corpus.preview(df).first()
    assert (got.title, got.gender, got.verdict, got.body_chars) == ("题" * 50 + "...", "(空)", "判" * 60 + "...", 2)


KEYS = "a int, b string, c timestamp, v string"


@pytest.mark.parametrize("n, partitions", [(0, 4), (1, 4), (3000, 4), (3000, 37), (20_000, 300)])
def test_numbers_of_mixed_keys_with_nulls_and_ties(spark, n, partitions, monkeypatch):
    monkeypatch.setattr(corpus, "RANGE_ROWS", 50)
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 5 = 0 THEN NULL ELSE cast(id * 7919 % 11 - 5 AS int) END AS a",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE concat('é', id * 31 % 17, '`\\'') END AS b",
        "timestamp_seconds(id * 101 % 13) AS c", "cast(id AS string) AS v",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        numbered = corpus.number_rows(df.repartition(5), ["a", "b", "c"], place="_place")
        rows = numbered.orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.seq for r in rows] == list(range(1, n + 1)) and len({r.v for r in rows}) == n
    keys = [(r.a is not None, r.a or 0, r.b is not None, r.b or "", r.c) for r in rows]
    assert keys == sorted(keys) and [r._place for r in rows] == sorted(r._place for r in rows)


def test_numbering_reads_wide_rows_once(spark, tmp_path):
    spark.range(2000).selectExpr("id AS k", "repeat('x', 100) AS body").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(body):
        seen.add(1)
        return body

    # What the rows hold beside the keys is worked out once a row, not for the bounds too.
    wide = table.withColumn("body", counted("body"))
    assert corpus.number_rows(wide, ["k"]).count() == 2000
    assert seen.value == 2000


def test_ranges_are_of_one_size(spark, tmp_path):
    skewed = spark.range(40_000).selectExpr("CASE WHEN id % 2 = 0 THEN 1 ELSE id * id END AS k")
    corpus.number_rows(skewed, ["k"], stage_path=str(tmp_path / "s"))
    files = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 4 and max(r["count"] for r in files) < 12_500
