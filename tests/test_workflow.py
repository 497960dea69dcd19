import pytest

from docketframe.plans import workflow


def list_page(*links):
    items = "".join(
        f'<div class="LM_list"><a class="caseName" href="{link}">题{link}</a></div>' for link in links
    )
    return f"<body>{items}</body>"


@pytest.mark.parametrize("target, unique", [(None, False), (5, False), (200_000, False), (3, True)])
def test_collect(spark, target, unique):
    lists = spark.createDataFrame(
        [(1, list_page("http://h/a", "http://h/b")), (2, list_page("http://h/a", "http://h/none", "http://h/c"))],
        "page_id bigint, html string",
    )
    details = [(1, "http://h/a", "first"), (3, "http://h/b", "b"), (4, "http://h/c", "c"), (5, "http://h/z", "z")]
    if not unique:
        details.append((2, "http://h/a", "second"))
    pages = spark.createDataFrame(details, "page_id bigint, url string, html string")
    rows = workflow.collect(lists, pages, target=target, one_snapshot_per_url=unique).orderBy("seq").collect()
    expected = [(1, "first"), (2, "b"), (3, "first"), (4, ""), (5, "c")]
    assert [(r.seq, r.body) for r in rows] == expected[: target or 5]
    assert rows[0].title == "题http://h/a"


def test_a_hot_link_is_split(spark, tmp_path):
    """A third of all records share one link: AQE has to split that partition."""
    from pyspark.sql import functions as F

    from docketframe.operators import pages

    hot = F.when(F.col("id") % 3 == 0, "u0").otherwise(F.concat(F.lit("u"), F.col("id")))
    records = spark.range(60_000).select(
        "id",
        hot.alias("link"),
        F.concat(*[F.md5((F.col("id") * 7 + i).cast("string")) for i in range(4)]).alias("title"),
    )
    bodies = spark.range(60_000).select(
        F.concat(F.lit("u"), F.col("id")).alias("url"), F.md5(F.col("id").cast("string")).alias("body")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        pages.attach_bodies(records, bodies).write.parquet(str(tmp_path / "joined"))
        joined = spark.read.parquet(str(tmp_path / "joined"))
        assert joined.where("body <> ''").count() == 60_000
        # All its rows in one task would be 20,000 in one file.
        hot_rows = joined.where("link = 'u0'").groupBy(F.input_file_name()).count().collect()
        assert sum(r["count"] for r in hot_rows) == 20_000 and max(r["count"] for r in hot_rows) < 10_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
