"""What a task, a file or the disk gets does not grow with the table."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docketframe import fixtures, schema
from docketframe.operators import corpus
from docketframe.plans import workflow
from docketframe.sources import sinks, tables


@pytest.fixture
def cases(spark):
    rows = [(i, "t", "", "", "", f"l{i}", "被告人李某，男，汉族。\n有期徒刑一年。") for i in range(40)]
    return spark.createDataFrame(rows, schema.CASE)


@pytest.fixture
def orders_dir(spark, tmp_path):
    """130,000 orders in one row group."""
    spark.range(0, 130_000, 1, 1).selectExpr(
        "id AS o_orderkey", "id % 1000 AS o_custkey", "id / 7.0D AS o_totalprice",
        "timestamp_ntz'2020-01-01 00:00:00' AS o_orderdate",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_post_process_compresses_its_text_outputs(spark, cases, tmp_path):
    plain = workflow.post_process([cases], str(tmp_path / "plain"), compression=None).first()
    assert workflow.post_process([cases], str(tmp_path / "out")).first() == plain
    for name, end in (("cases_csv", "csv"), ("cases_text", "txt"), ("review_csv", "csv")):
        assert [*(tmp_path / "out" / name).rglob(f"part-*.{end}.gz")] and not [*(tmp_path / "out" / name).rglob(f"part-*.{end}")]
        assert [*(tmp_path / "plain" / name).rglob(f"part-*.{end}")]
    back = tables.read_part(spark, str(tmp_path / "out" / "cases_csv")).orderBy("seq")
    assert back.collect() == tables.read_part(spark, str(tmp_path / "plain" / "cases_csv")).orderBy("seq").collect()


def test_no_csv_file_is_more_than_one_task_can_read(spark, tmp_path):
    """A multi-line CSV file is read by one task, whatever wrote it."""
    rows = spark.range(0, 120_000, 1, 1).selectExpr("id AS seq", "concat('a', id) AS title")
    sinks.write_cases(rows, str(tmp_path / "c"), compression="gzip")
    sinks.write_flattened(rows.selectExpr("*", "'b' AS body"), str(tmp_path / "f"))
    for back in (tables.read_part(spark, str(tmp_path / "c")), tables.read_part(spark, str(tmp_path / "f"), schema.REVIEW_CSV)):
        assert back.distinct().count() == 120_000
        sizes = back.groupBy(F.input_file_name()).count().collect()
        assert len(sizes) >= 3 and max(r["count"] for r in sizes) <= sinks.ROWS_PER_FILE


def test_orders_of_one_row_group_are_dealt_to_tasks(spark, orders_dir):
    """Many splits, of which one holds all rows."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.parquet(f"{orders_dir}/orders.parquet").rdd.getNumPartitions() >= 8
        for made in (fixtures.judgments(spark, orders_dir), fixtures.cases(spark, orders_dir)):
            sizes = made.select(F.spark_partition_id().alias("t")).groupBy("t").count().collect()
            assert sum(r["count"] for r in sizes) == 130_000
            assert max(r["count"] for r in sizes) <= fixtures.ORDERS_PER_TASK
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_lines_are_compressed_and_bounded(spark, cases, tmp_path):
    sinks.write_json_records(cases, str(tmp_path / "j"), compression="gzip", rows_per_file=7)
    files = [*(tmp_path / "j").glob("part-*.json.gz")]
    assert len(files) >= 6 and not [*(tmp_path / "j").glob("part-*.json")]
    back = tables.read_json_records(spark, str(tmp_path / "j"), schema.CASE, array_file=False)
    assert sorted(back.collect()) == sorted(cases.collect())


def files_written(spark, name, query, sf_dir, monkeypatch):
    """Names of the files that a query of the entry wrote under ``name``, and how many rows it returned."""
    import __spark_entry__ as entry

    made = []
    monkeypatch.setattr(entry, "new_path", lambda s, n: made.append((n, f"{sf_dir}/written_{len(made)}")) or made[-1][1])
    n = getattr(entry, query)(spark, sf_dir).count()
    return n, sorted(p.name for p in Path(dict(made)[name]).glob("part-*"))


def test_a_stream_to_csv_writes_compressed_files_of_bounded_size(spark, orders_dir, monkeypatch):
    n, files = files_written(spark, "stream_csv", "stream_append_csv", orders_dir, monkeypatch)
    assert n == 130_000 and len(files) >= 3 and all(f.endswith(".csv.gz") for f in files)


@pytest.mark.parametrize("query, name", [("csv_blocks", "csv_file"), ("json_array_records", "json_array")])
def test_large_files_grow_in_number_with_the_rows(spark, orders_dir, monkeypatch, query, name):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "CASES_PER_FILE", 50_000)
    n, files = files_written(spark, name, query, orders_dir, monkeypatch)
    assert n == 130_000 and len(files) == 3


def test_a_preview_computes_dear_columns_of_the_rows_it_shows(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def dear(seq):
        seen.add(1)
        return f"v{seq}"

    some = spark.range(0, 3000, 1, 4).select(F.when(F.col("id") != 7, F.col("id")).alias("seq"))
    rows = some.withColumns({c: F.lit("") for c in ("title", "court", "case_no", "gender", "body")}).withColumn("verdict", dear("seq"))
    shown = corpus.preview(rows).collect()
    assert [(r.seq, r.verdict) for r in shown] == [(None, "vNone..."), (0, "v0..."), (1, "v1...")]
    assert seen.value < 100
    assert corpus.preview(rows.limit(2)).count() == 2


def test_documents_are_one_folder_of_files(spark, tmp_path):
    """A folder for each document took several times as long."""
    rows = [(i, f"text {i}\n\nof two\nlines" if i % 3 else "") for i in range(40)]
    docs = spark.createDataFrame([*rows, (50, None), (51, "a"), (51, "a"), (None, "x"), (None, "y")], "doc_id bigint, text string")
    sinks.write_documents(docs, str(tmp_path / "d"), "doc_id", "text")
    assert len([*(tmp_path / "d").glob("part-*.txt")]) == 44 and not [p for p in (tmp_path / "d").iterdir() if p.is_dir()]
    found = tables.read_documents(spark, str(tmp_path / "d"), keyed=True).select("key", "body").collect()
    wanted = [(str(i), f"{t}\n") for i, t in rows] + [("50", "\n"), ("51", "a\na\n"), (None, "x\n"), (None, "y\n")]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


def test_list_pages_are_made_in_tasks_that_grow_in_number_with_the_orders(spark, orders_dir, monkeypatch):
    monkeypatch.setattr(fixtures, "ORDERS_PER_TASK", 5_000)
    pages = fixtures.list_pages(spark, orders_dir)
    assert pages.rdd.getNumPartitions() == 26 and pages.count() == 26_000
    # What is shuffled is orders, not the items made of them.
    exchange = pages._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression", 1)[1]
    assert "LM_list" not in exchange


def test_a_summary_of_pages_reads_no_field_but_the_title(spark, monkeypatch):
    from docketframe import rules
    from docketframe.functions import html as H
    from docketframe.operators import pages

    asked = []
    real = H.listing
    monkeypatch.setattr(H, "listing", lambda *a, **k: asked.append(k.get("fields")) or real(*a, **k))
    item = '<div class=LM_list><a class=caseName href=x>t{}</a><span class=ah>n</span></div>'
    rows = spark.createDataFrame([(1, item.format(1) + item.format(2)), (2, "")], "p int, html string")
    assert sorted(map(tuple, pages.page_summary(rows).collect())) == [(1, 2, "t1"), (2, 0, "")]
    assert asked == [{"title": rules.LIST_FIELDS["title"]}]
    (page,) = rows.where("p = 1").select(H.listing(F.col("html"), fields=asked[0])["items"].alias("i")).collect()
    assert [(i.title, i.case_no, i.court, i.date) for i in page.i] == [("t1", "", "", ""), ("t2", "", "", "")]


def test_files_of_documents_are_made_and_read_without_a_process_or_a_configuration_each(spark, tmp_path):
    """Hadoop's local writer started a process for each file and each of its checksum file."""
    docs = spark.range(0, 300, 1, 3).selectExpr("IF(id % 7 = 0, NULL, id) AS doc_id", "concat('text ', id, '\n正') AS text")
    for _ in range(2):  # the second time over what the first wrote
        sinks.write_documents(docs, str(tmp_path / "d"), "doc_id", "text")
    files = sorted(p.name for p in tmp_path.rglob("*") if p.is_file())
    assert len([f for f in files if f.startswith("part-")]) == 300 and not [f for f in files if f.endswith(".crc")]
    assert [p.name for p in tmp_path.iterdir()] == ["d"]
    assert sorted((tmp_path / "d").glob("part-*"))[0].read_bytes().endswith("\n正\n".encode())
    found = tables.read_documents(spark, str(tmp_path / "d"), keyed=True)
    assert "FileScan text" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.body for r in found.collect()) == sorted(f"text {i}\n正\n" for i in range(300))
    assert found.where("key IS NULL").count() == 43
    sinks.write_documents(docs.limit(0), str(tmp_path / "none"), "doc_id", "text")
    assert tables.read_documents(spark, str(tmp_path / "none"), keyed=True).count() == 0


@pytest.mark.parametrize("odd", [None, "b c.txt", "x.txt.gz", "sub", "d.csv"])
def test_whole_files_are_those_that_spark_reads(spark, tmp_path, odd):
    import gzip

    tmp_path = tmp_path / "a 正%"
    tmp_path.mkdir()
    for name, text in {"a.txt": b"1\r\n2", "k=1.txt": "正".encode() + b"\xff", "empty.txt": b"", "_SUCCESS": b"", ".a.txt": b"x", "_b.txt": b"x"}.items():
        (tmp_path / name).write_bytes(text)
    if odd == "sub":
        (tmp_path / odd).mkdir()
    elif odd:
        (tmp_path / odd).write_bytes(gzip.compress(b"z") if odd.endswith(".gz") else b"z")
    of = lambda df: sorted(map(tuple, df.selectExpr("path", "hex(body)").collect()))
    theirs = spark.read.text(str(tmp_path), wholetext=True).selectExpr("_metadata.file_path AS path", "value AS body")
    ours = tables.read_documents(spark, f"file://{tmp_path}")
    assert of(ours) == of(theirs) == of(tables.read_documents(spark, str(tmp_path))) and len(of(ours)) == 2 + (odd not in (None, "sub"))
    assert ("FileScan text" in ours._jdf.queryExecution().executedPlan().toString()) == bool(odd)


@pytest.mark.parametrize("query, name", [("csv_blocks", "csv_file"), ("json_array_records", "json_array")])
def test_large_files_read_in_blocks_are_compressed(spark, orders_dir, monkeypatch, query, name):
    """Plain files were some 2 KB a case."""
    from docketframe.sources import blocks, frames

    n, files = files_written(spark, name, query, orders_dir, monkeypatch)
    (folder,) = {p.parent for p in Path(orders_dir).glob("written_*/part-*")}
    assert n == 130_000 and len(files) == 1 and (folder / files[0]).stat().st_size < 200 * n
    with frames.small_splits(spark):
        units = blocks._units(spark, str(folder), blocks.CSV, packed=True)
        assert units.select("block").distinct().count() > 1
