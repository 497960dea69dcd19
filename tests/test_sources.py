import json
import re

import pytest
from pyspark.sql import functions as F

from docketframe import schema
from docketframe.functions.text import body_md5
from docketframe.operators import corpus, records
from docketframe.plans import workflow
from docketframe.sources import sinks, tables

HARD = [
    (1, "题,目", "院", 'a"b', "2024-06-01", "http://h/1", ' 正文 "引" ,\n第二行\\\r\n"" '),
    (2, "", "", "", "", "", ""),
    (3, "　x ", "c", "\\", "d", "l", '"'),
]


@pytest.fixture
def cases(spark):
    return spark.createDataFrame(HARD, schema.CASE)


@pytest.mark.parametrize("bom", [False, True])
def test_csv_round_trip(spark, cases, tmp_path, bom):
    sinks.write_cases(cases, str(tmp_path / "c"), bom=bom)
    back = tables.read_part(spark, str(tmp_path / "c")).orderBy("seq")
    assert [tuple(r) for r in back.collect()] == HARD
    head = next((tmp_path / "c").glob("*.csv")).read_bytes()
    assert head.startswith(b"\xef\xbb\xbf") == bom
    assert ",".join(schema.CASE_HEADERS) in head.decode("utf-8-sig").splitlines()[0]


def test_csv_as_other_programs_write_it(spark, tmp_path):
    text = '﻿' + ",".join(schema.CASE_HEADERS) + '\r\n1,t,c,n,d,l,"a ""b""\nc"\r\n2,t,c,n,d,l,\r\n'
    (tmp_path / "p.csv").write_bytes(text.encode())
    rows = tables.read_part(spark, str(tmp_path / "p.csv")).orderBy("seq").collect()
    assert [(r.seq, r.title, r.body) for r in rows] == [(1, "t", 'a "b"\nc'), (2, "t", "")]


def test_appending_grows_a_part(spark, cases, tmp_path):
    sinks.write_cases(cases, str(tmp_path / "c"))
    sinks.write_cases(cases, str(tmp_path / "c"), mode="append")
    assert tables.read_part(spark, str(tmp_path / "c")).count() == 6


def test_ingest_parts(spark, cases, tmp_path):
    sinks.write_cases(cases, str(tmp_path / "a"))
    sinks.write_cases(cases.limit(1), str(tmp_path / "b"))
    table = tables.ingest_parts(spark, [str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path / "t"))
    counts = {r.part_no: r["count"] for r in table.groupBy("part_no").count().collect()}
    assert counts == {1: 3, 2: 1}


def test_json(spark, cases, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"title": "甲"}, {"title": "乙"}], ensure_ascii=False))
    rows = tables.read_json_records(spark, str(tmp_path / "a.json")).collect()
    assert [r.title for r in rows] == ["甲", "乙"]
    assert tables.read_json_records(spark, str(tmp_path / "none.json")) is None
    (tmp_path / "bad.json").write_text("{[")
    assert tables.read_json_records(spark, str(tmp_path / "bad.json")) is None
    bad = tables.read_json_records(spark, str(tmp_path / "bad.json"), schema.DETAIL)
    assert bad.where("title is not null").count() == 0
    sinks.write_json_records(cases, str(tmp_path / "j"))
    back = tables.read_json_records(spark, str(tmp_path / "j"), schema.CASE, array_file=False)
    assert [tuple(r) for r in back.orderBy("seq").collect()] == HARD


def test_whole_documents(spark, tmp_path):
    (tmp_path / "d.txt").write_text("一\n二\n")
    row = tables.read_documents(spark, str(tmp_path)).first()
    assert row.body == "一\n二\n" and row.path.endswith("d.txt")


def test_page_store_and_pages(spark, tmp_path):
    details = spark.createDataFrame([("a/b", 1, "<p>"), ("", 2, "<i>")], "case_no string, index int, html_content string")
    sinks.write_page_store(details, str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p")).orderBy("file_key").collect()
    assert [tuple(r) for r in rows] == [("a_b", "<p>"), ("case_2", "<i>")]


def test_text_report(spark, cases, tmp_path):
    sinks.write_text_report(cases.limit(2), str(tmp_path / "r"))
    text = "".join(p.read_bytes().decode() for p in sorted((tmp_path / "r").glob("part-*.txt")))
    rule = "\n" + "=" * 60 + "\n\n"
    assert text == (
        "【案件 1】题,目\n法院：院\n案号：a\"b\n日期：2024-06-01\n\n" + HARD[0][-1] + "\n" + rule
        + "【案件 2】\n法院：\n案号：\n日期：\n\n\n" + rule
    )


def test_text_report_in_the_order_of_a_numbered_table(spark, tmp_path):
    rows = spark.range(3000).selectExpr("(id * 7) % 3000 AS k", "'t' AS title", "'' AS court", "'' AS case_no", "'' AS date", "repeat('b', 50) AS body")
    numbered = corpus.number_rows(rows, ["k"], place="_place")
    sinks.write_text_report(numbered, str(tmp_path / "r"), place="_place")
    files = sorted((tmp_path / "r").glob("*/part-*.txt"))
    text = "".join(p.read_text() for p in files)
    assert len(files) > 1
    assert [int(n) for n in re.findall("【案件 ([0-9]+)】", text)] == list(range(1, 3001))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_review_table_fills_missing_columns(spark, cases):
    table = records.export_table(cases)
    assert table.columns == schema.REVIEW_HEADERS
    assert table.where(F.col("序号") == "1").first()["性别"] == ""


def test_post_process_and_verify(spark, tmp_path):
    body = "目录\n被告人李某，男，汉族。\n判决如下：\n有期徒刑一年。"
    parts = [
        spark.createDataFrame([(9, "a", "", "", "", "l1", body), (10, "b", "", "", "", "l2", "")], schema.CASE),
        spark.createDataFrame([(1, "c", "", "", "", "l3", body)], schema.CASE),
    ]
    out = str(tmp_path / "out")
    stats = workflow.post_process(parts, out).first()
    assert (stats.total_rows, stats.cleaned_rows, stats.empty_rows) == (3, 2, 1)
    back = tables.read_part(spark, f"{out}/cases_csv").orderBy("seq").collect()
    assert [(r.seq, r.title) for r in back] == [(1, "a"), (2, "b"), (3, "c")]
    review = spark.read.parquet(f"{out}/review")
    rows = {r["序号"]: r for r in review.collect()}
    assert rows["1"]["性别"] == "男" and rows["3"]["判决结果"] == "有期徒刑一年。" and rows["2"]["性别"] == ""
    flat = tables.read_part(spark, f"{out}/review_csv", schema.REVIEW_CSV)
    assert flat.where("seq = 1").first().body == "被告人李某，男，汉族。 判决如下： 有期徒刑一年。"
    again = workflow.verify_written(flat, tables.read_part(spark, f"{out}/review_csv", schema.REVIEW_CSV))
    assert again.first().same_content == 1


def test_md5_of_null(apply):
    assert apply(body_md5, [None]) == [None]


def test_columns_go_by_header(spark, tmp_path):
    from docketframe import schema
    from docketframe.sources import tables

    header = ["标题", "序号", "正文", "别的"]
    (tmp_path / "a.csv").write_text("﻿" + ",".join(header) + '\nT,7,"one\ntwo",x\n', encoding="utf-8")
    row = tables.read_part(spark, str(tmp_path / "a.csv")).first()
    assert (row["seq"], row["title"], row["body"], row["link"]) == (7, "T", "one\ntwo", "")
    (tmp_path / "b.csv").write_text(",".join(schema.REVIEW_CSV.names) + "\n1,t,c,n,d,男,V,http://l,B\n", encoding="utf-8")
    row = tables.read_part(spark, str(tmp_path / "b.csv")).first()
    assert (row["link"], row["body"]) == ("http://l", "B")
