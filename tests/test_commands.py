from docketframe import schema
from docketframe.__main__ import main
from docketframe.sources import sinks, tables

BODY = "目录\n被告人李某，男，汉族。\n判决如下：\n有期徒刑一年。"


def test_commands(spark, tmp_path, capfd):
    def path(name):
        return str(tmp_path / name)

    lists = spark.createDataFrame(
        [(1, "http://h/l", '<div class="LM_list"><a class="caseName" href="http://h/a">题</a></div>')], schema.PAGE
    )
    details = spark.createDataFrame([(1, "http://h/a", f"<pre>{BODY}</pre>")], schema.PAGE)
    lists.write.parquet(path("lists"))
    details.write.parquet(path("details"))

    main(["collect", path("lists"), path("details"), path("part")])
    assert tables.read_part(spark, path("part")).first().body == BODY

    for _ in range(2):
        main(["ingest-details", path("details"), path("bodies"), path("checkpoint")])
    assert spark.read.parquet(path("bodies")).count() == 1

    main(["post-process", path("out"), path("part"), path("part")])
    assert spark.read.parquet(path("out/review")).count() == 2

    main(["parse", path("part"), path("parsed")])
    assert spark.read.parquet(path("parsed")).first().sentence_months == 12

    main(["preview", path("out/review_csv")])
    main(["verify", path("out/review_csv"), path("out/review_csv")])
    printed = capfd.readouterr().out
    assert "被告人" not in printed.splitlines()[0] and "same_content" in printed


def test_append_mode(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "", "", "", "", BODY)], schema.CASE)
    for _ in range(2):
        sinks.write_cases(df, str(tmp_path / "p"), mode="append", bom=True)
    assert [r.body for r in tables.read_part(spark, str(tmp_path / "p")).collect()] == [BODY, BODY]
