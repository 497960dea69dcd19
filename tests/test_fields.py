import pytest
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.functions import fields
from docketframe.operators import records

SAMPLE = """某某市人民法院
刑事判决书
（2024）示例刑初001号

公诉机关某某市人民检察院。
被告人李某，男，1990年1月1日出生。

经审理查明，被告人李某因琐事与他人发生争执，造成被害人轻伤二级。
本院认为，被告人李某故意伤害他人身体，其行为已构成故意伤害罪。

判决如下：
一、被告人李某犯故意伤害罪，判处有期徒刑一年六个月。
二、赔偿被害人经济损失人民币12000元。

审判员 张某
二〇二四年六月一日
"""


def parse(spark, **row):
    row = {"case_no": None, "court": None, "date": None, "body": None} | row
    df = spark.createDataFrame([row], "case_no string, court string, date string, body string")
    return records.parse_records(df)


def test_sample_judgment(spark):
    got = parse(spark, body=SAMPLE).first().asDict()
    del got["body"]
    assert got == {
        "case_no": "（2024）示例刑初001号",
        "court": "某某市人民法院",
        "date": "1990-01-01",  # the signing date is in Han digits, which no rule reads
        "case_reason": "故意伤害罪",
        "defendant_gender": "男",
        "injury_level": "轻伤二级",
        "compensation": "12000.00元",
        "sentence": "1年6个月",
        "verdict": "一、被告人李某犯故意伤害罪，判处有期徒刑一年六个月。 二、赔偿被害人经济损失人民币12000元。",
        "trial_procedure": "一审",
    }


@pytest.mark.parametrize("empty", [None, ""])
def test_no_text_leaves_the_record_alone(spark, empty):
    got = parse(spark, body=empty, case_no="x").first().asDict()
    assert got["case_no"] == "x" and got["body"] == empty and got["court"] is None
    assert all(got[c] is None for c in got if c not in ("case_no", "body"))


def test_given_values_are_kept(spark):
    got = parse(spark, body=SAMPLE, case_no="given", court="", date="d").first()
    assert (got.case_no, got.court, got.date) == ("given", "某某市人民法院", "d")


def test_missing_columns_are_added(spark):
    df = spark.createDataFrame([(SAMPLE,)], "body string")
    assert records.parse_records(df).first().case_no == "（2024）示例刑初001号"


def test_parsing_shuffles_nothing(spark):
    plan = parse(spark, body=SAMPLE)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


AMOUNTS = {
    "判令被告人赔偿被害人经济损失人民币12000元。": "12000.00元",
    "赔偿人民币12,000元": "0.00元",
    "赔偿医疗费5000元、误工费3000元": "5000.00元",
    "于5月3日在本市某区某路某号门前因琐事发生争执并互殴，赔偿5万元": "5.00元",
    "赔偿5万元": "50000.00元",
    "赔偿１２．５万元": "50000.00元",
    "赔偿2.675元": "2.67元",
    "支付800元": "",
    "给付人民币 800.5 万元": "8005000.00元",
    "赔偿损失": "",
}
TERMS = {
    "判处有期徒刑一年，缓刑二年。": "1年",
    "判处有期徒刑三年缓刑四年。": "3年（缓刑4年）",
    "判处有期徒刑六个月缓刑一年。": "1年6个月（缓刑1年）",
    "处三年以下有期徒刑、拘役三个月，并": "3个月",
    "判处有期徒刑两年。": "",
    "判处无期徒刑。": "",
    "判处拘役五个月。": "拘役5个月",
    "判处拘役0个月。": "拘役0个月",
    "免予刑事处罚。": "免予刑事处罚",
    "判处有期徒刑二十五年": "25年",
    "判处有期徒刑十五年二个月\n": "15年2个月",
    "判处有期徒刑零年。免予刑事处罚": "免予刑事处罚",
}
DATES = {
    "2024年6月1日，2023-1-1": "2024-06-01",
    "2024-6-1和2025-12-31": "2025-12-31",
    "2024/6/1": "2024-06-01",
    "2024年13月45日": "2024-13-45",
    "12024年1月1日": "2024-01-01",
    "２０２４年６月１日": "２０２４-0６-0１",
    "2020年1月1日" + "字" * 1000: "",
    "二〇二四年六月一日": "",
}
COURTS = {
    "某某市人民法院": "某某市人民法院",
    "甲 丙市中级法院": "丙市中级法院",
    "字" * 497 + "，乙市人民法院": "",
    "由某某市人民法院与人民法院": "由某某市人民法院与人民法院",
    "法院": "",
}
GENDERS = {
    "被告人李某，女，": "女",
    "被告人李某\u3000男 ": "男",
    "被告：李某、女、": "女",
    "被告人李某男。": "",
    "字" * 2000 + "被告人李某，女，": "",
}
INJURIES = {"重伤Ⅱ级": "重伤二级", "轻伤一级又重伤": "重伤", "轻伤Ⅰ级": "轻伤一级", "轻微伤": "轻微伤", "无": ""}
PROCEDURES = {
    "提出上诉": "二审", "字" * 1000 + "上诉": "一审", "申诉": "再审", "再审后发回重审": "二审", "": "一审",
}
CASE_NOS = {"(2024)例刑终5号": "(2024)例刑终5号", "（２０２４）样5号": "（２０２４）样5号", "（24）样5号": "", "（2024）样 5号": ""}
VERDICTS = {
    "本院认为：甲\n 乙。审判": "甲 乙。",
    "判决如下:" + " " * 499 + "甲乙": "甲...",
    "判决如下：甲书记员": "甲",
    "本院认为，甲": "",
}


@pytest.mark.parametrize(
    "rule, table",
    [
        (fields.compensation, AMOUNTS), (fields.sentence, TERMS), (fields.decision_date, DATES),
        (fields.court, COURTS), (fields.gender, GENDERS), (fields.injury_level, INJURIES),
        (fields.trial_procedure, PROCEDURES), (fields.case_no, CASE_NOS), (fields.verdict, VERDICTS),
    ],
    ids=lambda x: getattr(x, "__name__", ""),
)
def test_rule(apply, rule, table):
    assert apply(rule, list(table)) == list(table.values())


def test_typed_companions(spark):
    body = "判处有期徒刑一年六个月缓刑二年。赔偿12.5万元。2024年6月1日"
    typed = records.with_typed_fields(parse(spark, body=body)).first()
    assert (str(typed.decision_date), str(typed.compensation_amount)) == ("2024-06-01", "125000.00")
    # The year rule reads the first year of the clause; both are years here.
    assert (typed.sentence_months, typed.probation_years) == (18, 2)
    none = records.with_typed_fields(parse(spark, body="无")).first()
    assert (none.decision_date, none.sentence_months, none.compensation_amount) == (None, None, None)


def test_huge_values_do_not_fail(apply):
    digits = "9" * 400
    assert apply(fields.sentence, [f"有期徒刑{digits}年。"]) == [f"{digits}年"]
    assert apply(fields.compensation, [f"赔偿{digits}元"])[0].endswith("元")


def test_too_large_terms_do_not_stop_a_job(spark):
    from docketframe.operators import records

    rows = [("300000000年", "", ""), ("99999999999年", "", ""), ("1年6个月", "", "")]
    df = spark.createDataFrame(rows, "sentence string, date string, compensation string")
    assert [r["sentence_months"] for r in records.with_typed_fields(df).collect()][2] == 18


def test_windows_and_rule_lists_are_arguments(apply):
    text = "2020年1月2日" + "甲" * 3000 + "乙法院。被告人丙，男，上诉"
    assert apply(fields.court, [text]) == [""] and apply(lambda c: fields.court(c, window=None), [text])[0].endswith("乙法院")
    assert apply(fields.decision_date, [text]) == [""]
    assert apply(lambda c: fields.decision_date(c, window=None), [text]) == ["2020-01-02"]
    assert apply(lambda c: fields.gender(c, window=None), [text]) == ["男"]
    assert apply(lambda c: fields.trial_procedure(c, window=None), [text]) == ["二审"]
    assert apply(lambda c: fields.trial_procedure(c, [("x", ["甲"])], "y"), [text, "丁"]) == ["x", "y"]
    assert apply(lambda c: fields.injury_level(c, [("x", ["甲"])]), [text]) == ["x"]
    long = "判决如下：" + "一" * 600
    assert [len(x) for x in apply(fields.verdict, [long]) + apply(lambda c: fields.verdict(c, limit=None), [long])] == [503, 600]


def test_a_term_found_leaves_later_patterns_unsearched(spark):
    # A pattern that cannot be compiled fails as soon as it is searched for.
    df = spark.createDataFrame([("判处有期徒刑一年六个月。",)], "body string")
    found = df.select(fields.sentence(F.col("body"), [rules.PRISON_TERMS[0], "([b-a])"])).first()[0]
    assert found == "1年6个月"
