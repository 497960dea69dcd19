import random
import re

import pytest
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.functions import text


def test_white_space_is_what_python_strips():
    assert sorted(text.WS_CHARS) == [chr(c) for c in range(0x10000) if chr(c).isspace()]


def test_strip_and_clean_ws_agree_with_python(apply):
    pieces = [*text.WS_CHARS, "\u200b", "\ufeff", "字", "a", " "]
    rng = random.Random(1)
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(400)]
    assert apply(text.strip, texts) == [t.strip() for t in texts]
    assert apply(text.clean_ws, texts) == [" ".join(t.split()) for t in texts]
    assert apply(text.clean_ws, [None]) == [""]


PATTERNS = [
    *rules.NOISE_PATTERNS, rules.CASE_NO, *rules.COURTS, *rules.DATES, *rules.GENDERS,
    *rules.AMOUNTS, *rules.PRISON_TERMS, rules.TERM_YEARS, rules.TERM_MONTHS,
    rules.PROBATION_YEARS, rules.DETENTION_MONTHS, rules.VERDICT, rules.FIRST_NUMBER,
]
SCRAPS = (
    "年 月 日 星期 三 １ 2 34 5678 欢迎您 使用帮助 退出 意见建议 返回主站 目录 案 由 号 （ ） ( ) 人民法院 法院 - / "
    "被告人 被告 ： ， 。 、 男 女 赔偿 经济损失 支付 人民币 . 元 万元 判处 有期徒刑 十 一 个 缓刑 拘役 本院认为 判决如下 "
    "审判 书记 首页 刑事案件 民事案件 行政案件 登录 注册"
).split() + [" ", "\n", "\r", "\u3000", "\u2028", "\x1c"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_rule_patterns_find_what_python_finds(apply, pattern):
    rng = random.Random(pattern)
    near = [s for s in SCRAPS if s in pattern] * 3 + SCRAPS
    texts = ["".join(rng.choices(near, k=rng.randint(1, 40))) for _ in range(300)]
    compiled = re.compile(pattern)
    expected = [[m.group() for m in compiled.finditer(t)] for t in texts]
    assert apply(lambda c: text.find_all(c, pattern), texts) == expected
    assert apply(lambda c: text.find(c, pattern), texts) == [(e or [""])[0] for e in expected]
    assert apply(lambda c: text.hits(c, pattern), texts) == [bool(e) for e in expected]


@pytest.mark.parametrize(
    "pattern, literal",
    [
        ("目录", "目录"), ("ab?c", "a"), ("ab+cd", "ab"), ("(ab)+c", "c"), ("(ab|c)d", "d"),
        ("a{2}bcd", "bcd"), ("x(?!abcd)y", "x"), (r"[abc]{3}\d", ""), (r"[^\]xyz]ab", "ab"), ("a|b", ""), ("(?:a|b)", ""),
    ],
)
def test_required_literal(pattern, literal):
    assert text.required_literal(pattern) == literal


def test_numerals(apply):
    given = ["一", "十", "十五", "二十", "二十五", "12", "１２", "007", "0", "零", "百", "二百",
             "十十", "二三十四", "二十三四", "", "天", "99999999999999999999"]
    shown = ["1", "10", "15", "20", "25", "12", "12", "7", "0", "0", "100", "0",
             "20", "14", "20", "0", "0", "99999999999999999999"]
    assert apply(text.numeral_text, given) == shown
    assert apply(text.cn_to_num, given[:-1]) == [int(s) for s in shown[:-1]]
    assert apply(text.cn_to_num, [given[-1], None]) == [None, None]


def test_fixed2_rounds_like_printf(apply):
    rng = random.Random(2)
    values = [0.0, 0.125, 0.375, 2.675, 1.005, 0.005, 0.015, 0.995, 9.995, 99.999, 1e-9, 0.0049999,
              0.00390625, 12000.0, 4503599627370495.5, 9007199254740991.0, 1e15 + 0.125]
    values += [rng.randint(0, 10**6) / 1000 for _ in range(500)]
    values += [rng.randint(0, 10**5) / 8 for _ in range(200)]
    values += [rng.random() * 10 ** rng.randint(-4, 12) for _ in range(500)]
    assert apply(text.fixed2, values, "double") == ["%.2f" % v for v in values]
    assert apply(text.fixed2, [None], "double") == [None]


def test_first_number(apply):
    texts = ["", "x", "3.5a7", "第１２号", "5.", None]
    assert apply(text.first_number, texts) == [0.0, 0.0, 3.5, 12.0, 5.0, 0.0]
    assert apply(lambda c: text.first_number(c, -1), ["x"]) == [-1.0]


def test_md5_cut_and_chunks(apply, spark):
    assert apply(text.body_md5, ["", "法院"]) == [
        "d41d8cd98f00b204e9800998ecf8427e", __import__("hashlib").md5("法院".encode()).hexdigest()
    ]
    assert apply(lambda c: text.display_cut(c, 2), ["某某市"]) == ["某某..."]
    ids = spark.range(1, 6).select(text.chunk_id(F.col("id"), 2).alias("c")).collect()
    assert [r.c for r in ids] == [0, 0, 1, 1, 2]


def test_clock(spark):
    row = spark.range(1).select(text.current_time_text(), text.current_millis()).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", row[0])
    assert row[1] > 1_600_000_000_000


@pytest.mark.parametrize(
    "pattern, value",
    [
        ("(?i)foo", "FOO bar"), (r"\x41bc", "xAbc"), (r"\0101zz", "Azz"), (r"(?<n>f)\k<n>oo", "ffoo"),
        (r"x\cAb", "x\x01b"), ("[[:alpha:]]ab", ":ab"), ("[a&&[ab]]cd", "acd"), (r"\Qa.b\E", "a.b"),
    ],
)
def test_patterns_whose_spelling_hides_their_literals(apply, pattern, value):
    assert text.required_literal(pattern) == ""
    assert apply(lambda c: text.find(c, pattern), [value]) != [""]


def test_rounding_is_exact_beyond_integers_of_a_double(spark):
    values = [2.0**53, 1e16, 9007199254740994.0, 1e18, 1.5e19, 1e23, 1.2345e30, 1e37]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(text.fixed2(F.col("v"))).collect()] == ["%.2f" % v for v in values]
    # Past what a decimal holds, the shortest digits are padded with zeros.
    beyond = spark.createDataFrame([(1e38,)], "v double")
    assert beyond.select(text.fixed2(F.col("v"))).first()[0] == "1" + "0" * 38 + ".00"
