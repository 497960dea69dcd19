import pytest

from docketframe.functions import clean

NOISY = """
    欢迎您 使用帮助
    某某市人民法院
    刑事判决书
    案 由
    被告人李某犯故意伤害罪。
    被告人李某犯故意伤害罪。
    """

TABLE = {
    NOISY: "某某市人民法院\n刑事判决书\n被告人李某犯故意伤害罪。",
    "ab\nabc": "abc",
    "甲甲甲\n乙乙乙\n甲甲甲": "甲甲甲\n乙乙乙\n甲甲甲",
    "甲甲甲\n目录\n甲甲甲": "甲甲甲",
    "\u3000\u3000缩进的行\r": "缩进的行",
    "案由：甲": "案由：甲",
    "2024年1月2日 星期三": "",
    "前2024年1月2日 星期三": "前2024年1月2日 星期三",
    "首页 刑事案件 民事案件": "首页 刑事案件 民事案件",
    "首页 刑事案件 民事案件 行政案件": "",
    "当事人及其他人的一整行": "",
    "": "",
    None: "",
}


def test_clean_content(apply):
    assert apply(clean.clean_content, list(TABLE)) == list(TABLE.values())


def test_cleaning_twice_changes_nothing(apply):
    once = apply(clean.clean_content, list(TABLE))
    assert apply(clean.clean_content, once) == once


def test_own_noise_list(apply):
    assert apply(lambda c: clean.clean_content(c, [r"^x\d+$"]), ["x12\nx12y\n目录页"]) == ["x12y\n目录页"]
    assert apply(lambda c: clean.clean_content(c, []), ["目录页"]) == ["目录页"]


def test_flatten(apply):
    assert apply(clean.flatten_body, [" a \n\n b c\n\u3000", "", None]) == ["a b c", "", ""]


@pytest.mark.parametrize("text, short, blank", [("字" * 100, True, False), ("字" * 101, False, False),
                                                ("\u3000\n", True, True), (None, True, True)])
def test_flags(apply, text, short, blank):
    assert apply(clean.is_short, [text]) == [short]
    assert apply(clean.is_blank, [text]) == [blank]
