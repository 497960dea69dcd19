"""Sample inputs derived from the driver's tables.

The tables hold no court texts, so these expressions turn rows of ``orders``
into judgments and result-list items.  They use only functions that mean the
same in Spark SQL and in ANSI-style SQL elsewhere, so that both sides of a
check build their input from one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketframe.session import dealt, portions

NL = "chr(10)"
K = "o_orderkey"
DAY = "concat(cast(year(o_orderdate) as string), '{0}', cast(month(o_orderdate) as string), '{1}', cast(day(o_orderdate) as string), '{2}')"
CENTS = "cast(round(o_totalprice * 100) as bigint)"
AMOUNT = f"concat(cast(floor({CENTS} / 100) as bigint), '.', lpad(cast({CENTS} % 100 as string), 2, '0'))"


def choose(n: int, *texts: str, key: str = K) -> str:
    """SQL: one of several texts by ``key % n``; the last one otherwise."""
    cases = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts[:-1]))
    return f"(CASE CAST(({key}) % {n} AS int) {cases} ELSE {texts[-1]} END)"


def q(text: str) -> str:
    return f"'{text}'"


def joined(*parts: str) -> str:
    return "concat(" + ", ".join(parts) + ")"


NOISE_LINE = choose(
    17,
    joined(DAY.format("年", "月", "日"), q(" 星期三 访问")),
    q("欢迎您 张某 使用帮助"),
    q("退出 意见建议　返回主站"),
    q("本文目录"),
    q("请点击了解更多内容"),
    q("案　由"),
    q("案 \t号"),
    q("文书类型判决书"),
    q("审理法院某院"),
    q("审理程序一"),
    q("裁判日期某日"),
    q("公开类型公开"),
    q("当事人信息"),
    q("案件基本情况如下"),
    q("首页 刑事案件 民事案件 行政案件 更多"),
    q("登录 注册 意见建议"),
    q("案由：不属噪音"),
)

COURT = choose(5, q("某某市人民法院"), q("甲省乙县人民法院"), q("丙市中级法院"), q("　丁区人民法院 "), q("--"))

CASE_NO = choose(
    6,
    joined(q("（"), "cast(year(o_orderdate) as string)", q("）示"), f"cast(o_custkey as string)", q("刑初"), f"cast({K} as string)", q("号")),
    joined(q("("), "cast(year(o_orderdate) as string)", q(")例刑终"), f"cast({K} as string)", q("号")),
    joined(q("案号：（２０２４）样刑初"), f"cast({K} as string)", q("号")),
    joined(q("（24）短刑初"), f"cast({K} as string)", q("号")),
    joined(q("（"), "cast(year(o_orderdate) as string)", q("）示 刑初"), f"cast({K} as string)", q("号")),
    q("无号"),
)

DEFENDANT = choose(
    7,
    q("被告人李某，男，1990年1月1日出生。"),
    q("被告人王某某、女、汉族。"),
    q("被告：赵某 男 汉族。"),
    q("被告人孙某　女　1991年出生，无业。"),
    q("被告人周某，汉族，男，农民。"),
    q("被告:吴某，女，汉族。"),
    q("被告人郑某男。"),
)

INJURY = choose(
    9,
    q("轻伤二级"), q("轻伤Ⅰ级"), q("重伤Ⅱ级"), q("重伤一级"), q("轻微伤"),
    q("轻伤，后为重伤"), q("轻伤"), q("轻伤一级与轻伤二级"), q("擦伤"),
)

TERM = choose(
    16,
    q("判处有期徒刑一年六个月。"),
    q("判处有期徒刑二十五年，缓刑二年。"),
    q("判处有期徒刑三年缓刑四年。"),
    q("判处有期徒刑六个月缓刑一年。"),
    q("处三年以下有期徒刑、拘役三个月，并处罚金。"),
    q("判处有期徒刑两年。"),
    q("判处无期徒刑。"),
    q("判处拘役五个月。"),
    q("免予刑事处罚。"),
    q("判处被告人李某有期徒刑十个月、缓刑"),
    q("判处有期徒刑　十五年二个月。"),
    joined(q("判处有期徒刑"), f"cast({K} % 13 as string)", q("年"), f"cast({K} % 12 as string)", q("个月。")),
    q("判处有期徒刑１２年０６月缓刑 三年。"),
    q("判处有期徒刑十一年十二个月，剥夺政治权利一年。"),
    q("判处有期徒刑七"),
    q("判处拘役 十二个月，免予刑事处罚。"),
)

MONEY = choose(
    12,
    joined(q("赔偿被害人经济损失人民币"), AMOUNT, q("元。")),
    joined(q("赔偿被害人经济损失人民币"), f"cast({K} % 50 as string)", q("万元。")),
    joined(q("赔偿医疗费"), f"cast({K} % 9000 as string)", q("元、误工费3000元。")),
    q("赔偿人民币12,000元。"),
    joined(q("于5月3日在本市某区某路某号门前发生争执并且互相殴打后赔偿5万元。")),
    q("支付800元。"),
    joined(q("给付人民币 "), AMOUNT, q(" 元，经济损失"), f"cast({K} % 700 as string)", q("元。")),
    q("赔偿２５００元。"),
    q("赔偿0.125元，经济损失0.375 元。"),
    joined(q("赔偿"), f"cast({K} % 100 as string)", q(".5万元，经济损失共计"), f"cast({K} % 77 as string)", q("万元。")),
    q("不予赔偿。"),
    q("赔偿损失。"),
)

OPINION = choose(4, q("本院认为，其行为已构成犯罪。"), q("本院认为：其行为 已构成　犯罪。"), q("经评议，"), q("本院认为:"))

DATE_LINE = choose(
    6,
    DAY.format("年", "月", "日"),
    DAY.format("-", "-", ""),
    DAY.format("/", "/", ""),
    q("二〇二四年六月一日"),
    joined(DAY.format("年", "月", "日"), q("，"), q("2020年02月03日")),
    joined(q("1999-9-9 "), DAY.format("/", "/", "")),
)

FILLER = f"repeat('经审理查明的有关事实如下所记。', cast(({K} % 10) * ({K} % 17) as int))"

BODY = joined(
    NOISE_LINE, NL,
    COURT, NL,
    q("刑事判决书"), NL,
    CASE_NO, NL, NL,
    choose(8, q("被告人提出上诉。"), q("申诉材料一份。"), q("某某"), q("公诉机关某院。"), q("　　公诉机关某院。 ")), NL,
    DEFENDANT, NL,
    choose(3, FILLER, q("经审理查明，因琐事争执。"), joined(FILLER, NL, FILLER)), NL,
    choose(5, q("发回重审。"), q("再审。"), q("目录"), q("经查。"), q("重复的一行。")), NL,
    q("重复的一行。"), NL,
    choose(4, q("重复的一行。"), q("另外的一行。"), NOISE_LINE, q("　")), NL,
    q("重复的一行。"), NL,
    q("经鉴定为"), INJURY, q("。"), NL,
    OPINION, NL,
    q("判决如下："), NL,
    q("一、被告人李某犯故意伤害罪，"), TERM, NL,
    q("二、"), MONEY, NL, NL,
    choose(9, q("审判员 张某"), q("书记员 张某"), q("--")), NL,
    DATE_LINE,
    choose(3, NL, q("")),
)

# Two parts as a resumed collection leaves them: rows overlap in neither.
CASE = {
    "seq": K,
    "title": choose(4, q("李某故意伤害罪一审刑事判决书"), q("王某案"), q(""), joined(q("案件 "), f"cast({K} as string)")),
    "court": choose(3, q("某某市人民法院"), q(""), q("甲省乙县人民法院")),
    "case_no": choose(4, joined(q("（2024）示/刑:初"), f"cast({K} as string)", q("号")), q(""), q(""), q("a\\b")),
    "date": choose(3, q("2024-06-01"), q(""), q("1999-12-31")),
    "link": joined(q("https://example.invalid/case/"), f"cast({K} as string)"),
    "body": f"(CASE WHEN {K} % 23 = 0 THEN '' ELSE {BODY} END)",
}

# A result list: five items a page, some without a link, pages of crawls
# interleaved, and some pages empty.
PER_PAGE = 5
PAGE = f"cast(floor({K} / {PER_PAGE}) as bigint)"
AT = f"cast({K} % {PER_PAGE} as int)"
CRAWL = f"cast(floor({K} / {PER_PAGE}) % 7 as bigint)"
PAGE_NO = f"cast(floor({K} / {PER_PAGE * 7}) as bigint)"
EMPTY_PAGE = f"(({PAGE}) % 97 = 90)"

TITLED = f"({K} % 11 <> 7)"
TITLE = choose(
    6,
    q("故意伤害案甲"),
    joined(q("案 & 件 "), f"cast(o_custkey as string)"),
    q("故意伤害案甲"),
    joined(q("案件之"), f"cast({K} as string)"),
    q(""),
    q("同题案"),
)
# Detail pages that links of the list lead to: stored pages stand in for them.
CASE_URL = "https://example.invalid/case/"
# A URL has a few snapshots, and some URLs have a few links, whatever the size of the tables.
SNAPSHOTS = 3
LINK = choose(
    5,
    joined(q("../181107/index.html?docId="), f"cast({K} as string)"),
    joined(q("/website/a?id="), f"cast({K} as string)"),
    joined(q(CASE_URL), f"cast(floor({K} / 100) as bigint)"),
    joined(q("docs/"), f"cast({K} as string)"),
    q(""),
    key=f"{K} + o_custkey",
)
ITEM_COURT = choose(3, q("某某市人民法院"), q(""), q("甲省乙县人民法院"))
ITEM_NO = joined(q("（2024）示刑初"), f"cast({K} as string)", q("号"))
HAS_NO = f"({K} % 4 <> 3)"
ITEM_DATE = f"substring(cast(cast(o_orderdate as date) as string), 1, 10)"

ITEM_HTML = joined(
    q('<div class="LM_list top"><div class="list_title"><h4>'),
    f"""(CASE WHEN {TITLED} THEN concat('<a class="caseName" target=_blank href="', {LINK}, '">  ',
        replace({TITLE}, '&', '&amp;'), ' </a>') ELSE '<b>无题</b>' END)""",
    q('</h4></div><div class="list_subtitle"><span class="slfyName">'),
    ITEM_COURT,
    q("</span>"),
    f"""(CASE WHEN {HAS_NO} THEN concat('<span class="ah"> ', {ITEM_NO}, '</span>') ELSE '' END)""",
    q('<span class="cprq">'),
    ITEM_DATE,
    q("<br></span></div></div>"),
)

# Titles that are alike on many pages are told apart by page number; every 41st page shows the
# number of the page before.
SHOWN_PAGE = "cast(page_no - (CASE WHEN page_no % 41 = 40 THEN 1 ELSE 0 END) as string)"
TURNED = f"""replace(replace(html, '故意伤害案甲', concat('题', {SHOWN_PAGE})), '">   </a>', concat('">  题', {SHOWN_PAGE}, '</a>'))"""


#: Orders of one task: a judgment is some hundred times as long as its order.
ORDERS_PER_TASK = 50_000


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/orders.parquet"), ORDERS_PER_TASK)


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One judgment text per order."""
    return read_orders(spark, sf_dir).select(F.col(K).alias("k"), F.expr(BODY).alias("body"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One case record per order, with empty fields and bodies among them."""
    return as_cases(read_orders(spark, sf_dir))


def as_cases(orders: DataFrame) -> DataFrame:
    return orders.select(*[F.expr(sql_literals(e)).alias(c) for c, e in CASE.items()])


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result-list pages of five items."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
        portions(orders, ORDERS_PER_TASK),
    )
    # An item is several times as long as its order, so orders are shuffled and items made behind that.
    dealt_orders = orders.select(F.expr(PAGE).alias("page_id"), K, "o_custkey", "o_orderdate").repartition(tasks, "page_id")
    items = dealt_orders.select(
        "page_id",
        F.expr(CRAWL).alias("crawl"),
        F.expr(PAGE_NO).alias("page_no"),
        F.expr(AT).alias("at"),
        F.expr(f"CASE WHEN {EMPTY_PAGE} THEN '' ELSE {ITEM_HTML} END").alias("item"),
    )
    # A page has PER_PAGE rows at most, so its list is small.
    in_order = F.array_sort(F.collect_list(F.struct("at", "item")))
    return items.groupBy("page_id", "crawl", "page_no").agg(
        F.concat(
            F.lit("<html><body><p>结果</p>"),
            F.array_join(F.transform(in_order, lambda i: i["item"]), "\n"),
            F.lit("</body></html>"),
        ).alias("html")
    )


def sql_literals(expression: str) -> str:
    """Spark reads a backslash in a literal as an escape; plain SQL does not."""
    return expression.replace("\\", "\\\\")
