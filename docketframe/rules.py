"""Default rule values.  Every function that uses one takes it as an argument.

Patterns are written in the dialect rule authors know (``\\d`` and ``\\s`` mean
any Unicode digit or white space); :func:`docketframe.functions.text.java_regex`
turns them into what Spark's regex engine needs.
"""

# ---------------------------------------------------------------------------
# These have to be exactly so for results to be right.
# ---------------------------------------------------------------------------

# Column headers of the two exported tables, in order.
CASE_HEADERS = ["序号", "标题", "法院", "案号", "日期", "链接", "正文"]
REVIEW_HEADERS = ["序号", "标题", "法院", "案号", "日期", "性别", "判决结果", "链接", "正文"]

# Lines of a body that contain one of these are page furniture.
NOISE_PATTERNS = [
    r"^\d{4}年\d{1,2}月\d{1,2}日\s*星期[一二三四五六日]",
    r"欢迎您.*?使用帮助",
    r"退出\s*意见建议\s*返回主站",
    r"目录",
    r"点击了解更多",
    r"案\s+由",
    r"案\s+号",
    r"文书类型",
    r"审理法院",
    r"审理程序",
    r"裁判日期",
    r"公开类型",
    r"当事人",
    r"案件基本情况",
    r"首页.*?刑事案件.*?民事案件.*?行政案件",
    r"登录.*?注册.*?意见建议",
]

CASE_NO = r"[（(]\d{4}[）)][一-龥\d]+号"
COURTS = [r"([一-龥]+人民法院)", r"([一-龥]+法院)"]
DATES = [
    r"(\d{4})年(\d{1,2})月(\d{1,2})日",
    r"(\d{4})-(\d{1,2})-(\d{1,2})",
    r"(\d{4})/(\d{1,2})/(\d{1,2})",
]
GENDERS = [
    r"被告人[^，。]+?[，、\s](男|女)[，、\s]",
    r"被告[：:][^，。]*?[，、\s](男|女)[，、\s]",
]
CASE_REASON = "故意伤害罪"
INJURY_LEVELS = [
    ("重伤二级", ["重伤二级", "重伤Ⅱ级"]),
    ("重伤一级", ["重伤一级", "重伤Ⅰ级"]),
    ("重伤", ["重伤"]),
    ("轻伤二级", ["轻伤二级", "轻伤Ⅱ级"]),
    ("轻伤一级", ["轻伤一级", "轻伤Ⅰ级"]),
    ("轻伤", ["轻伤"]),
    ("轻微伤", ["轻微伤"]),
]
AMOUNTS = [
    r"赔偿[^。，]*?(\d+(?:\.\d+)?)\s*(?:元|万元)",
    r"经济损失[^。，]*?(\d+(?:\.\d+)?)\s*(?:元|万元)",
    r"(?:赔偿|支付|给付)[^。，]*?人民币\s*(\d+(?:\.\d+)?)\s*(?:元|万元)",
]
PRISON_TERMS = [
    r"判处(?:被告人)?[^。，]*?有期徒刑([^。，]*?)(?:[，。、]|$)",
    r"有期徒刑\s*([^。，]+?)(?:[，。、]|$)",
]
TERM_YEARS = r"(\d+|[一二三四五六七八九十]+)年"
TERM_MONTHS = r"(\d+|[一二三四五六七八九十]+)个?月"
PROBATION_YEARS = r"缓刑\s*(\d+|[一二三四五六七八九十]+)年"
DETENTION_MONTHS = r"拘役\s*(\d+|[一二三四五六七八九十]+)个?月"
EXEMPTION = "免予刑事处罚"
VERDICT = r"(?:本院认为|判决如下)[：:]([\s\S]*?)(?:审判|书记|$)"
PROCEDURES = [("二审", ["二审", "上诉", "发回重审"]), ("再审", ["再审", "申诉"])]
FIRST_INSTANCE = "一审"
FIRST_NUMBER = r"\d+\.?\d*"

NUMERALS = {
    "零": 0, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6,
    "七": 7, "八": 8, "九": 9, "十": 10, "百": 100, "千": 1000, "万": 10000,
}

# Selectors of a result-list page, and the two selector chains for a body.
LIST_ITEM = "div.LM_list"
LIST_FIELDS = {
    "title": "a.caseName",
    "court": "span.slfyName",
    "case_no": "span.ah",
    "date": "span.cprq",
}
BODY_CHAIN = [
    "div.content", "div.document", "div.detail-content", "div.wsContent",
    "div#content", "div.main-content", "body",
]
DETAIL_CHAIN = [
    "#content", ".content", ".detail-content", ".doc-content", "#contentHtml",
    ".PDF-container", "div[class*=content]", "div[id*=content]",
    ".text-content", ".document", "pre", "div:text(法院)",
]

SITE_BASE = "https://wenshu.court.gov.cn"
PARENT_PREFIX = "/website/wenshu/"
KEYWORD = "故意伤害"
TARGET_COUNT = 500
MAX_PAGE = 50
CHECKPOINT_INTERVAL = 20

# Text windows, in code points.
COURT_WINDOW = 500
DATE_WINDOW = 1000
GENDER_WINDOW = 2000
PROCEDURE_WINDOW = 1000
UNIT_WINDOW = 20
VERDICT_LIMIT = 500
SHORT_BODY = 100
MIN_LINE = 2
