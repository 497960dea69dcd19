import random

import pytest
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.functions import html, links
from docketframe.operators import pages

LIST_PAGE = """<html><head><title>t</title></head><body>
<a class="caseName" href="/top">外部</a>
<div class="LM_list x"><h4><a class="caseName big" href="../d?id=1"> 甲 案 </a></h4>
  <span class="slfyName">某院<br></span><span class=ah>（2024）1号</span><span class="cprq">2024-06-01</span></div>
<div class="LM_list"><h4>没有链接</h4><span class="ah">2号</span></div>
<div class="LM_list"><a class="caseName" href="/e?id=3"> </a></div>
<div class="LM_list"><a class="caseName" href="http://h/4">甲 案</a><script>var x="<a class='caseName'>";</script></div>
</body></html>"""


def page_table(spark, *sources):
    rows = [(i, f"http://h/{i}", s) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_list_records(spark):
    df = page_table(spark, LIST_PAGE, "<p>no items</p>", None)
    rows = pages.list_records(df).orderBy("list_index").collect()
    base = rules.SITE_BASE
    assert [(r.list_index, r["index"], r.title, r.link) for r in rows] == [
        (0, 1, "甲 案", f"{base}/website/wenshu/d?id=1"),
        (2, 3, "", f"{base}/e?id=3"),
        (3, 4, "甲 案", "http://h/4"),
    ]
    assert (rows[0].court, rows[0].case_no, rows[0].date) == ("某院", "（2024）1号", "2024-06-01")
    assert (rows[1].court, rows[1].case_no, rows[1].date) == ("", "", "")
    # Opening by title leads to the first link with that title on the page.
    assert [r.open_link for r in rows] == [rows[0].link, rows[1].link, rows[0].link]


def test_list_records_with_placeholders(spark):
    rows = pages.list_records(page_table(spark, LIST_PAGE), keep_untitled=True).orderBy("list_index").collect()
    assert [r.title for r in rows] == ["甲 案", "案件2", "案件3", "甲 案"]
    assert (rows[1].link, rows[1].case_no) == ("", "2号")


def body(*texts):
    return "<body>" + "".join(f'<div class="{c}">{t}</div>' for c, t in texts) + "</body>"


def test_body_chain(spark):
    df = page_table(
        spark,
        body(("content", "a" * 50), ("document", "b" * 150), ("wsContent", "c" * 900)),
        body(("content", "a" * 50), ("document", "b" * 60)),
        "<p>nothing else</p>",
        "",
    )
    got = [r.body for r in pages.page_bodies(df).orderBy("page_id").collect()]
    # None is long enough in the second: the last that exists is the body.
    assert got == ["b" * 150, "a" * 50 + "\n" + "b" * 60, "nothing else", ""]
    short = pages.page_bodies(df, rules.BODY_CHAIN[:-1]).orderBy("page_id").collect()
    assert short[1].body == "b" * 60


def test_detail_records(spark):
    df = page_table(
        spark,
        "<h1>题 目</h1>" + body(("content", "<b>x</b>"), ("document", "b" * 150)),
        "<div>其他</div><div>某<b>法院</b></div><div>由法院<p>记</p></div>",
        "<p>只有正文</p>",
        "<div id='mycontent'></div><div class='text-content'>later</div>",
    )
    got = pages.detail_records(df).orderBy("page_id").collect()
    assert [r.full_text for r in got] == ["x", "由法院\n记", "只有正文", "later"]
    assert [r.html_content for r in got] == ["<b>x</b>", "由法院<p>记</p>", "<p>只有正文</p>", "later"]
    assert [r.title for r in got] == ["题 目", None, None, None]
    assert got[0].detail_url == "http://h/0"
    titled = pages.detail_records(df.withColumn("title", F.lit("given"))).first()
    assert titled.title == "given"


@pytest.mark.parametrize(
    "source, text",
    [
        ("a  <b> b</b>\n c", "a b c"),
        ("<p>a<p>b<div>c</div>d", "a\nb\nc\nd"),
        ("a<br>b<br><br>c<br></div>", "a\nb\n\nc"),
        ("<style>x</style><script>var a='<p>';</script>y<noscript>z</noscript>", "y"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2\n3"),
        ("<ul><li>a<li>b</ul>c", "a\nb\nc"),
        ("&amp;&copy;&nbsp;&#x4E00;&middot;", "&© 一·"),
        ("<b>x<p>y</b>z</p>w", "x\nyz\nw"),
        ("<!-- c --><pre>a\n b</pre>", "a\nb"),
        ("<div>a", "a"),
    ],
)
def test_rendered_text(source, text):
    page = html.Page(source)
    assert page.text(page.first("body")) == text


def test_selectors(apply):
    source = '<div class="a b" id="i">1</div><pre data-x="uvw">2</pre><div>法院3<i>x</i></div>'
    chosen = ["div.a.b", "#i", "pre", "[data-x*=v]", "div[data-x*='v']", "div:text(法院)", "div.c"]
    got = apply(lambda c: html.html_select(c, chosen), [source, None])
    assert [h and h["text"] for h in got[0]] == ["1", "1", "2", "2", None, "法院3x", None]
    assert got[0][5]["html"] == "法院3<i>x</i>" and got[1] is None
    with pytest.raises(ValueError):
        html.Page("").first("a > b")


def test_links_and_keys(apply, spark):
    base = rules.SITE_BASE
    given = ["../a", "/a", "http://h/a", "a", "", None]
    assert apply(links.absolute_link, given) == [
        f"{base}/website/wenshu/a", f"{base}/a", "http://h/a", "a", "", ""
    ]
    assert apply(lambda c: links.file_key(c, F.lit(4)), ["a/b:c\\d", "", None]) == ["a_b_c_d", "case_4", "case_4"]
    assert apply(links.host, ["https://h.x/a?b", "no url"]) == ["h.x", None]
    assert apply(lambda c: links.on_site(c, "h.x"), ["https://h.x/a", "y"]) == [True, False]


def test_one_page_per_url_and_bodies(spark):
    snapshots = spark.createDataFrame(
        [(1, "u"), (0, "u"), (2, "v"), (3, "")], "page_id bigint, url string"
    ).withColumn("body", F.concat(F.lit("b"), F.col("page_id").cast("string")))
    kept = pages.one_page_per_url(snapshots)
    assert sorted(r.page_id for r in kept.collect()) == [0, 2, 3]
    records = spark.createDataFrame([(1, "u"), (2, "u"), (3, "w"), (4, ""), (5, None)], "i int, link string")
    got = {r.i: r.body for r in pages.attach_bodies(records, kept).collect()}
    assert got == {1: "b0", 2: "b0", 3: "", 4: "", 5: ""}
    assert pages.attach_bodies(records, kept, keep_missing=False).count() == 2


def summary_rows(seed):
    """Crawls of very different sizes, gaps between page numbers, empty pages."""
    rng, rows = random.Random(seed), []
    for crawl, size in [("hot", 700), ("b", 40), ("c", 1), ("d", 0)]:
        for page_no in sorted(rng.sample(range(1, size * 3 + 2), size)):
            n = rng.choice([0, 1, 5, 5])
            rows.append((crawl, page_no, n, rng.choice(["甲", "乙"]) if n else ""))
    return rows


@pytest.mark.parametrize("width", [1, 7, 100, 100_000])
def test_page_progress_against_a_plain_loop(spark, width):
    rows = summary_rows(width)
    expected, before = {}, {}
    for crawl, page_no, n, title in rows:
        last_title, total, empties = before.get(crawl, ("", 0, 0))
        expected[crawl, page_no] = (last_title, total, empties)
        before[crawl] = (title, total + n, empties + (n == 0))
    df = spark.createDataFrame(rows, "crawl string, page_no int, n int, first_title string").repartition(5)
    got = {
        (r.crawl, r.page_no): (r.prev_first_title, r.rows_before, r.empty_before)
        for r in pages.page_progress(df, width=width).collect()
    }
    assert got == expected


def test_budget_takes_whole_pages(spark):
    df = spark.createDataFrame([("c", p, 5 if p < 6 else 0, "t") for p in range(1, 8)], "crawl string, page_no int, n int, first_title string")
    progress = pages.page_progress(df)
    taken = pages.pages_to_take(progress, target=12)
    assert taken.agg(F.count("*"), F.sum("n")).first() == (3, 15)
    assert pages.pages_to_take(progress).count() == 5
    assert pages.pages_to_take(progress, max_page=2).count() == 2
    assert progress.where(pages.page_advanced()).count() == 1


def test_page_summary(spark):
    row = pages.page_summary(page_table(spark, LIST_PAGE)).first()
    assert (row.n, row.first_title) == (3, "甲 案")


def test_reader_ships_without_the_package(tmp_path):
    """Executors get the reader inside the UDF and have no copy of the package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "page").write_bytes(cloudpickle.dumps(html.Page))
    code = (
        "from pyspark import cloudpickle; P = cloudpickle.loads(open('page', 'rb').read()); "
        "p = P('<p class=x>&amp;a'); print(p.text(p.first('p.x')))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout == "&a\n"


def test_hostile_pages_take_linear_time():
    import time

    started = time.time()
    for source in ("<b " * 200_000, "a < b " * 200_000 + ">", '<b "' * 100_001 + ">", "<p>" * 50_000, "<!--" * 100_000):
        html.Page(source)
    assert time.time() - started < 20


def test_a_snapshot_is_one_row_per_url(spark):
    rows = [(1, "u", "a"), (1, "v", "b"), (0, "v", "c"), (0, "v", "c"), (2, "u", "d"), (3, None, "e")]
    snapshots = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    kept = sorted(tuple(r) for r in pages.one_page_per_url(snapshots).collect())
    assert kept == [(0, "v", "c"), (1, "u", "a")]


def test_blank_links_meet_nothing_and_are_dealt_out(spark):
    records = spark.range(1000).selectExpr("id", "CASE WHEN id < 10 THEN 'u' WHEN id % 2 = 0 THEN '' END AS link")
    bodies = spark.createDataFrame([("u", "text"), ("", "blank"), (None, "none")], "url string, body string")
    got = pages.attach_bodies(records, bodies)
    assert got.count() == 1000 and got.where("body = 'text'").count() == 10 and got.where("body = ''").count() == 990
    assert pages.attach_bodies(records, bodies, keep_missing=False).count() == 10


def crawl_of(spark, *pages_of_titles, crawl=1):
    rows = [
        (crawl, no, "".join(f'<div class="LM_list"><a class="caseName" href="/{t}">{t}</a></div>' for t in titles))
        for no, titles in enumerate(pages_of_titles)
    ]
    return spark.createDataFrame(rows, "crawl int, page_no int, html string")


def taken_numbers(found):
    return sorted((r.crawl, r.page_no) for r in found.select("crawl", "page_no").collect())


@pytest.mark.parametrize(
    "titles, target, max_page, n",
    [
        ([["a", "b"], ["c"], [], ["d"]], None, None, 2),  # an empty page
        ([["a", "b"], ["a", "c"], ["d"]], None, None, 1),  # the page did not turn
        ([["a"], ["", "c"], ["d"]], None, None, 1),  # nor is a blank title a new one
        ([["", "b"], ["c"]], None, None, 2),  # but the first page needs none
        ([["a", "b"], ["c", "d"], ["e", "f"], ["g"]], 3, None, 2),  # whole pages up to the target
        ([["a"], ["b"], ["c"]], None, 1, 2),
        ([[], ["b"]], None, None, 0),
        ([["a"]], None, None, 1),
    ],
)
def test_a_crawl_stops(spark, titles, target, max_page, n):
    for first_pages in (1, 2, 16):
        taken, _ = pages.pages_until_stop(crawl_of(spark, *titles), target, max_page, first_pages=first_pages)
        assert taken_numbers(taken) == [(1, i) for i in range(n)]


def test_pages_past_a_stop_are_not_parsed(spark):
    short = crawl_of(spark, *[[f"s{i}"] for i in range(5)], [], *[[f"s{i}"] for i in range(6, 400)])
    long = crawl_of(spark, *[[f"l{i}"] for i in range(100)], crawl=2)
    taken, parsed = pages.pages_until_stop(short.unionByName(long), first_pages=4)
    assert taken_numbers(taken) == [(1, i) for i in range(5)] + [(2, i) for i in range(100)]
    # Blocks of 4, 8, 16 ...: the short crawl is left alone after its second block.
    assert taken_numbers(parsed) == [(1, i) for i in range(12)] + [(2, i) for i in range(100)]
    _, parsed = pages.pages_until_stop(long, target=20, first_pages=4)
    assert parsed.count() == 28


def test_a_crawl_with_gaps_goes_on(spark):
    crawl = crawl_of(spark, *[[f"t{i}"] for i in range(40)])
    gappy = crawl.where("page_no < 3 OR page_no > 30").unionByName(crawl_of(spark, *[["x"]] * 3, crawl=2).where("page_no = 1"))
    taken, _ = pages.pages_until_stop(gappy, first_pages=2)
    assert taken_numbers(taken) == [(1, i) for i in [0, 1, 2, *range(31, 40)]] + [(2, 1)]


def test_no_pages_at_all(spark):
    taken, parsed = pages.pages_until_stop(crawl_of(spark, ["a"]).limit(0))
    assert taken.count() == parsed.count() == 0


def test_a_title_opens_its_first_link_on_a_page_of_very_many(spark):
    n = 100_000
    items = "".join(f'<div class="LM_list"><a class="caseName" href="/{i}">t{i % 1000}</a></div>' for i in range(n))
    listed = pages.list_records(spark.createDataFrame([(1, items)], "page_id int, html string"), base=None)
    rows = listed.select("list_index", "open_link").collect()
    assert len(rows) == n and all(r.open_link == f"/{r.list_index % 1000}" for r in rows)
