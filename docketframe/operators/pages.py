"""Operators over stored list and detail pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.functions import html as H
from docketframe.functions.links import absolute_link
from docketframe.functions.text import blank_to_null
from docketframe.session import staged

ITEM_COLUMNS = ["list_index", "title", "link", "case_no", "court", "date"]


def with_listing(pages: DataFrame, html: str = "html", fields: dict[str, str] | None = None) -> DataFrame:
    """Parse list pages: ``items`` replaces the HTML column."""
    return pages.withColumn("_l", H.listing(F.col(html), fields=fields)).select(
        *[c for c in pages.columns if c != html], F.col("_l.items").alias("items")
    )


def list_records(
    pages: DataFrame,
    html: str = "html",
    keep_untitled: bool = False,
    base: str | None = rules.SITE_BASE,
) -> DataFrame:
    """One row per list item, in-page position included.

    Items without a title link are dropped, or kept under a placeholder with
    ``keep_untitled`` (which also stands in for a blank title).  ``base=None``
    leaves links as they are written in the page.

    ``open_link`` is where opening the item by its title leads: the first link
    of the page with that title.  It is found while the page is read, so
    no join is needed.
    """
    return listed_records(with_listing(pages, html), keep_untitled, base)


def listed_records(
    listed: DataFrame, keep_untitled: bool = False, base: str | None = rules.SITE_BASE
) -> DataFrame:
    """As :func:`list_records`, of pages parsed by :func:`with_listing`."""

    def resolved(link):
        return link if base is None else absolute_link(link, base)

    out = listed.select(
        *[c for c in listed.columns if c != "items"], F.explode("items").alias("i")
    ).select(
        *[c for c in listed.columns if c != "items"],
        (F.col("i.list_index") + 1).alias("index"),
        *[F.col(f"i.{c}").alias(c) for c in [*ITEM_COLUMNS, "open_link"]],
    )
    if keep_untitled:
        placeholder = F.concat(F.lit("案件"), F.col("index").cast("string"))
        out = out.withColumn("title", F.coalesce(blank_to_null(F.col("title")), placeholder))
    else:
        out = out.where(F.col("title").isNotNull())
    return out.withColumns(
        {
            "link": resolved(F.coalesce("link", F.lit(""))),
            "open_link": resolved(F.coalesce("open_link", "link", F.lit(""))),
        }
    )


def page_bodies(
    pages: DataFrame, chain: Sequence[str] = rules.BODY_CHAIN, html: str = "html"
) -> DataFrame:
    """Body text of each page: first region of the chain that is long enough."""
    region = H.detail_region(F.col(html), chain, rules.SHORT_BODY)
    return pages.withColumn("_d", region).select(
        *[c for c in pages.columns if c != html], F.col("_d.full_text").alias("body")
    )


def detail_records(
    pages: DataFrame, chain: Sequence[str] = rules.DETAIL_CHAIN, html: str = "html"
) -> DataFrame:
    """Detail records: first region of the chain that exists, with its HTML.

    ``h1`` gives the title where the page row has none.
    """
    parsed = pages.withColumn("_d", H.detail_region(F.col(html), chain, None, with_html=True))
    heading = F.col("_d.heading")
    title = (
        F.coalesce(blank_to_null(F.col("title")), heading) if "title" in pages.columns else heading
    )
    return parsed.select(
        *[c for c in pages.columns if c not in (html, "title", "url")],
        title.alias("title"),
        F.col("_d.full_text").alias("full_text"),
        F.col("_d.html_content").alias("html_content"),
        F.col("url").alias("detail_url"),
    )


def one_page_per_url(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Keep the first snapshot of each URL.

    Which one is decided on two narrow columns with map-side combining; the
    wide rows are then filtered by URL and key, so no URL is a hot group.  Of
    rows that share both, one is kept; only such rows are shuffled for it.
    Pages without a URL are left out: no link leads to them.
    """
    copies = pages.groupBy("url", key).agg(F.count(F.lit(1)).alias("_n"))
    first = copies.groupBy("url").agg(F.min(F.struct(key, "_n")).alias("_f"))
    first = first.select("url", F.col(f"_f.{key}").alias(key), F.col("_f._n").alias("_n"))

    def kept(condition: str) -> DataFrame:
        return pages.join(first.where(condition).drop("_n"), ["url", key], "left_semi").select(pages.columns)

    return kept("_n = 1").unionByName(kept("_n > 1").dropDuplicates(["url", key]))


def attach_bodies(
    records: DataFrame, bodies: DataFrame, link: str = "link", keep_missing: bool = True
) -> DataFrame:
    """List records with the body of the page they link to.

    ``bodies`` has one row per ``url``.  Records whose page is missing get ''
    or are dropped.  A blank link matches nothing, and such records are dealt
    out by their contents.  Many records may share a link: both sides are
    shuffled by the join itself, so AQE can split it.
    """
    right = bodies.select(F.col("url").alias("_url"), "body")
    target = blank_to_null(F.col(link))
    dealt = F.coalesce(target, F.xxhash64(*records.columns).cast("string"))
    on = (target == F.col("_url")) & (dealt == F.col("_url"))
    if not keep_missing:
        return records.join(right, on).drop("_url")
    return (
        records.join(right, on, "left")
        .drop("_url")
        .withColumn("body", F.coalesce("body", F.lit("")))
    )


def page_summary(pages: DataFrame, html: str = "html") -> DataFrame:
    """Per list page: number of usable items and the first title on it."""
    titles = {"title": rules.LIST_FIELDS["title"]}  # no other field is looked at
    return listed_summary(with_listing(pages, html, titles))


def listed_summary(listed: DataFrame) -> DataFrame:
    """As :func:`page_summary`, of pages parsed by :func:`with_listing`."""
    usable = F.filter("items", lambda i: i["title"].isNotNull())
    return listed.select(
        *[c for c in listed.columns if c != "items"],
        F.size(usable).alias("n"),
        F.coalesce(F.get(usable, F.lit(0))["title"], F.lit("")).alias("first_title"),
    )


def page_progress(
    summary: DataFrame,
    crawl: str = "crawl",
    page_no: str = "page_no",
    width: int = 100_000,
) -> DataFrame:
    """What came before each page of a crawl, in page order.

    Adds ``prev_first_title``, ``rows_before`` and ``empty_before``.  A crawl
    may hold most of all pages, so it is not one window group: pages are taken
    in blocks of ``width`` page numbers, and what lies before a block comes
    from a table with one row per block.  Expects one row per page, with crawl
    and page number set.
    """
    blocked = summary.withColumn("_block", F.call_function("div", F.col(page_no), F.lit(width)))
    keys = [crawl, "_block"]
    totals = blocked.groupBy(*keys).agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") == 0).alias("empties"),
        F.max(F.struct(page_no, "first_title"))["first_title"].alias("title"),
    )
    over_blocks = Window.partitionBy(crawl).orderBy("_block")
    earlier = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        *keys,
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("empties").over(earlier), F.lit(0)).alias("_empties"),
        F.lag("title", 1, "").over(over_blocks).alias("_title"),
    )
    in_block = Window.partitionBy(*keys).orderBy(page_no)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    empty = F.when(F.col("n") == 0, 1).otherwise(0)
    return (
        blocked.withColumns(
            {
                "rows_before": F.coalesce(F.sum("n").over(before), F.lit(0)),
                "empty_before": F.coalesce(F.sum(empty).over(before), F.lit(0)),
                "prev_first_title": F.lag("first_title").over(in_block),
            }
        )
        .join(base, keys, "left")
        .withColumns(
            {
                "rows_before": F.col("rows_before") + F.coalesce("_rows", F.lit(0)),
                "empty_before": F.col("empty_before") + F.coalesce("_empties", F.lit(0)),
                "prev_first_title": F.coalesce("prev_first_title", "_title", F.lit("")),
            }
        )
        .drop("_block", "_rows", "_empties", "_title")
    )


def page_advanced():
    """Whether a page is new: a first title, other than the page before's."""
    return (F.col("first_title") != "") & (F.col("first_title") != F.col("prev_first_title"))


def within_budget(target: int):
    """Whole pages are taken until the rows before reach the target."""
    return F.col("rows_before") < target


def before_empty_page():
    """Pages up to the first empty one."""
    return (F.col("n") > 0) & (F.col("empty_before") == 0)


def pages_to_take(
    progress: DataFrame, target: int | None = None, max_page: int | None = None
) -> DataFrame:
    """Pages up to the first empty one, and up to the caps asked for.

    Nothing about a page depends on later ones, so pages past ``max_page`` are
    better left out before they are parsed.
    """
    out = progress.where(before_empty_page())
    if target is not None:
        out = out.where(within_budget(target))
    return out if max_page is None else out.where(F.col("page_no") <= max_page)


def pages_until_stop(
    pages: DataFrame,
    target: int | None = None,
    max_page: int | None = None,
    crawl: str = "crawl",
    page_no: str = "page_no",
    html: str = "html",
    first_pages: int = 16,
) -> tuple[DataFrame, DataFrame]:
    """(the pages that each crawl takes, parsed; crawl and number of all pages that were parsed).

    A crawl takes its pages in order and stops at the first that is empty, has
    the page before's first title or a blank one (turning the page did not work), lies past ``max_page``, or comes after
    ``target`` rows.  Pages past a stop are not parsed, but for those of one
    block: pages are taken in blocks of numbers, the first of ``first_pages``, each twice as
    wide as all before it, so rounds grow with the logarithm of the longest crawl and at most
    as many pages are parsed in vain as were needed.  Between rounds one row per crawl that
    still runs is kept: its rows so far and its last first title.

    Expects one row per page, with crawl and page number set; a gap in the
    numbers stops nothing.  Each block is stored when it has been parsed, and stays
    in the shared folder for the caller to remove.
    """
    if max_page is not None:
        pages = pages.where(F.col(page_no) <= max_page)
    low, high = pages.agg(F.min(page_no), F.max(page_no)).first()
    running = pages.select(crawl).distinct().withColumns({"_rows": F.lit(0).cast("bigint"), "_title": F.lit(None).cast("string")})
    taken, parsed, width = [], [], first_pages
    while low is not None and low <= high:
        block = pages.where(F.col(page_no).between(low, low + width - 1)).join(running, crawl, "left_semi")
        listed = staged(with_listing(block, html))
        parsed.append(listed.select(crawl, page_no))
        # Narrow: one row a page, a title and a few numbers.
        summary = page_progress(listed_summary(listed).select(crawl, page_no, "n", "first_title"), crawl, page_no)
        known = running.join(listed.groupBy(crawl).agg(F.min(page_no).alias("_first")), crawl)
        before = F.when(F.col(page_no) == F.col("_first"), F.col("_title")).otherwise(F.col("prev_first_title"))
        repeated = F.coalesce(F.col("first_title") == before, F.lit(False)) | (before.isNotNull() & (F.col("first_title") == ""))
        stops = (F.col("n") == 0) | repeated
        if target is not None:
            stops = stops | (F.col("_rows") + F.col("rows_before") >= target)
        state = staged(
            summary.join(known, crawl)
            .withColumn("_stops", stops)
            .groupBy(crawl)
            .agg(
                F.min(F.when(F.col("_stops"), F.col(page_no))).alias("_stop"),
                (F.max("_rows") + F.sum("n")).alias("_rows"),
                F.max(F.struct(page_no, "first_title"))["first_title"].alias("_title"),
            )
        )
        kept = listed.join(state.select(crawl, "_stop"), crawl).where(F.col("_stop").isNull() | (F.col(page_no) < F.col("_stop")))
        taken.append(kept.drop("_stop"))
        # A crawl without pages in this block goes on as it was.
        running = staged(
            running.join(state.select(crawl), crawl, "left_anti").unionByName(state.where("_stop IS NULL").select(crawl, "_rows", "_title"))
        )
        if running.isEmpty():
            break
        low, width = low + width, 2 * width
    if not taken:
        nothing = with_listing(pages, html).limit(0)
        return nothing, nothing.select(crawl, page_no)
    return reduce(DataFrame.unionByName, taken), reduce(DataFrame.unionByName, parsed)
