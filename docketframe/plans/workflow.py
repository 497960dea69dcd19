"""The end-to-end flows: collect, post-process, review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.operators import corpus, pages, records
from docketframe.session import staged
from docketframe.sources import sinks


def collect(
    list_pages: DataFrame,
    detail_pages: DataFrame,
    target: int | None = None,
    base: str | None = rules.SITE_BASE,
    order_by: Sequence[str] = ("page_id", "list_index"),
    one_snapshot_per_url: bool = False,
    stage_path: str | None = None,
) -> DataFrame:
    """List pages and detail pages to numbered case records.

    All records, unless ``target`` caps them.  A cap is applied before numbering
    (top-k in every task), and only pages that the rows link to are shuffled and
    parsed.  Say ``one_snapshot_per_url`` if
    that is so; it saves finding the first snapshot of each.
    """
    listed = pages.list_records(list_pages, base=base)
    if target is not None:
        listed = listed.orderBy(*order_by).limit(target)
    # Stored first: the range partitioning reads its input twice.
    numbered = corpus.number_rows(staged(listed, stage_path), order_by)
    return _with_bodies(numbered, detail_pages, target is not None, one_snapshot_per_url)


def collect_until_stop(
    list_pages: DataFrame,
    detail_pages: DataFrame,
    target: int | None = rules.TARGET_COUNT,
    max_page: int | None = rules.MAX_PAGE,
    base: str | None = rules.SITE_BASE,
    crawl: str = "crawl",
    page_no: str = "page_no",
    one_snapshot_per_url: bool = False,
    stage_path: str | None = None,
) -> DataFrame:
    """As :func:`collect`, with each crawl stopped as a live one is.

    A crawl ends at its first empty page, at a page that did not turn, past ``max_page``, and
    when it has ``target`` rows at the end of a page (:func:`pages.pages_until_stop`).
    Neither list pages far past a stop nor detail pages that no taken row opens are
    parsed.  Rows are numbered by crawl, page and place on it.
    """
    taken, _ = pages.pages_until_stop(list_pages, target, max_page, crawl, page_no)
    listed = pages.listed_records(taken, base=base)
    numbered = corpus.number_rows(listed, [crawl, page_no, "list_index"], stage_path=stage_path)
    return _with_bodies(numbered, detail_pages, True, one_snapshot_per_url)


def _with_bodies(numbered: DataFrame, detail_pages: DataFrame, few: bool, one_snapshot_per_url: bool) -> DataFrame:
    """Case records from numbered list records and the pages they open; ``few`` of all pages, or most."""
    if few:
        wanted = numbered.select(F.col("open_link").alias("url"))
        detail_pages = detail_pages.join(wanted, "url", "left_semi")
    if not one_snapshot_per_url:
        detail_pages = pages.one_page_per_url(detail_pages)
    return pages.attach_bodies(
        numbered, pages.page_bodies(detail_pages), link="open_link"
    ).select("seq", "title", "court", "case_no", "date", "link", "body")


def post_process(
    parts: Sequence[DataFrame],
    out: str,
    noise: Sequence[str] = rules.NOISE_PATTERNS,
    compression: str | None = "gzip",
) -> DataFrame:
    """Merge, clean and number parts; write all tables; return the counts.

    The bodies are written five times, so the text outputs are compressed (``compression`` None: plain files).

    Cleaning and parsing are done once, in the pass that stores the ordered
    table; every output reads its columns from that.  The merged table and the
    text report hold case number, court and date as they were collected; only
    the review has them filled from the text.
    """
    cases = corpus.merge_and_clean(*parts, noise=noise, then=parsed_beside, stage_path=f"{out}/stage", place=PLACE)
    sinks.write_cases(cases, f"{out}/cases_csv", compression=compression)
    sinks.write_text_report(cases, f"{out}/cases_text", place=PLACE, compression=compression)
    reviewed = review(cases)
    sinks.write_flattened(reviewed, f"{out}/review_csv", compression=compression)
    sinks.write_review(reviewed, f"{out}/review")
    return corpus.corpus_stats(cases)


FILLED = ["case_no", "court", "date"]
PLACE = "_place"


def parsed_beside(cases: DataFrame) -> DataFrame:
    """Parsed fields next to the collected ones, which keep their names."""
    given = cases.withColumnsRenamed({c: f"given_{c}" for c in FILLED})
    parsed = records.parse_records(given.withColumns({c: F.col(f"given_{c}") for c in FILLED}))
    return parsed.withColumnsRenamed({c: f"parsed_{c}" for c in FILLED}).withColumnsRenamed(
        {f"given_{c}": c for c in FILLED}
    )


def review(cases: DataFrame) -> DataFrame:
    """The review table's columns of cases stored with :func:`parsed_beside`."""
    filled = cases.drop(*FILLED).withColumnsRenamed({f"parsed_{c}": c for c in FILLED})
    return records.as_review(filled)


def verify_written(source: DataFrame, written: DataFrame) -> DataFrame:
    """Rows and contents of a table against what was read back."""
    columns = source.columns
    return corpus.reconcile(
        source.select(*columns), written.select(*[F.col(c) for c in columns])
    )
