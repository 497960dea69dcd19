"""Command line: ``python -m docketframe <command>`` or with ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from docketframe import rules, schema
from docketframe.operators import corpus, pages, records
from docketframe.plans import workflow
from docketframe.session import SETTINGS, staged
from docketframe.sources import blocks, sinks, tables
from docketframe.streaming import ingest


def collect(spark: SparkSession, a: argparse.Namespace) -> None:
    """List and detail pages (Parquet) to a part of case records (CSV)."""
    lists, details = (tables.read_pages(spark, p) for p in (a.list_pages, a.detail_pages))
    if a.stop:
        crawl = lists.selectExpr("0 AS crawl", "page_id AS page_no", "html")
        cases = workflow.collect_until_stop(crawl, details, a.target, a.max_page, a.base)
    else:
        cases = workflow.collect(lists, details, target=a.target, base=a.base)
    sinks.write_cases(cases, a.out, bom=True)


def ingest_details(spark: SparkSession, a: argparse.Namespace) -> None:
    """Detail pages that are new since the last run, with their bodies."""
    stream = ingest.file_stream(spark, a.detail_pages, schema.PAGE, files_per_batch=a.files_per_batch)
    query = ingest.append(
        stream, a.out, a.checkpoint, lambda df: ingest.with_progress(pages.page_bodies(df))
    )
    query.awaitTermination()


def post_process(spark: SparkSession, a: argparse.Namespace) -> None:
    """CSV parts to the merged, cleaned, numbered and reviewed tables."""
    read = blocks.read_part_blocks if a.blocks else tables.read_part
    parts = [read(spark, p) for p in a.parts]
    workflow.post_process(parts, a.out).show(truncate=False)


def parse(spark: SparkSession, a: argparse.Namespace) -> None:
    """A CSV part to parsed records (Parquet) with typed companions."""
    parsed = staged(records.with_typed_fields(records.parse_records(tables.read_part(spark, a.part))), a.out)
    corpus.success_counts(parsed).show()


def preview(spark: SparkSession, a: argparse.Namespace) -> None:
    """The first rows of a review table (CSV)."""
    corpus.preview(tables.read_part(spark, a.review, schema.REVIEW_CSV), a.rows).show(truncate=False)


def verify(spark: SparkSession, a: argparse.Namespace) -> None:
    """Row counts and contents of two review tables (CSV)."""
    one, two = (tables.read_part(spark, p, schema.REVIEW_CSV) for p in (a.source, a.written))
    workflow.verify_written(one, two).show()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docketframe")
    commands = top.add_subparsers(required=True)

    def command(function, *paths: str) -> argparse.ArgumentParser:
        name = function.__name__.replace("_", "-")
        sub = commands.add_parser(name, help=function.__doc__)
        for path in paths:
            sub.add_argument(path)
        sub.set_defaults(run=function)
        return sub

    sub = command(collect, "list_pages", "detail_pages", "out")
    sub.add_argument("--target", type=int, help="all if not given")
    sub.add_argument("--stop", action="store_true", help="take the list pages as one crawl, in order, and stop it as a live one is")
    sub.add_argument("--max-page", type=int, help="with --stop: the last page")
    sub.add_argument("--base", default=rules.SITE_BASE)
    sub = command(ingest_details, "detail_pages", "out", "checkpoint")
    sub.add_argument("--files-per-batch", type=int)
    sub = command(post_process, "out")
    sub.add_argument("parts", nargs="+")
    sub.add_argument("--blocks", action="store_true", help="read each file by many tasks; quotes must be as CSV writers set them")
    command(parse, "part", "out")
    sub = command(preview, "review")
    sub.add_argument("--rows", type=int, default=3)
    command(verify, "source", "written")
    return top


def main(argv: list[str] | None = None) -> None:
    arguments = parser().parse_args(argv)
    builder = SparkSession.builder.appName("docketframe")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    arguments.run(builder.getOrCreate(), arguments)


if __name__ == "__main__":
    main()
