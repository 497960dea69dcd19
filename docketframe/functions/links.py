"""Links, hosts and file keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.functions.text import blank_to_null


def absolute_link(
    link: Column, base: str = rules.SITE_BASE, parent_prefix: str = rules.PARENT_PREFIX
) -> Column:
    """``http…`` stays, ``../x`` and ``/x`` get the site base, others stay."""
    link = F.coalesce(link, F.lit(""))
    return (
        F.when(F.startswith(link, F.lit("http")), link)
        .when(
            F.startswith(link, F.lit("../")),
            F.concat(F.lit(base + parent_prefix), F.substr(link, F.lit(4))),
        )
        .when(F.startswith(link, F.lit("/")), F.concat(F.lit(base), link))
        .otherwise(link)
    )


def file_key(case_no: Column, index: Column) -> Column:
    """A name free of path characters; the position stands in for a missing one."""
    named = F.translate(F.coalesce(case_no, F.lit("")), "/\\:", "___")
    return F.coalesce(blank_to_null(named), F.concat(F.lit("case_"), index.cast("string")))


def host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def on_site(url: Column, expected: str) -> Column:
    """Whether the URL mentions the expected host."""
    return F.contains(url, F.lit(expected))
