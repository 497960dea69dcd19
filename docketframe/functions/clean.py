"""Line cleaning of document bodies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.functions.text import bind, hits, strip


def is_noise(line: Column, patterns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [hits(line, p) for p in patterns])


def stripped_lines(body: Column) -> Column:
    return F.transform(F.split(F.coalesce(body, F.lit("")), "\n", -1), strip)


def clean_content(
    body: Column,
    noise: Sequence[str] = rules.NOISE_PATTERNS,
    min_line: int = rules.MIN_LINE,
) -> Column:
    """Drop furniture and very short lines, then collapse adjacent repeats.

    Repeats are looked for after the noise is gone, so copies that only a
    dropped line kept apart collapse too.  NULL gives ''.
    """

    def keep(line: Column) -> Column:
        long_enough = F.length(line) > min_line
        return long_enough & ~is_noise(line, noise) if noise else long_enough

    def collapse(lines: Column) -> Column:
        return F.filter(lines, lambda x, i: (i == 0) | (x != F.get(lines, i - 1)))

    kept = F.filter(stripped_lines(body), keep)
    return bind(kept, lambda lines: F.array_join(collapse(lines), "\n"))


def flatten_body(body: Column) -> Column:
    """All non-empty lines, stripped, on one line."""
    return F.array_join(F.filter(stripped_lines(body), lambda x: x != ""), " ")


def is_blank(body: Column) -> Column:
    return F.length(strip(F.coalesce(body, F.lit("")))) == 0


def is_short(body: Column, limit: int = rules.SHORT_BODY) -> Column:
    return F.length(F.coalesce(body, F.lit(""))) <= limit
