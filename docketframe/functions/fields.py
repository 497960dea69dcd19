"""Field rules: each takes the body column and returns one string column.

A missing value is ``''``.  All are narrow, row-wise built-in expressions, so
a whole record is parsed in one projection, in batch and in streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketframe import rules
from docketframe.functions.text import (
    ascii_digits,
    bind,
    clean_ws,
    contains_any,
    find,
    find_all,
    find_or_null,
    fixed2,
    numeral_text,
    numeral_texts,
)


def first_hit(text: Column, patterns: Sequence[str], group: int) -> Column:
    """The first pattern that hits anywhere wins; later ones are not tried."""
    return F.coalesce(*[find_or_null(text, p, group) for p in patterns], F.lit(""))


def labelled(text: Column, cascade: Sequence[tuple[str, list[str]]], otherwise: str) -> Column:
    """Label of the first word group of which any word occurs."""
    (label, words), *rest = cascade
    out = F.when(contains_any(text, words), label)
    for label, words in rest:
        out = out.when(contains_any(text, words), label)
    return out.otherwise(otherwise)


def head(body: Column, window: int | None) -> Column:
    """The first code points of a body; all of it for None."""
    return body if window is None else F.left(body, F.lit(window))


def case_no(body: Column, pattern: str = rules.CASE_NO) -> Column:
    return find(body, pattern)


def court(
    body: Column, patterns: Sequence[str] = rules.COURTS, window: int | None = rules.COURT_WINDOW
) -> Column:
    return first_hit(head(body, window), patterns, 1)


def decision_date(
    body: Column, patterns: Sequence[str] = rules.DATES, window: int | None = rules.DATE_WINDOW
) -> Column:
    """Last date near the end of the text (``window`` None: anywhere), as ``YYYY-MM-DD`` text."""

    def last(tail: Column, pattern: str) -> Column:
        def iso(hit: Column) -> Column:
            day = [F.lpad(find(hit, pattern, g), 2, "0") for g in (2, 3)]
            return F.concat_ws("-", find(hit, pattern, 1), *day)

        found = F.slice(find_all(tail, pattern), -1, 1)
        return F.get(F.transform(found, iso), F.lit(0))

    return bind(
        body if window is None else F.right(body, F.lit(window)),
        lambda tail: F.coalesce(*[last(tail, p) for p in patterns], F.lit("")),
    )


def case_reason(value: str = rules.CASE_REASON) -> Column:
    """A constant: the corpus is one search, and every rule path returns it."""
    return F.lit(value)


def gender(
    body: Column, patterns: Sequence[str] = rules.GENDERS, window: int | None = rules.GENDER_WINDOW
) -> Column:
    return first_hit(head(body, window), patterns, 1)


Cascade = Sequence[tuple[str, list[str]]]


def injury_level(body: Column, levels: Cascade = rules.INJURY_LEVELS) -> Column:
    return labelled(body, levels, "")


def trial_procedure(
    body: Column,
    procedures: Cascade = rules.PROCEDURES,
    otherwise: str = rules.FIRST_INSTANCE,
    window: int | None = rules.PROCEDURE_WINDOW,
) -> Column:
    return labelled(head(body, window), procedures, otherwise)


def amounts(body: Column, patterns: Sequence[str] = rules.AMOUNTS) -> Column:
    """All amounts of a body in yuan, as an array of doubles.

    The patterns are searched one by one: in a joint alternation a long hit of
    one would swallow a hit of another.  The unit is read behind the first
    place where the digits of the amount occur in the text.
    """
    found = F.concat(*[find_all(body, p, 1) for p in patterns])

    def in_yuan(digits: Column) -> Column:
        near = F.substring(body, F.position(digits, body), F.lit(rules.UNIT_WINDOW))
        factor = F.when(F.contains(near, F.lit("万元")), 10000.0).otherwise(1.0)
        return ascii_digits(digits).cast("double") * factor

    return F.transform(found, in_yuan)


def compensation(body: Column, patterns: Sequence[str] = rules.AMOUNTS) -> Column:
    """The largest amount, as text with two decimals and the unit."""
    return bind(
        F.array_max(amounts(body, patterns)),
        lambda top: F.coalesce(F.concat(fixed2(top), F.lit("元")), F.lit("")),
    )


def prison_terms(body: Column, patterns: Sequence[str] = rules.PRISON_TERMS) -> Column:
    """Array of readable terms, in the order the patterns find them."""
    clauses = F.concat(*[find_all(body, p, 1) for p in patterns])

    def read(clause: Column) -> Column:
        """Years, months and years on probation, NULL where not given."""
        rule = (rules.TERM_YEARS, rules.TERM_MONTHS, rules.PROBATION_YEARS)
        return numeral_texts(*[find_or_null(clause, p, 1) for p in rule])

    def part(number: Column, before: str, after: str) -> Column:
        return F.coalesce(F.concat(F.lit(before), number, F.lit(after)), F.lit(""))

    def show(numbers: Column) -> Column:
        years, months = (F.nullif(numbers[i], F.lit("0")) for i in (0, 1))
        term = F.concat(part(years, "", "年"), part(months, "", "个月"))
        return F.when(term != "", F.concat(term, part(numbers[2], "（缓刑", "年）")))

    terms = F.transform(F.transform(clauses, read), show)
    return F.filter(terms, lambda t: t.isNotNull())


def sentence(body: Column, patterns: Sequence[str] = rules.PRISON_TERMS) -> Column:
    """First prison term, else detention, else exemption."""
    detention = numeral_text(find_or_null(body, rules.DETENTION_MONTHS, 1))
    return F.coalesce(
        # One by one: a pattern is searched for only where those before it give no term.
        *[F.get(prison_terms(body, [p]), F.lit(0)) for p in patterns],
        F.concat(F.lit("拘役"), detention, F.lit("个月")),
        F.when(F.contains(body, F.lit(rules.EXEMPTION)), rules.EXEMPTION),
        F.lit(""),
    )


def verdict(
    body: Column, pattern: str = rules.VERDICT, limit: int | None = rules.VERDICT_LIMIT
) -> Column:
    """Operative part; cut first (``limit`` None: not at all), white space collapsed after."""
    if limit is None:
        return clean_ws(find(body, pattern, 1))
    return bind(
        find(body, pattern, 1),
        lambda v: clean_ws(
            F.when(F.length(v) > limit, F.concat(F.left(v, F.lit(limit)), F.lit("..."))).otherwise(v)
        ),
    )
