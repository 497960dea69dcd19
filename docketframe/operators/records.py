"""Parsing bodies into records, and the export projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketframe import rules, schema
from docketframe.functions import fields
from docketframe.functions.clean import flatten_body
from docketframe.functions.text import blank_to_null, cn_to_num, find_or_null


def parse_records(df: DataFrame, body: str = "body", reason: str = rules.CASE_REASON) -> DataFrame:
    """Add the parsed fields; fill case number, court and date where empty.

    Rows without text come back as they are, with NULL in the new columns.
    One narrow projection: nothing is shuffled.
    """
    text = F.col(body)
    has_text = blank_to_null(text).isNotNull()

    def parsed(c: Column) -> Column:
        return F.when(has_text, c)

    def filled(name: str, rule: Column) -> Column:
        given = F.col(name) if name in df.columns else F.lit(None).cast("string")
        return F.coalesce(blank_to_null(given), F.when(has_text, rule), given)

    return df.withColumns(
        {
            "case_no": filled("case_no", fields.case_no(text)),
            "court": filled("court", fields.court(text)),
            "date": filled("date", fields.decision_date(text)),
            "case_reason": parsed(fields.case_reason(reason)),
            "defendant_gender": parsed(fields.gender(text)),
            "injury_level": parsed(fields.injury_level(text)),
            "compensation": parsed(fields.compensation(text)),
            "sentence": parsed(fields.sentence(text)),
            "verdict": parsed(fields.verdict(text)),
            "trial_procedure": parsed(fields.trial_procedure(text)),
        }
    )


def with_typed_fields(df: DataFrame) -> DataFrame:
    """Typed companions of the text fields; NULL where the text has no value or one too large."""

    def number(pattern: str) -> Column:
        return cn_to_num(find_or_null(F.col("sentence"), pattern, 1)).try_cast("int")

    months = number(rules.TERM_MONTHS)
    years = number(r"^(\d+)年")
    return df.withColumns(
        {
            "decision_date": F.try_to_date("date"),
            "compensation_amount": F.regexp_replace("compensation", "元$", "").try_cast(
                "decimal(18,2)"
            ),
            "sentence_months": F.when(
                years.isNotNull() | months.isNotNull(),
                F.try_add(F.try_multiply(F.coalesce(years, F.lit(0)), F.lit(12)), F.coalesce(months, F.lit(0))),
            ),
            "probation_years": number(rules.PROBATION_YEARS),
        }
    )


def as_review(df: DataFrame) -> DataFrame:
    """Parsed records under the engine names of the review table."""
    return df.withColumnRenamed("defendant_gender", "gender")


def export_table(df: DataFrame, columns: list[str] = schema.REVIEW_COLUMNS) -> DataFrame:
    """Fixed columns in fixed order under their headers; missing values are ''."""
    return df.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(schema.HEADER_OF[c])
            if c in df.columns
            else F.lit("").alias(schema.HEADER_OF[c])
            for c in columns
        ]
    )


def flattened(df: DataFrame, body: str = "body") -> DataFrame:
    """Bodies on one line each.  Clean before: a flattened body is one line,
    and one noise word would drop it whole."""
    return df.withColumn(body, flatten_body(F.col(body)))


def report_block(seq: Column) -> Column:
    """One record of the text report (its last line end is the writer's)."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))

    return F.concat(
        F.lit("【案件 "), seq.cast("string"), F.lit("】"), shown("title"),
        F.lit("\n法院："), shown("court"),
        F.lit("\n案号："), shown("case_no"),
        F.lit("\n日期："), shown("date"),
        F.lit("\n\n"), shown("body"),
        F.lit("\n\n"), F.repeat(F.lit("="), F.lit(60)), F.lit("\n"),
    )


def text_report(df: DataFrame, seq: str = "seq") -> DataFrame:
    return df.select(F.col(seq), report_block(F.col(seq)).alias("value"))
