"""Table schemas and the mapping between engine names and export headers."""

from __future__ import annotations

from pyspark.sql import types as T

from docketframe.rules import CASE_HEADERS, REVIEW_HEADERS

CASE_COLUMNS = ["seq", "title", "court", "case_no", "date", "link", "body"]
REVIEW_COLUMNS = ["seq", "title", "court", "case_no", "date", "gender", "verdict", "link", "body"]
PARSED_COLUMNS = [
    "case_reason", "defendant_gender", "injury_level", "compensation", "sentence", "verdict",
    "trial_procedure",
]

HEADER_OF = dict(zip(CASE_COLUMNS, CASE_HEADERS)) | dict(zip(REVIEW_COLUMNS, REVIEW_HEADERS))
COLUMN_OF = {header: column for column, header in HEADER_OF.items()}


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# A part file as it lies on disk: every CSV value is text.
CASE_CSV = strings(CASE_HEADERS)
REVIEW_CSV = strings(REVIEW_HEADERS)

CASE = T.StructType(
    [T.StructField("seq", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in CASE_COLUMNS[1:]]
)
PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
DETAIL = T.StructType(
    [T.StructField("index", T.IntegerType()), T.StructField("list_index", T.IntegerType())]
    + [
        T.StructField(n, T.StringType())
        for n in (
            "title", "link", "case_no", "court", "date", "case_type",
            "full_text", "html_content", "detail_url",
        )
    ]
)
