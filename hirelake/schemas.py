"""Schema constants for landing documents, postings and derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# One posting as every site normaliser emits it (16 business columns).
POSTING_FIELDS = [
    ("job_id", S),
    ("platform", S),
    ("category", S),
    ("url", S),
    ("company", S),
    ("title", S),
    ("primary_responsibility", S),
    ("required", S),
    ("preferred", S),
    ("end_at", S),
    ("skills", T.ArrayType(S)),
    ("location", S),
    ("welfare", S),
    ("body", S),
    ("company_description", S),
    ("coordinate", T.ArrayType(T.DoubleType())),
]
POSTING_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in POSTING_FIELDS])
POSTING_COLUMNS = [n for n, _ in POSTING_FIELDS]

# Landing document: an array of postings under "results" (older files: "result").
# job_id is read as string so integer and string ids land in one column.
LANDING_SCHEMA = T.StructType([
    T.StructField("results", T.ArrayType(POSTING_SCHEMA), True),
    T.StructField("result", T.ArrayType(POSTING_SCHEMA), True),
])

DAY_PARTS = ["year", "month", "day"]

# Column order of the cleaned table (first stage output).
CLEANED_COLUMNS = [
    "year", "month", "day",
    "job_id", "platform", "category", "major_category", "middle_category",
    "sub_category", "company", "title", "preferred", "required", "primary_responsibility",
    "url", "end_at", "skills", "location", "welfare", "body", "company_description", "coordinate",
]

# Free-text columns whose newlines become spaces in the first stage.
TEXT_COLUMNS = ["preferred", "required", "primary_responsibility", "welfare", "company_description"]

# Columns that get term arrays in the second stage, and the five of the
# exploratory report.
TERM_SOURCE_COLUMNS = ["preferred", "required", "primary_responsibility", "welfare"]
EDA_TERM_COLUMNS = ["required", "primary_responsibility", "preferred", "welfare", "company_description"]
TERM_KINDS = ["korean", "english"]


def term_column(source: str, kind: str) -> str:
    return f"{source}_{kind}_nouns"


ENRICHED_TERM_COLUMNS = [term_column(c, k) for k in TERM_KINDS for c in TERM_SOURCE_COLUMNS]
ENRICHED_COLUMNS = CLEANED_COLUMNS + ENRICHED_TERM_COLUMNS

# daily_jd_table / unique_jds
DAILY_COLUMNS = ["year", "month", "day", "date_str", "platform", "job_id", "company", "title",
                 "major_category", "middle_category", "sub_category"]
UNIQUE_JD_COLUMNS = ["platform", "job_id", "title", "company", "major_category",
                     "middle_category", "sub_category"]
