"""Reading outcomes out of error messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome names and the message fragments that reveal them, first match wins.
COMMENT_OUTCOMES = [
    ("commentsdisabled", "comments_disabled"),
    ("videonotfound", "video_not_found"),
    ("quota", "quota_exceeded"),
]
FINISHED_COMMENT_STATUSES = ["completed", "no_comments", "comments_disabled", "video_not_found"]
QUOTA_FRAGMENTS = ["quota", "dailylimit"]


def comment_outcome(error: Column, rows: Column) -> Column:
    """Status of one video's comment collection from its error text and row count."""
    lowered = F.lower(error)
    outcome = F.when(error.isNull(), F.when(rows > 0, F.lit("completed")).otherwise(F.lit("no_comments")))
    for fragment, status in COMMENT_OUTCOMES:
        outcome = outcome.when(F.contains(lowered, F.lit(fragment)), F.lit(status))
    return outcome.otherwise(F.lit("error"))


def is_quota_error(error: Column) -> Column:
    lowered = F.lower(error)
    hits = [F.contains(lowered, F.lit(fragment)) for fragment in QUOTA_FRAGMENTS]
    return F.coalesce(hits[0] | hits[1], F.lit(False))
