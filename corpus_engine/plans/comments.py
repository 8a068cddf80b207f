"""Comment collection: capped rows and one status per attempted video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine.functions.status import comment_outcome
from corpus_engine.operators.ordering import ARRIVAL, cut_at_first
from corpus_engine.sources.pages import failed_reply_pages, failed_thread_pages


def comment_statuses(
    attempts: DataFrame, comments: DataFrame, captured_at: Column
) -> DataFrame:
    """Outcome of every attempted video.

    ``attempts`` holds ``video_id``, ``error_type`` and ``error_message`` (null without error) and
    the arrival columns; rows collected before an error still count. Where comments tell their run, an
    attempt counts those of its own run only.
    """
    attempt = [c for c in ("_run_id", "video_id") if c in comments.columns]
    collected = comments.groupBy(*attempt).agg(F.count(F.lit(1)).alias("rows_collected"))
    joined = attempts.join(collected, attempt, "left").withColumn(
        "rows_collected", F.coalesce("rows_collected", F.lit(0)))
    return joined.select(
        "video_id",
        comment_outcome(F.col("error_message"), F.col("rows_collected")).alias("status"),
        "rows_collected",
        "error_type",
        "error_message",
        captured_at.alias("captured_at"),
        *[c for c in ARRIVAL if c in attempts.columns],
    )


def cut_statuses_at_quota(statuses: DataFrame, run_key: str = "_run_id", seq: str = "_seq") -> DataFrame:
    """Each run ends with its first quota failure, which stays."""
    return cut_at_first(statuses, run_key, seq, F.col("status") == "quota_exceeded", inclusive=True)


def thread_attempts(attempted: DataFrame, threads: DataFrame, replies: DataFrame) -> DataFrame:
    """Attempted videos of each run with the first error among their thread and reply pages of that run.

    A failed page that landed again and could be read is no error.
    """
    parts = ["run_id", "video_id", "seq", "error"]
    failed = failed_thread_pages(threads).select(*parts).unionByName(failed_reply_pages(replies).select(*parts))
    first = F.min(F.struct("seq", "error")).alias("_first")
    errors = failed.groupBy(F.col("run_id").alias("_run_id"), "video_id").agg(first).select(
        "_run_id", "video_id", F.lit("HttpError").alias("error_type"), F.col("_first.error").alias("error_message"))
    return attempted.join(errors, ["_run_id", "video_id"], "left")
