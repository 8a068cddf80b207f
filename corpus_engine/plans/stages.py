"""The stages of a study as plain frames: what is pending, what landed for it, the next table version.

:mod:`corpus_engine.plans.study` reads, settles and writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.functions.status import FINISHED_COMMENT_STATUSES
from corpus_engine.operators.ordering import ARRIVAL, first_seen, replace_rows
from corpus_engine.operators.resume import conform, pending, refresh_columns
from corpus_engine.plans.comments import comment_statuses, cut_statuses_at_quota, thread_attempts
from corpus_engine.plans.transcripts import transcript_rows, transcript_segments
from corpus_engine.sources.pages import flatten_channel_pages, flatten_video_pages

TRANSCRIPT_COLUMNS = schemas.TRANSCRIPTS.fieldNames()[1:]


def pending_videos(seen: DataFrame, videos: DataFrame, resume: bool = True, bits: DataFrame | None = None) -> DataFrame:
    """Discovered videos (one row each, see :func:`first_seen`) that are not stored yet."""
    return pending(seen, videos, "video_id", resume=resume, bits=bits)


def pending_channels(videos: DataFrame, channels: DataFrame, resume: bool = True, bits: DataFrame | None = None) -> DataFrame:
    """Channels of stored videos that are not stored yet."""
    return pending(first_seen(videos, "channel_id"), channels, "channel_id", resume=resume, bits=bits)


def pending_transcripts(
    videos: DataFrame, transcripts: DataFrame, retry_failed: bool = True, resume: bool = True
) -> DataFrame:
    """Videos without a transcript row, or without a successful one when failures are retried."""
    done = F.col("transcript_status") == "success" if retry_failed else None
    return pending(videos.select("video_id"), transcripts, "video_id", done, resume)


def pending_comments(videos: DataFrame, statuses: DataFrame, resume: bool = True) -> DataFrame:
    """Videos whose comment collection has not ended for good."""
    done = F.col("status").isin(FINISHED_COMMENT_STATUSES)
    return pending(videos.select("video_id"), statuses, "video_id", done, resume)


def wanted(rows: DataFrame, todo: DataFrame, key: str) -> DataFrame:
    """Rows whose key was asked for."""
    return rows.join(todo.select(key), key, "left_semi")


def video_rows(todo: DataFrame, pages: DataFrame, captured_at: str) -> DataFrame:
    """Details of pending videos among the landed pages."""
    return wanted(flatten_video_pages(pages, F.lit(captured_at)), todo, "video_id")


def channel_rows(todo: DataFrame, pages: DataFrame, captured_at: str) -> DataFrame:
    """Details of pending channels among the landed pages."""
    return wanted(flatten_channel_pages(pages, F.lit(captured_at)), todo, "channel_id")


def transcript_tables(resolved: DataFrame, captured_at: str) -> dict[str, DataFrame]:
    """Transcript rows and segments of a resolved cascade, one row per key and run."""
    stamp = {"_run_id": F.lit(None).cast("string"), "_seq": F.lit(None).cast(schemas.SEQ)}
    return {
        "transcripts": transcript_rows(resolved, F.lit(captured_at)).withColumns(stamp),
        "transcript_segments": transcript_segments(resolved).withColumns(stamp),
    }


def comment_outcomes(
    threads: DataFrame, replies: DataFrame, rows: DataFrame, captured_at: str, stop_on_quota: bool = True
) -> DataFrame:
    """Outcomes of the videos whose thread pages landed, one for each run that tried; ``rows`` are those pages' comments.

    With ``stop_on_quota`` a run ends with its first quota failure: later videos have no outcome,
    and their comments are not kept.
    """
    attempted = threads.groupBy(F.col("run_id").alias("_run_id"), "video_id").agg(F.min("seq").alias("_seq"))
    outcome = comment_statuses(thread_attempts(attempted, threads, replies), rows, F.lit(captured_at))
    return cut_statuses_at_quota(outcome) if stop_on_quota else outcome


def with_transcripts(videos: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Videos with the transcript columns of the published state table; typed nulls where there is none."""
    base = conform(videos, schemas.VIDEOS, ARRIVAL)
    return conform(
        refresh_columns(base, transcripts, "video_id", TRANSCRIPT_COLUMNS, unique=True), schemas.VIDEOS, ARRIVAL)


def upserted(existing: DataFrame, new: DataFrame, table: str) -> DataFrame:
    """A table's next version; published tables are unique per key and older than what arrives."""
    schema, keys, _ = schemas.TABLES[table]
    return replace_rows(conform(existing, schema, ARRIVAL), conform(new, schema, ARRIVAL), keys)
