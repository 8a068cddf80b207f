"""Queries of the streams that remember the newest row of each key, with their SQL.

Each lands the pages of three runs in three steps: the second run first, then the first one (late) and the second once more, then
the third and the first once more. The stream is started anew for each step and takes about a run's files a batch. Each task of a landing
writes a file, so more pages are more tasks, and no more batches. Packed landings are compressed, and go when the step has taken them in.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import study_tables as st
from checks.oracle import COMMENTS, VIDEO_ROWS
from corpus_engine.session import scratch_path
from corpus_engine.sources.tables import drop
from corpus_engine.streaming.keyed import keep_newest, newest_rows

STEPS = (("r2",), ("r1", "r2"), ("r3", "r1"))
RUNS = {"r1": "seq % 2 = 0", "r2": "seq % 3 <> 0", "r3": "seq % 5 = 0"}


def _taken_in(spark: SparkSession, kind: str, pages: DataFrame, marked: str, packed: bool = False) -> DataFrame:
    """The newest rows after all steps; ``marked`` is the JSON field that tells the run."""
    root, before = scratch_path(spark, f"keyed-{kind}"), 0
    for step in STEPS:
        for run in step:
            named = pages.where(RUNS[run]).withColumn("run_id", F.lit(run))
            if "response" in pages.columns:
                named = named.withColumn("response", F.replace("response", F.lit(f'"{marked}":"'), F.lit(f'"{marked}":"{run} ')))
            named.write.mode("append").option("compression", "gzip" if packed else "none").json(f"{root}/landing")
        landed = len(spark.read.text(f"{root}/landing").inputFiles())
        keep_newest(
            spark, f"{root}/landing", kind, f"{root}/{kind}", f"{root}/checkpoint", F.col("run_id"),
            files_per_batch=max(1, ceil((landed - before) / len(step)))).awaitTermination()
        before = landed
        if packed:
            drop(spark, f"{root}/landing")
            before = 0
    return newest_rows(spark, f"{root}/{kind}", kind)


def stream_newest_videos(spark: SparkSession, sf: str) -> DataFrame:
    return _taken_in(spark, "videos", st.video_pages(spark, sf), "title").select(
        "video_id", "title", "view_count", "duration_seconds", F.to_json("tags").alias("tags"), "captured_at")


def stream_newest_channels(spark: SparkSession, sf: str) -> DataFrame:
    return _taken_in(spark, "channels", st.channel_pages(spark, sf), "title").select(
        "channel_id", "channel_title", "country", "subscriber_count", "uploads_playlist_id", "captured_at")


def stream_newest_threads(spark: SparkSession, sf: str) -> DataFrame:
    return _taken_in(spark, "threads", st.thread_pages(spark, sf), "textDisplay", packed=True).select(
        "comment_id", "video_id", "thread_id", "text", "like_count", "total_reply_count", "captured_at")


def stream_newest_replies(spark: SparkSession, sf: str) -> DataFrame:
    return _taken_in(spark, "replies", st.reply_pages(spark, sf), "textOriginal", packed=True).select(
        "comment_id", "video_id", "thread_id", "parent_comment_id", "text", "like_count", "captured_at")


def stream_newest_captions(spark: SparkSession, sf: str) -> DataFrame:
    tracks = st.caption_tracks(spark, sf).withColumn("seq", F.col("doc_id")).drop("doc_id")
    rows = _taken_in(spark, "captions", tracks, "")
    return rows.select("video_id", "language", "is_generated", "list_pos", F.size("captions").cast("bigint").alias("n_pieces"),
                       F.col("captions")[0]["text"].alias("first_line"), "captured_at")


QUERIES = {f.__name__: f for f in (stream_newest_videos, stream_newest_channels, stream_newest_threads, stream_newest_replies, stream_newest_captions)}


def _run(seq: str) -> str:
    return f"CASE WHEN {seq} % 5 = 0 THEN 'r3' WHEN {seq} % 3 <> 0 THEN 'r2' WHEN {seq} % 2 = 0 THEN 'r1' END"


ORACLE = {
    "stream_newest_videos": f"""WITH {VIDEO_ROWS}, runs AS (SELECT *, {_run("CAST(replace(video_id, 'x', '') AS BIGINT)")} AS run FROM rows)
        SELECT video_id, run || ' ' || title AS title, view_count, duration_seconds, tags, run AS captured_at FROM runs WHERE run IS NOT NULL""",
    "stream_newest_channels": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS channel_id, {_run("s_suppkey")} || ' ' || s_name AS channel_title, n_name AS country,
               CAST(floor(abs(s_acctbal)) AS BIGINT) AS subscriber_count, CASE WHEN s_acctbal >= 0 THEN 'UU' || s_suppkey END AS uploads_playlist_id,
               {_run("s_suppkey")} AS captured_at
        FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE {_run("s_suppkey")} IS NOT NULL""",
    "stream_newest_threads": f"""WITH {COMMENTS}, runs AS (SELECT *, {_run("doc_id")} AS run FROM tops)
        SELECT comment_id, video_id, thread_id, run || ' ' || text AS text, like_count, total_reply_count, run AS captured_at FROM runs WHERE run IS NOT NULL""",
    "stream_newest_replies": f"""WITH {COMMENTS}, runs AS (SELECT *, {_run("doc_id")} AS run FROM answers)
        SELECT comment_id, video_id, thread_id, parent_comment_id, run || ' ' || text AS text, like_count, run AS captured_at FROM runs WHERE run IS NOT NULL""",
    "stream_newest_captions": f"""WITH runs AS (
          SELECT 'v' || (doc_id // 4) AS video_id, lang AS language, n_chars % 2 = 1 AS is_generated, doc_id AS list_pos, string_split(text, chr(10)) AS said,
                 {_run("doc_id")} AS run FROM documents)
        SELECT video_id, language, is_generated, list_pos, 2 * len(said) AS n_pieces, said[1] AS first_line, run AS captured_at FROM runs WHERE run IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY video_id, language, is_generated ORDER BY run DESC, list_pos DESC) = 1""",
}
