"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import study_tables as st
from corpus_engine import schemas
from corpus_engine.functions.text import clean_text
from corpus_engine.operators.ordering import first_seen, keep_last, replace_rows, upsert
from corpus_engine.operators.positions import id_batches as make_id_batches
from corpus_engine.operators.resume import pending, refresh_columns
from corpus_engine.plans import coverage, expansion, report, review, search_plan as plan
from corpus_engine.plans.comments import comment_statuses, cut_statuses_at_quota
from corpus_engine.plans.stages import comment_outcomes
from corpus_engine.plans.stages import pending_comments as comments_todo
from corpus_engine.plans.stages import pending_transcripts as transcripts_todo
from corpus_engine.plans.study import Study, StudyOptions, run_study
from corpus_engine.plans.transcripts import (
    resolve_transcripts,
    transcript_preview as preview,
    transcript_rows,
    transcript_segments,
)
from corpus_engine.session import scratch_path
from corpus_engine.sources import captions, pages, tables
from corpus_engine.streaming.ingest import ingest_search_pages, ingested_hits

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SPLIT_DAY = "1999-01-01"
MAX_PAGES = 500
HIT_COLUMNS = schemas.SEARCH_HITS.fieldNames()


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def captured():
    return F.lit(st.CAPTURED)


# --- evaluation ------------------------------------------------------------------------------


@query
def discovery_review(spark: SparkSession, sf: str) -> DataFrame:
    return review.discovery_review(st.hits(spark, sf), st.videos(spark, sf))


@query
def review_counts(spark: SparkSession, sf: str) -> DataFrame:
    return review.review_counts(review.best_hits(st.hits(spark, sf)))


@query
def channel_expansion(spark: SparkSession, sf: str) -> DataFrame:
    return expansion.channel_expansion(
        st.expansion_hits(spark, sf), st.expansion_channels(spark, sf), st.playlist_pages(spark, sf),
        "2024-03-01", "2024-12-31", max_channels=10, max_pages=None)


@query
def expansion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return expansion.expansion_counts(channel_expansion(spark, sf))


# --- search design ---------------------------------------------------------------------------


def _themes(spark: SparkSession, sf: str) -> DataFrame:
    return st.table(spark, sf, "part").selectExpr(
        "p_type as theme", "array(p_name, concat(' ', p_name, ' '), p_brand, '  ') as queries").distinct()


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return plan.search_grid(
        _themes(spark, sf), "2026-01-01", "2026-03-16", 30, ["relevance", "viewCount"])


@query
def search_grid(spark: SparkSession, sf: str) -> DataFrame:
    return _grid(spark, sf)


@query
def plan_requests_json(spark: SparkSession, sf: str) -> DataFrame:
    return plan.request_parameters(_grid(spark, sf), region_code=None).select("search_id", "request")


@query
def stable_ids(spark: SparkSession, sf: str) -> DataFrame:
    return st.hits(spark, sf).groupBy("search_id", "query").agg(F.count(F.lit(1)).alias("n_hits"))


# --- upsert and resume -----------------------------------------------------------------------


def _halves(hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    day = F.col("l_shipdate") < F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return hits.where(day), hits.where(~day)


@query
def upsert_hits(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _halves(st.hits(spark, sf))
    return upsert(old, new, ["search_id", "video_id", "result_position"]).select(
        "search_id", "video_id", "result_position", "page_number", "channel_id", "captured_at")


@query
def upsert_by_query_and_video(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _halves(st.hits(spark, sf))
    return upsert(old, new, ["query", "video_id"]).select(
        "query", "video_id", "result_position", "channel_id", "captured_at")


@query
def upsert_into_settled(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _halves(st.hits(spark, sf))
    keys = ["query", "video_id"]
    return replace_rows(keep_last(old, keys), new, keys).select(
        *keys, "result_position", "channel_id", "captured_at")


@query
def upsert_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    facts = st.videos(spark, sf)
    old = facts.select("video_id", "title", "view_count", F.lit("r1").alias("_run_id"), F.lit(0).alias("_seq"))
    new = facts.where("p_type = 'PROMO'").select(
        "video_id", F.upper("title").alias("title"), "duration_seconds",
        F.lit("r2").alias("_run_id"), F.lit(0).alias("_seq"))
    return upsert(old, new, ["video_id"]).select("video_id", "title", "view_count", "duration_seconds")


@query
def discovered_videos(spark: SparkSession, sf: str) -> DataFrame:
    seen = first_seen(st.hits(spark, sf), "video_id")
    return seen.select("video_id", F.col("_run_id").alias("first_run"), F.col("_seq.l_orderkey").alias("first_order"))


@query
def pending_videos(spark: SparkSession, sf: str) -> DataFrame:
    stored = st.videos(spark, sf).where("p_type <> 'PROMO'")
    return pending(first_seen(st.hits(spark, sf), "video_id"), stored, "video_id").select("video_id")


@query
def pending_channels(spark: SparkSession, sf: str) -> DataFrame:
    stored = st.channels(spark, sf).where("uploads_playlist_id is not null")
    return pending(first_seen(st.hits(spark, sf), "channel_id"), stored, "channel_id").select("channel_id")


@query
def pending_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return transcripts_todo(st.cascade_videos(spark, sf), st.transcripts(spark, sf))


def _statuses(spark: SparkSession, sf: str) -> DataFrame:
    return comment_statuses(st.attempts(spark, sf), st.conversation_comments(spark, sf), captured())


@query
def pending_comments(spark: SparkSession, sf: str) -> DataFrame:
    attempted = st.attempts(spark, sf).select("video_id").distinct()
    return comments_todo(attempted, keep_last(_statuses(spark, sf), ["video_id"]))


@query
def refresh_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    base = st.cascade_videos(spark, sf).select("video_id", F.lit("stale").alias("transcript_status"))
    columns = ["transcript_status", "transcript_method", "transcript_language", "transcript_text"]
    return refresh_columns(base, st.transcripts(spark, sf), "video_id", columns).select("video_id", *columns)


@query
def id_batches(spark: SparkSession, sf: str) -> DataFrame:
    seen = first_seen(st.hits(spark, sf), "video_id")
    return make_id_batches(seen, "video_id", [F.col("_run_id"), F.col("_seq")])


# --- pages -----------------------------------------------------------------------------------


@query
def flatten_search_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.flatten_search_pages(st.search_pages(spark, sf), captured()).select(*HIT_COLUMNS)


@query
def search_pages_within_depth(spark: SparkSession, sf: str) -> DataFrame:
    """Only the first pages of each search, as a study's page limit asks for."""
    return pages.flatten_search_pages(st.search_pages(spark, sf), captured(), max_pages=MAX_PAGES).select(*HIT_COLUMNS)


def _as_json(df: DataFrame, *arrays: str) -> DataFrame:
    return df.withColumns({a: F.to_json(a) for a in arrays})


@query
def flatten_videos(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.flatten_video_pages(st.video_pages(spark, sf), captured())
    return _as_json(rows.drop("_run_id", "_seq"), "tags", "topic_categories")


@query
def flatten_channels(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.flatten_channel_pages(st.channel_pages(spark, sf), captured())
    return _as_json(rows.drop("_run_id", "_seq"), "topic_categories")


@query
def flatten_playlists(spark: SparkSession, sf: str) -> DataFrame:
    return pages.flatten_playlist_pages(st.playlist_pages(spark, sf))


@query
def comment_threads_capped(spark: SparkSession, sf: str) -> DataFrame:
    return pages.flatten_comment_threads(
        st.thread_pages(spark, sf), st.reply_pages(spark, sf), captured(), max_per_video=20
    ).drop("_run_id", "_seq")


@query
def comment_threads_all(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.flatten_comment_threads(
        st.thread_pages(spark, sf), st.reply_pages(spark, sf), captured(), max_per_video=10**9)
    return rows.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_comments"), F.count_if("is_reply").alias("n_replies"),
        F.sum("total_reply_count").alias("announced_replies"), F.sum(F.length("text")).alias("n_chars"))


@query
def comment_status(spark: SparkSession, sf: str) -> DataFrame:
    return _statuses(spark, sf).withColumnsRenamed({"_run_id": "run_id", "_seq": "attempt"})


def _flawed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages as a run settles them: made once, however often they are looked at."""
    threads, replies = tables.staged(st.flawed_thread_pages(spark, sf), "threads"), tables.staged(st.flawed_reply_pages(spark, sf), "replies")
    return threads, replies, pages.flatten_comment_threads(threads, replies, captured())


@query
def comments_until_failure(spark: SparkSession, sf: str) -> DataFrame:
    _, _, rows = _flawed(spark, sf)
    return rows.select(F.col("_run_id").alias("run_id"), "comment_id", "video_id", "thread_id", "parent_comment_id", "is_reply", "text")


@query
def page_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Search pages made of orders: one in five failed, some were cut short."""
    landed = st.table(spark, sf, "orders").selectExpr(
        "concat('r', year(o_orderdate)) as run_id",
        """case o_orderpriority when '1-URGENT' then 'HttpError 403 quotaExceeded' when '5-LOW' then 'HttpError 500 backendError' end as error""",
        """case o_orderstatus when 'O' then concat('{"items": [{"id": {"videoId": "', o_custkey, '"}}]}')
             when 'F' then '{"items": []}' else '{"items": [{"id": {"vid' end as response""")
    return pages.page_accounting(landed, schemas.SEARCH_RESPONSE)


@query
def versions_and_reruns(spark: SparkSession, sf: str) -> DataFrame:
    """A table written as r9, then as r10, then once more as r10, which is refused."""
    path = f"{scratch_path(spark, 'versions')}/customer"
    rows = st.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    refused = []
    for version, part in (("r9", rows.where("c_acctbal > 0")), ("r10", rows), ("r10", rows.where("c_acctbal > 0"))):
        try:
            tables.write_table(part.withColumn("version", F.lit(version)), path, version)
        except ValueError as error:
            refused.append(str(error))
    stored = tables.read_table(spark, path, rows.schema)
    return stored.withColumn("refused", F.lit(len(refused) == 1))


@query
def comment_run_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return comment_outcomes(*_flawed(spark, sf), st.CAPTURED).withColumnRenamed("_run_id", "run_id").drop("_seq")


@query
def quota_cut(spark: SparkSession, sf: str) -> DataFrame:
    return cut_statuses_at_quota(_statuses(spark, sf)).select(
        F.col("_run_id").alias("run_id"), F.col("_seq").alias("attempt"), "video_id", "status")


# --- transcripts -----------------------------------------------------------------------------


@query
def pick_caption(spark: SparkSession, sf: str) -> DataFrame:
    return captions.pick_caption(st.caption_tracks(spark, sf), ["es", "fr-CA"]).select(
        "video_id", "language", "is_generated", "list_pos", "method")


@query
def assemble_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    return st.caption_tracks(spark, sf).select("doc_id", captions.caption_text().alias("transcript_text"))


@query
def caption_segments(spark: SparkSession, sf: str) -> DataFrame:
    tracks = st.caption_tracks(spark, sf).withColumn("method", F.concat_ws("-", "language", "doc_id"))
    return captions.flatten_caption_segments(tracks)


@query
def cleaned_documents(spark: SparkSession, sf: str) -> DataFrame:
    return st.table(spark, sf, "documents").select("doc_id", clean_text(F.col("text")).alias("cleaned"))


@query
def parse_subtitles(spark: SparkSession, sf: str) -> DataFrame:
    return captions.parse_subtitle_files(st.every_vtt(spark, sf), ["en", "fr", "de", "es"])


@query
def parse_json3(spark: SparkSession, sf: str) -> DataFrame:
    return captions.parse_subtitle_files(st.json3_files(spark, sf), ["pt", "en"])


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_transcripts(
        st.cascade_videos(spark, sf), st.cascade_tracks(spark, sf), st.subtitle_files(spark, sf),
        st.cascade_speech(spark, sf), st.LANGUAGES, subtitle_attempts=st.subtitle_attempts(spark, sf))


@query
def cascade_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    rows = transcript_rows(_resolved(spark, sf), captured())
    told = {}
    for name, strategy in (("captions", "youtube_transcript_api"), ("subtitles", "yt_dlp_subtitle"), ("speech", "whisper")):
        error = F.try_element_at("transcript_error", F.lit(strategy))
        told |= {f"error_{name}": error["type"], f"{name}_message": error["message"]}
    return rows.withColumns(told).drop("transcript_error")


@query
def cascade_segments(spark: SparkSession, sf: str) -> DataFrame:
    return transcript_segments(_resolved(spark, sf))


@query
def transcript_preview(spark: SparkSession, sf: str) -> DataFrame:
    return preview(st.transcripts(spark, sf), st.segments(spark, sf))


# --- metrics and summaries -------------------------------------------------------------------


@query
def discovery_metrics(spark: SparkSession, sf: str) -> DataFrame:
    hits = st.hits(spark, sf)
    return report.discovery_metrics(_halves(hits)[1], hits)


@query
def stage_metrics(spark: SparkSession, sf: str) -> DataFrame:
    todo = pending_transcripts(spark, sf)
    rows = st.transcripts(spark, sf)
    counted = report.transcript_stage_metrics(todo, rows, rows)
    return counted.withColumn("n_methods", F.size("methods").cast("bigint")).drop("methods", "methods_null", "methods_other")


@query
def method_histogram(spark: SparkSession, sf: str) -> DataFrame:
    wide = st.cascade_videos(spark, sf).join(st.transcripts(spark, sf), "video_id", "left")
    return report.method_histogram(wide)


@query
def strategy_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.strategy_coverage(st.hits(spark, sf))


@query
def strategy_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.strategy_overlap(st.hits(spark, sf))


@query
def overlap_with_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.overlap_with(st.hits(spark, sf), "A-1")


@query
def corpus_profile(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.corpus_profile(
        st.hits(spark, sf), st.videos(spark, sf), st.channels(spark, sf),
        st.conversation_comments(spark, sf), st.transcripts(spark, sf))


@query
def study_manifest(spark: SparkSession, sf: str) -> DataFrame:
    statuses = keep_last(_statuses(spark, sf), ["video_id"])
    stored = st.transcripts(spark, sf).withColumn("video_id", F.substring("video_id", 2, 20))
    return coverage.study_manifest(st.hits(spark, sf), st.videos(spark, sf), statuses, stored)


# --- files and streams -----------------------------------------------------------------------


@query
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.flatten_video_pages(st.video_pages(spark, sf), captured())
    path = scratch_path(spark, "csv")
    tables.write_csv(rows, path)
    back = tables.read_csv(spark, path, schemas.VIDEO_FACTS)
    return _as_json(back, "tags", "topic_categories")


@query
def csv_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The text that nested cells become in CSV."""
    rows = pages.flatten_video_pages(st.video_pages(spark, sf), captured())
    nested = F.struct(F.col("title").alias("b"), F.col("view_count").alias("a"), F.col("tags").alias("c"))
    return rows.select("video_id", tables.json_cell(F.col("tags"), rows.schema["tags"].dataType).alias("tags_cell"),
                       tables.json_cell(nested, rows.select(nested.alias("n")).schema["n"].dataType).alias("struct_cell"))


@query
def csv_only_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table that exists as CSV only, read back with its arrival order."""
    path = f"{scratch_path(spark, 'csv-only')}/channel"
    rows = pages.flatten_channel_pages(st.channel_pages(spark, sf), captured())
    tables.write_table(rows, path, "r1", ["csv"])
    back = tables.read_table(spark, path, rows.schema)
    return back.select("channel_id", "channel_title", F.col("_run_id").alias("run_id"), "_seq.page", "_seq.pos")


@query
def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same hits as ``flatten_search_pages``, with the pages of a run dealt over files and stream batches."""
    root = scratch_path(spark, "ingest")
    landed = st.search_pages(spark, sf)
    landed.repartition(6, "seq").write.json(f"{root}/landing")
    n_files = len(spark.read.text(f"{root}/landing").inputFiles())
    ingest_search_pages(
        spark, f"{root}/landing", f"{root}/search_hits", f"{root}/checkpoint", captured(),
        files_per_batch=max(1, n_files // 3),
    ).awaitTermination()
    return ingested_hits(spark, f"{root}/search_hits").select(*HIT_COLUMNS)


@query
def study_run(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run over landed files: every stage, its tables, and the counts of its report."""
    root = scratch_path(spark, "study")
    st.land_study(spark, sf, f"{root}/landing")
    options = StudyOptions(max_pages_per_query=10**9)
    run_study(spark, f"{root}/data", "study", f"{root}/landing", options, "r1", st.CAPTURED)
    made = spark.read.json(f"{root}/data/study/audit/runs/run_r1")
    return made.select(
        F.col("stages.discovery.new_rows").alias("new_hits"),
        "stages.discovery.unique_videos",
        F.col("stages.videos.requested").alias("videos_requested"),
        F.col("stages.videos.total_rows").alias("videos_total"),
        F.col("stages.channels.requested").alias("channels_requested"),
        F.col("stages.channels.total_rows").alias("channels_total"),
        F.col("stages.transcripts.requested").alias("transcripts_requested"),
        "stages.transcripts.successes",
        "stages.transcripts.failures",
        F.col("stages.comments.requested").alias("comments_requested"),
        F.col("stages.comments.total_rows").alias("comments_total"),
    )


@query
def study_run_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A run over a part of the landing, then a run over all of it: what is stored stays, what failed is tried again."""
    root = scratch_path(spark, "study")
    options = StudyOptions(max_pages_per_query=10**9, stages=["discovery", "videos", "transcripts"], formats=("parquet", "csv"))
    for run, languages, stamp in (("r1", "'es', 'fr'", "2026-01-01T00:00:00Z"), ("r2", "'de', 'en', 'es', 'fr'", "2026-02-01T00:00:00Z")):
        st.land_study(spark, sf, f"{root}/landing-{run}", languages)
        run_study(spark, f"{root}/data", "study", f"{root}/landing-{run}", options, run, stamp)
    return Study(spark, f"{root}/data", "study").read("videos").select(
        "video_id", "channel_id", "title", "transcript_status", "transcript_text", "captured_at")


@query
def study_run_videos(spark: SparkSession, sf: str) -> DataFrame:
    """The videos table such a run publishes, transcripts included."""
    root = scratch_path(spark, "study")
    st.land_study(spark, sf, f"{root}/landing")
    options = StudyOptions(max_pages_per_query=10**9, stages=["discovery", "videos", "transcripts"])
    run_study(spark, f"{root}/data", "study", f"{root}/landing", options, "r1", st.CAPTURED)
    return Study(spark, f"{root}/data", "study").read("videos").select(
        "video_id", "channel_id", "title", "video_url", "transcript_status", "transcript_method",
        "transcript_language", "transcript_text", "captured_at")
