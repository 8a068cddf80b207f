"""One run of a study: landed files in, new table versions and an audit report out.

Landing folders below ``landing``: ``search``, ``videos``, ``channels``, ``threads``, ``replies``,
``captions``, ``speech``, ``subtitle_attempts`` (JSON lines) and ``subtitles`` (files). A missing folder is an empty one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine import schemas
from corpus_engine.functions.values import new_run_id, utc_now
from corpus_engine.operators.membership import bit_table
from corpus_engine.operators.ordering import first_seen
from corpus_engine.operators.sizing import Observed
from corpus_engine.plans import report as metrics
from corpus_engine.plans import stages
from corpus_engine.plans.transcripts import resolve_transcripts
from corpus_engine.sources import tables
from corpus_engine.sources.captions import read_subtitle_files
from corpus_engine.sources.pages import flatten_comment_threads, flatten_search_pages, page_outcome, read_landing
from corpus_engine.sources.quarantine import read_checked

# Stage names, and below the options of the study format with their defaults.
STAGES = ["discovery", "videos", "channels", "transcripts", "comments"]

LANDING = {
    "search": schemas.landed(schemas.SEARCH_ENVELOPE, schemas.SEARCH_RESPONSE),
    "videos": schemas.landed(schemas.DETAIL_ENVELOPE, schemas.VIDEO_RESPONSE),
    "channels": schemas.landed(schemas.DETAIL_ENVELOPE, schemas.CHANNEL_RESPONSE),
    "threads": schemas.landed(schemas.THREAD_ENVELOPE, schemas.THREAD_RESPONSE),
    "replies": schemas.landed(schemas.REPLY_ENVELOPE, schemas.REPLY_RESPONSE),
    "captions": schemas.CAPTION_ENVELOPE,
    "speech": schemas.SPEECH_ENVELOPE,
    "subtitle_attempts": schemas.SUBTITLE_ATTEMPT,
}


@dataclass
class StudyOptions:
    """Knobs of a run, with the defaults of the study format."""

    max_pages_per_query: int = 1
    stop_on_quota: bool = True
    strict_search: bool = False  # end the run with an error when a search page failed, instead of passing over it
    languages: Sequence[str] = ("pt-BR", "pt", "en")
    use_any_caption: bool = True
    use_subtitles: bool = True
    use_speech: bool = True
    retry_failed: bool = True
    max_comments_per_video: int = 500
    include_replies: bool = True
    formats: Sequence[str] = ("parquet",)
    resume: bool = True
    quarantine: bool = False  # keep landed lines that cannot be read, instead of reading what is left of them
    member_bits: bool = False  # keep the bits of published keys, for studies whose tables are far larger than a run
    stages: Sequence[str] = field(default_factory=lambda: list(STAGES))

    def __post_init__(self) -> None:
        unknown = [s for s in self.stages if s not in STAGES]
        if unknown:
            raise ValueError(f"unknown stages {unknown}; choose from {STAGES}")
        if self.max_pages_per_query <= 0 or self.max_comments_per_video <= 0:
            raise ValueError("page and comment limits must be positive")
        if set(f.lower() for f in self.formats) - set(tables.FORMATS):
            raise ValueError(f"formats must be among {tables.FORMATS}")


class Study:
    """Paths and table access of one project."""

    def __init__(self, spark: SparkSession, base_dir: str, project: str):
        if not project.strip():
            raise ValueError("a study needs a project name")
        self.spark, self.project = spark, project
        self.root = f"{base_dir.rstrip('/')}/{project}"

    def path(self, table: str) -> str:
        return f"{self.root}/{schemas.TABLES[table][2]}/{table}"

    def read(self, table: str) -> DataFrame:
        schema = T.StructType([
            *schemas.TABLES[table][0].fields,
            T.StructField("_run_id", T.StringType()), T.StructField("_seq", schemas.SEQ)])
        return tables.read_table(self.spark, self.path(table), schema)

    def publish(self, df: DataFrame, table: str, version: str, formats: Sequence[str]) -> Observed:
        """Writes a table's next version; its rows are counted on the way."""
        counted = Observed(df)
        tables.write_table(counted.frame, self.path(table), version, formats)
        return counted

    def _bits_path(self, table: str) -> str | None:
        newest = tables.newest_version(self.spark, f"{self.path(table)}.parquet")
        return newest and f"{newest}/_bits"

    def keep_bits(self, table: str) -> None:
        """Writes the bits of the newest version's keys beside it; readers of the version do not see them."""
        path = self._bits_path(table)
        if path:
            bit_table(self.read(table), schemas.TABLES[table][1][0]).write.mode("overwrite").parquet(path)

    def bits(self, table: str) -> DataFrame | None:
        """The newest version's bits, where they were kept."""
        path = self._bits_path(table)
        return self.spark.read.parquet(path) if path and tables.exists(self.spark, f"{path}/_SUCCESS") else None

    def settle(self, df: DataFrame, label: str) -> DataFrame:
        """Writes an intermediate result that several tables read."""
        return tables.staged(df, label)

    def counted(self, df: DataFrame, label: str, **more: Column) -> tuple[DataFrame, Observed]:
        """The same, with its rows and whatever else is asked for counted while it is written."""
        counts = Observed(df, **more)
        return self.settle(counts.frame, label), counts

    def landed(self, landing: str, kind: str, quarantine: str | None = None) -> DataFrame:
        """Landed lines of a kind; with ``quarantine``, a run's label, those that cannot be read go there."""
        path = f"{landing.rstrip('/')}/{kind}"
        if not tables.exists(self.spark, path):
            return self.spark.createDataFrame([], LANDING[kind])
        if quarantine is None:
            return read_landing(self.spark, path, LANDING[kind])
        good, bad = read_checked(self.spark, path, LANDING[kind])
        bad.write.mode("overwrite").parquet(f"{self.root}/audit/quarantine/run={quarantine}/kind={kind}")
        return good

    def quarantined(self) -> DataFrame:
        """What all runs left unread, by ``run`` and ``kind``."""
        path = f"{self.root}/audit/quarantine"
        if tables.exists(self.spark, path):
            return self.spark.read.parquet(path)
        return self.spark.createDataFrame([], "run_id string, seq bigint, file string, text string, reason string, run string, kind string")

    def landed_subtitles(self, landing: str) -> DataFrame:
        path = f"{landing.rstrip('/')}/subtitles"
        if not tables.exists(self.spark, path):
            return self.spark.createDataFrame([], "path string, content binary")
        return read_subtitle_files(self.spark, path)


def run_study(
    spark: SparkSession,
    base_dir: str,
    project: str,
    landing: str,
    options: StudyOptions | None = None,
    run_id: str | None = None,
    captured_at: str | None = None,
) -> DataFrame:
    """Runs the chosen stages in order and returns the run's report row, also kept as JSON."""
    opts = options or StudyOptions()
    study = Study(spark, base_dir, project)
    run_id = run_id or new_run_id()
    started = utc_now()
    stamp = captured_at or started
    summary: dict[str, dict] = {}

    def landed(kind: str) -> DataFrame:
        return study.landed(landing, kind, run_id if opts.quarantine else None)

    def arriving(df: DataFrame, table: str, **more: Column) -> tuple[DataFrame, Observed]:
        """Settled rows of this run: after all stored ones, among themselves in page order."""
        stamped = df.withColumn("_run_id", F.concat_ws("/", F.lit(run_id), F.col("_run_id")))
        return study.counted(stamped, table, **more)

    def publish(new: DataFrame, table: str) -> Observed:
        return study.publish(stages.upserted(study.read(table), new, table), table, run_id, opts.formats)

    seen = None
    if "discovery" in opts.stages:
        outcome = page_outcome(F.col("response.items"))
        told = {f"pages_{kind}": F.count_if(outcome == kind) for kind in ("quota", "failed", "unreadable")}
        # Pages that a stage looks at more than once are parsed once and read back by column.
        pages, accounted = study.counted(landed("search"), "search", **told)
        if opts.strict_search and accounted["pages_failed"]:
            raise RuntimeError(f"{accounted['pages_failed']} search pages failed")
        new, arrived = arriving(flatten_search_pages(
            pages, F.lit(stamp), opts.max_pages_per_query, opts.stop_on_quota), "search_hits")
        published = publish(new, "search_hits")
        seen, distinct = study.counted(first_seen(study.read("search_hits"), "video_id"), "seen")
        summary["discovery"] = {
            "new_rows": arrived["rows"], "total_rows": published["rows"], "unique_videos": distinct["rows"],
            **{kind: accounted[kind] for kind in told}}
    hits = study.read("search_hits")
    if hits.isEmpty():
        raise RuntimeError(f"project {project} has no hits to work on; include discovery in the stages")

    videos = study.read("videos")
    if "videos" in opts.stages:
        todo, asked = study.counted(stages.pending_videos(
            first_seen(hits, "video_id") if seen is None else seen, videos, opts.resume, study.bits("videos")), "todo")
        new, arrived = arriving(stages.video_rows(todo, landed("videos"), stamp), "videos")
        merged = stages.upserted(videos, new, "videos")
        if "transcripts" in opts.stages:
            # The next stage gives these rows their transcripts, and publishes the table once with them.
            videos, stored = study.counted(merged, "merged")
        else:
            stored = study.publish(
                stages.with_transcripts(merged, study.read("transcripts")), "videos", f"{run_id}-1", opts.formats)
            videos = study.read("videos")
        summary["videos"] = {"requested": asked["rows"], "new_rows": arrived["rows"], "total_rows": stored["rows"]}
    if videos.isEmpty():
        raise RuntimeError(f"project {project} has no videos to work on; include videos in the stages")

    if "channels" in opts.stages:
        todo, asked = study.counted(stages.pending_channels(
            videos, study.read("channels"), opts.resume, study.bits("channels")), "todo")
        new, arrived = arriving(stages.channel_rows(todo, landed("channels"), stamp), "channels")
        summary["channels"] = {
            "requested": asked["rows"], "new_rows": arrived["rows"], "total_rows": publish(new, "channels")["rows"]}

    if "transcripts" in opts.stages:
        todo, asked = study.counted(stages.pending_transcripts(
            videos, study.read("transcripts"), opts.retry_failed, opts.resume), "todo")
        resolved = study.settle(resolve_transcripts(
            todo, landed("captions"),
            study.landed_subtitles(landing) if opts.use_subtitles else None,
            landed("speech") if opts.use_speech else None,
            opts.languages, opts.use_any_caption,
            landed("subtitle_attempts") if opts.use_subtitles else None), "resolved")
        made = stages.transcript_tables(resolved, stamp)
        status = F.col("transcript_status")
        new, arrived = arriving(
            made["transcripts"], "transcripts", successes=F.count_if(status == "success"),
            failures=F.count_if(status == "failed"), methods=metrics.top_sketch("transcript_method"))
        published = publish(new, "transcripts")
        publish(arriving(made["transcript_segments"], "segments")[0], "transcript_segments")
        study.publish(
            stages.with_transcripts(videos, study.read("transcripts")), "videos", f"{run_id}-2", opts.formats)
        videos = study.read("videos")
        summary["transcripts"] = {
            "requested": asked["rows"], "new_rows": arrived["rows"], "successes": arrived["successes"], "failures": arrived["failures"],
            **metrics.method_summary(new, arrived["methods"]), "total_rows": published["rows"]}

    if "comments" in opts.stages:
        todo, asked = study.counted(stages.pending_comments(
            videos, study.read("comments_status"), opts.resume), "todo")
        threads = study.settle(stages.wanted(landed("threads"), todo, "video_id"), "threads")
        replies = study.settle(stages.wanted(landed("replies"), todo, "video_id"), "replies")
        rows = study.settle(flatten_comment_threads(
            threads, replies, F.lit(stamp), opts.max_comments_per_video, opts.include_replies), "comments")
        outcome = study.settle(stages.comment_outcomes(
            threads, replies, rows, stamp, opts.stop_on_quota), "outcome")
        attempt = ["_run_id", "video_id"]
        new, arrived = arriving(rows.join(outcome.select(*attempt), attempt, "left_semi"), "comments")
        ranked = outcome.withColumn("_seq", F.struct(
            F.col("_seq").alias("page"), F.lit(0).alias("kind"), F.lit(0).alias("pos")))
        publish(arriving(ranked, "comments_status")[0], "comments_status")
        summary["comments"] = {
            "requested": asked["rows"], "new_rows": arrived["rows"], "total_rows": publish(new, "comments")["rows"]}

    if opts.member_bits:
        for table in ("videos", "channels"):
            study.keep_bits(table)

    outputs = {"root": study.root, **{
        t: study.path(t) for t in ("channels", "videos", "comments", "search_hits")}}
    report = study.settle(
        metrics.run_report(
            spark, run_id, project, started, utc_now(), summary, outputs, json.dumps(asdict(opts))), "report")
    tables.write_report(report, f"{study.root}/audit/runs/run_{run_id}")
    return report
