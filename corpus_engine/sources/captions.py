"""Caption tracks, subtitle files and speech output to transcript texts and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.functions.text import (
    clean_text,
    cue_text,
    decode_file,
    joined_text,
    json3_text,
    language_choices,
    language_in_name,
    speaks_one_of,
)
from corpus_engine.functions.values import present, text_array
from corpus_engine.operators.ordering import keep_first
from corpus_engine.operators.sizing import settled_side

# Method names recorded with each transcript.
MANUAL = "youtube_transcript_api_manual"
GENERATED = "youtube_transcript_api_generated"
ANY_LANGUAGE = "youtube_transcript_api_any_language"
SUBTITLE = "yt_dlp_subtitle"
SPEECH_PREFIX = "faster_whisper_"

# Fixed value: subtitle formats, best first.
SUBTITLE_FORMATS = ["vtt", "srt", "json3"]


def pick_caption(
    tracks: DataFrame, languages: Sequence[str], any_language: bool = True
) -> DataFrame:
    """One caption track per video.

    Manual tracks in a wanted language come first, then generated ones, each by language priority
    and list order; otherwise, if allowed, any track, manual before generated.
    """
    wanted = language_choices(languages)
    manual = ~F.coalesce("is_generated", F.lit(False))
    priority = F.coalesce(F.array_position(wanted, F.col("language")), F.lit(0))  # 0: not wanted
    tier = F.when((priority > 0) & manual, 1).when(priority > 0, 2).when(manual, 3).otherwise(4)
    ranked = tracks.withColumns({"_tier": tier, "_priority": priority})
    if not any_language:
        ranked = ranked.where("_tier <= 2")
    method = F.when(F.col("_tier") == 1, MANUAL).when(F.col("_tier") == 2, GENERATED).otherwise(ANY_LANGUAGE)
    return (
        keep_first(ranked, ["video_id"], ["_tier", "_priority", "list_pos"])
        .withColumn("method", method)
        .drop("_tier", "_priority")
    )


def caption_page_tracks(pages: DataFrame, captured_at: Column) -> DataFrame:
    """Landed caption calls, tracks and failures, as rows of a run."""
    return pages.select(
        "video_id", "language", "is_generated", "list_pos", "captions", "error_type", "error_message",
        captured_at.alias("captured_at"), F.col("run_id").alias("_run_id"),
        F.struct(F.col("seq").alias("page"), F.lit(0).alias("kind"), F.lit(0).alias("pos")).alias("_seq"))


def caption_text(captions: str = "captions") -> Column:
    """Text of a caption payload: its pieces in order, cleaned; null when nothing is left."""
    return joined_text(F.col(f"{captions}.text"))


def flatten_caption_segments(tracks: DataFrame) -> DataFrame:
    """Timed segments of caption payloads; empty ones are dropped but still count in the index."""
    return tracks.select(
        "video_id", "method", F.posexplode("captions").alias("segment_index", "piece")
    ).where(present(F.col("piece.text"))).select(
        "video_id",
        F.col("segment_index").cast("bigint"),
        F.col("piece.start").alias("start_seconds"),
        F.col("piece.duration").alias("duration_seconds"),
        F.col("piece.text").alias("text"),
        F.col("method").alias("source_method"),
    )


def speech_segments(speech: DataFrame) -> DataFrame:
    """Timed segments of speech output, texts cleaned; blank ones dropped but counted in the index."""
    piece = speech.select(
        "video_id", "model_size", F.posexplode("segments").alias("segment_index", "piece"))
    return piece.select(
        "video_id",
        F.col("segment_index").cast("bigint"),
        F.col("piece.start").alias("start_seconds"),
        (F.col("piece.end") - F.col("piece.start")).alias("duration_seconds"),
        clean_text(F.col("piece.text")).alias("text"),
        F.concat(F.lit(SPEECH_PREFIX), F.col("model_size")).alias("source_method"),
    ).where(F.col("text").isNotNull())


def speech_text(segments: str = "segments") -> Column:
    return joined_text(F.col(f"{segments}.text"))


def read_subtitle_files(spark: SparkSession, path: str) -> DataFrame:
    """Subtitle files below ``path`` as ``path`` and ``content`` bytes."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{vtt,srt,json3}")
        .load(path)
        .select("path", "content")
    )


def choose_subtitle(files: DataFrame, languages: Sequence[str], asked: DataFrame | None = None) -> DataFrame:
    """One file per video among those in a wanted language: VTT before SRT before json3, then by name.

    Files are named ``<video_id>.<language>.<format>``; with ``asked`` only those videos' files count.
    """
    name = F.element_at(F.split("path", "/"), -1)
    named = files.withColumn("file_name", name).withColumns({
        "video_id": F.substring_index("file_name", ".", 1),
        "file_language": F.regexp_extract("file_name", r"^[^.]*\.(.+)\.[^.]+$", 1),
        "format": F.lower(F.substring_index("file_name", ".", -1)),
    })
    if asked is not None:
        named = named.join(asked, "video_id", "left_semi")
    eligible = named.where(
        F.col("format").isin(SUBTITLE_FORMATS) & speaks_one_of(F.col("file_language"), languages))
    ranked = eligible.withColumn("_format", F.array_position(text_array(SUBTITLE_FORMATS), F.col("format")))
    return keep_first(ranked, ["video_id"], ["_format", "file_name"]).drop("_format", "file_language")


def subtitle_payloads(files: DataFrame, asked: DataFrame, languages: Sequence[str]) -> DataFrame:
    """``video_id``, ``file_name``, ``format`` and ``content`` of the chosen files of the videos asked for.

    Files are chosen by their paths; contents are joined to the choice, which is counted, and broadcast while it is short.
    """
    chosen = settled_side(choose_subtitle(files.select("path"), languages, asked).select("path", "video_id", "file_name", "format"))
    return files.select("path", "content").join(chosen, "path").select("video_id", "file_name", "format", "content")


def subtitle_text(content: Column, fmt: Column) -> Column:
    """Spoken text of one subtitle file."""
    text = decode_file(content)
    return F.when(fmt == "json3", json3_text(text)).otherwise(cue_text(text))


def parse_subtitle_files(files: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Text and detected language of the chosen file of each video; text is null when useless."""
    return choose_subtitle(files, languages).select(
        "video_id",
        "file_name",
        language_in_name(F.col("file_name"), languages).alias("language"),
        subtitle_text(F.col("content"), F.col("format")).alias("text"),
    )
