"""Transcript cascade: caption track, then subtitle file, then speech text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.functions.text import language_choices, language_in_name
from corpus_engine.functions.values import last_chars
from corpus_engine.operators.ordering import keep_first
from corpus_engine.sources.captions import (
    SPEECH_PREFIX,
    SUBTITLE,
    caption_text,
    flatten_caption_segments,
    pick_caption,
    speech_segments,
    speech_text,
    subtitle_payloads,
    subtitle_text,
)
from corpus_engine.sources.tables import staged

# Error types and messages recorded when a strategy yields nothing, by strategy.
NO_TRACK = ("NoMatchingTranscript", "Nenhuma legenda disponível nos idiomas {}.")
EMPTY_TRACK = ("EmptyTranscript", "Legenda encontrada sem texto útil.")
NO_FILE = ("YtDlpSubtitleError", "Nenhuma legenda encontrada.")
EMPTY_FILE = ("EmptySubtitle", "Legenda baixada sem texto útil.")
NO_AUDIO = ("AudioDownloadError", "Falha ao baixar áudio.")
EMPTY_SPEECH = ("EmptyWhisperTranscript", "Whisper não produziu texto.")
STRATEGIES = ["youtube_transcript_api", "yt_dlp_subtitle", "whisper"]
FAILED = "failed"
SUCCESS = "success"
MESSAGE_LIMIT = 4000


def _error(kind: Column, message: Column) -> Column:
    return F.struct(kind.alias("type"), message.alias("message"))


def _fixed(error: tuple[str, str], *args: str) -> Column:
    return _error(F.lit(error[0]), F.lit(error[1].format(*args)))


def _listed(message: str, names: Column) -> Column:
    """The message with the names, quoted and in brackets, in its gap."""
    before, after = message.split("{}")
    quoted = F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'")))
    return F.concat(F.lit(f"{before}["), F.array_join(quoted, ", "), F.lit(f"]{after}"))


def _landed_errors(attempts: DataFrame, order_by: list[str], into: str) -> DataFrame:
    """The first error that landed for a video, its message cut to the last ``MESSAGE_LIMIT`` characters."""
    failed = attempts.where(F.col("error_type").isNotNull())
    error = _error(F.col("error_type"), last_chars(F.col("error_message"), MESSAGE_LIMIT))
    return keep_first(failed, ["video_id"], [*order_by, "error_type", "error_message"]).select("video_id", error.alias(into))


def resolve_transcripts(
    attempted: DataFrame,
    tracks: DataFrame,
    subtitles: DataFrame | None,
    speech: DataFrame | None,
    languages: Sequence[str],
    any_language: bool = True,
    subtitle_attempts: DataFrame | None = None,
) -> DataFrame:
    """One row per attempted video: winning strategy, its text and the errors of those before it.

    Captions and speech carry the errors of failed calls in their rows, subtitles in ``subtitle_attempts``.
    Payloads travel only for videos that were asked for and that no earlier strategy answered: each strategy's rows are
    written when the frame is built, and the next one is asked about those without text.
    """
    asked = attempted.select("video_id").where("video_id <> ''").distinct()
    own = tracks.join(asked, "video_id", "left_semi")
    chosen = pick_caption(own.where(F.col("error_type").isNull()), languages, any_language).select(
        "video_id", F.col("language").alias("track_language"), "method", "captions",
        F.lit(True).alias("has_track"))
    rows = asked.join(chosen, "video_id", "left").join(
        _landed_errors(own, ["list_pos"], "landed"), "video_id", "left").withColumn("track_text", caption_text())
    no_track = _error(F.lit(NO_TRACK[0]), _listed(NO_TRACK[1], language_choices(languages)))
    rows = staged(rows.withColumn("track_error", F.when(
        F.col("track_text").isNull(),
        F.when(F.col("has_track"), _fixed(EMPTY_TRACK)).otherwise(F.coalesce("landed", no_track)))).drop("landed"), "cascade-tracks")
    answered = [rows.where(F.col("track_text").isNotNull())]
    rows = rows.where(F.col("track_text").isNull()).select("video_id", "track_error")

    if subtitles is not None:
        rows = rows.join(subtitle_payloads(subtitles, rows.select("video_id"), languages), "video_id", "left")
        landed = F.lit(None).cast(schemas.ERROR)
        if subtitle_attempts is not None:
            tried = subtitle_attempts.join(rows.select("video_id"), "video_id", "left_semi")
            rows, landed = rows.join(_landed_errors(tried, [], "landed"), "video_id", "left"), F.col("landed")
        rows = rows.withColumns({
            "file_text": subtitle_text(F.col("content"), F.col("format")),
            "file_language": language_in_name(F.col("file_name"), languages),
        })
        rows = staged(rows.withColumn("file_error", F.when(F.col("file_text").isNull(), F.when(
            F.col("file_name").isNull(), F.coalesce(landed, _fixed(NO_FILE))).otherwise(_fixed(EMPTY_FILE)))).select(
                "video_id", "track_error", "file_name", "file_text", "file_language", "file_error"), "cascade-files")
        answered.append(rows.where(F.col("file_text").isNotNull()))
        rows = rows.where(F.col("file_text").isNull()).select("video_id", "track_error", "file_error")

    if speech is not None:
        heard = speech.join(rows.select("video_id"), "video_id", "left_semi")
        heard = keep_first(heard, ["video_id"], ["model_size", "language"]).select(
            "video_id", F.col("language").alias("speech_language"), "model_size", "segments",
            F.col("error_type"), F.col("error_message"), F.lit(True).alias("has_speech"))
        rows = rows.join(heard, "video_id", "left").withColumn("speech_text", speech_text())
        rows = rows.withColumn("speech_error", F.when(
            F.col("speech_text").isNull(),
            F.when(F.col("error_type").isNotNull(), _error(
                F.col("error_type"), last_chars(F.col("error_message"), MESSAGE_LIMIT)))
            .when(F.col("has_speech"), _fixed(EMPTY_SPEECH)).otherwise(_fixed(NO_AUDIO)))).drop("error_type", "error_message", "has_speech")

    missing = {
        **_absent("file"), **_absent("speech"), "file_name": F.lit(None).cast("string"),
        "model_size": F.lit(None).cast("string"), "segments": F.lit(None).cast(schemas.SPEECH_ENVELOPE["segments"].dataType),
        "track_language": F.lit(None).cast("string"), "track_text": F.lit(None).cast("string"), "method": F.lit(None).cast("string"),
        "captions": F.lit(None).cast(schemas.CAPTIONS),
    }
    columns = ["video_id", "track_error", *missing]
    parts = [p.withColumns({c: v for c, v in missing.items() if c not in p.columns}).select(*columns) for p in (*answered, rows)]
    return reduce(DataFrame.unionByName, parts)


def _absent(strategy: str) -> dict[str, Column]:
    return {
        f"{strategy}_text": F.lit(None).cast("string"),
        f"{strategy}_language": F.lit(None).cast("string"),
        f"{strategy}_error": F.lit(None).cast(schemas.ERROR),
    }


def transcript_rows(resolved: DataFrame, captured_at: Column) -> DataFrame:
    """The transcripts table: success with method, language and text, or failed with every error."""
    by_track, by_file, by_speech = (
        F.col(f"{s}_text").isNotNull() for s in ("track", "file", "speech"))

    def pick(track: Column, file: Column, speech: Column, otherwise: Column) -> Column:
        return F.when(by_track, track).when(by_file, file).when(by_speech, speech).otherwise(otherwise)

    none = F.lit(None).cast("string")
    errors = F.map_from_entries(F.filter(
        F.array(*[
            F.struct(F.lit(name).alias("key"), F.col(f"{column}_error").alias("value"))
            for name, column in zip(STRATEGIES, ("track", "file", "speech"))
        ]),
        lambda e: e["value"].isNotNull(),
    ))
    failed = ~(by_track | by_file | by_speech)
    return resolved.select(
        "video_id",
        F.when(failed, F.lit(FAILED)).otherwise(F.lit(SUCCESS)).alias("transcript_status"),
        pick(
            F.col("method"), F.lit(SUBTITLE),
            F.concat(F.lit(SPEECH_PREFIX), F.col("model_size")), F.lit(FAILED),
        ).alias("transcript_method"),
        pick(F.col("track_language"), F.col("file_language"), F.col("speech_language"), none)
        .alias("transcript_language"),
        F.coalesce("track_text", "file_text", "speech_text").alias("transcript_text"),
        F.when(failed, errors).alias("transcript_error"),
        captured_at.alias("transcript_captured_at"),
    )


def transcript_segments(resolved: DataFrame) -> DataFrame:
    """Timed segments of the winning strategy; subtitle files have none."""
    from_tracks = flatten_caption_segments(resolved.where(F.col("track_text").isNotNull()))
    from_speech = speech_segments(resolved.where(F.col("speech_text").isNotNull()))
    return from_tracks.unionByName(from_speech)


def transcript_preview(
    transcripts: DataFrame, segments: DataFrame, chars: int = 1000
) -> DataFrame:
    """Per video: the text's beginning, its whole length and the number of segments."""
    counts = segments.groupBy("video_id").agg(F.count(F.lit(1)).alias("segment_count"))
    return transcripts.join(counts, "video_id", "left").select(
        "video_id", "transcript_status", "transcript_method", "transcript_language",
        F.left("transcript_text", F.lit(chars)).alias("transcript_preview"),
        F.length("transcript_text").cast("bigint").alias("text_length"),
        F.coalesce("segment_count", F.lit(0)).alias("segment_count"),
    )
