from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.plans import transcripts as tr
from corpus_engine.sources import captions as cap
from tests.helpers import values


def at():
    return F.lit("2026-01-01T00:00:00Z")


def track(video, language, generated, pos, *texts):
    return (video, language, generated, pos, [(t, float(i), 1.0) for i, t in enumerate(texts)], None, None)


def tracks(spark, rows):
    return spark.createDataFrame(rows, schemas.CAPTION_ENVELOPE)


def test_pick_caption(spark):
    df = tracks(spark, [
        track("manual wins", "en", True, 0, "g"), track("manual wins", "pt", False, 1, "m"),
        track("language order", "en", False, 0, "e"), track("language order", "pt", False, 1, "p"),
        track("generated", "fr", False, 0, "f"), track("generated", "en", True, 1, "g"),
        track("any", "fr", True, 0, "g"), track("any", "de", False, 1, "m"), track("any", "it", False, 2, "i"),
    ])
    got = cap.pick_caption(df, ["pt-BR", "en"])
    assert values(got, "video_id", "language", "method") == [
        ("any", "de", cap.ANY_LANGUAGE), ("generated", "en", cap.GENERATED),
        ("language order", "pt", cap.MANUAL), ("manual wins", "pt", cap.MANUAL)]
    assert "any" not in {r.video_id for r in cap.pick_caption(df, ["pt-BR", "en"], any_language=False).collect()}


def files(spark, **content):
    rows = [("/x/" + name.replace("__", "."), bytearray(text.encode())) for name, text in content.items()]
    return spark.createDataFrame(rows, "path string, content binary")


VTT = "WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.000\n{}\n"


def test_subtitle_choice(spark):
    df = files(spark, a__pt__srt=VTT.format("srt"), a__pt__vtt=VTT.format("vtt"), b__xx__vtt=VTT.format("foreign"),
               c__pt_PT__json3='{"events":[{"segs":[{"utf8":"json"}]}]}', d__en__vtt="WEBVTT\n")
    got = cap.parse_subtitle_files(df, ["pt", "en"])
    assert values(got, "video_id", "language", "text") == [
        ("a", "pt", "vtt"), ("c", "pt", "json"), ("d", "en", None)]


def cascade(spark, **options):
    attempted = spark.createDataFrame([(v,) for v in ("t", "empty", "file", "speech", "none", "bad", "t", "")], "video_id string")
    caps = tracks(spark, [track("t", "pt", False, 0, "hello", "", None, " you "), track("empty", "en", False, 0, "", " ")])
    subs = files(spark, t__pt__vtt=VTT.format("unused"), file__pt__vtt=VTT.format("from file"), speech__en__vtt="WEBVTT\n")
    speech = spark.createDataFrame([
        ("speech", "pt", "small", [(" a ", 0.0, 1.5), (" ", 1.5, 2.0), ("b", 2.0, None)], None, None),
        ("none", None, "small", [(" ", 0.0, 1.0)], None, None),
        ("bad", None, "small", None, "AudioDownloadError", "x" * 5000),
    ], schemas.SPEECH_ENVELOPE)
    return tr.resolve_transcripts(attempted, caps, subs, speech, ["pt", "en"], **options)


def test_cascade(spark):
    resolved = cascade(spark)
    got = tr.transcript_rows(resolved, at())
    assert got.schema.fieldNames() == schemas.TRANSCRIPTS.fieldNames()
    rows = {r.video_id: r for r in got.collect()}
    assert set(rows) == {"t", "empty", "file", "speech", "none", "bad"}
    assert (rows["t"].transcript_method, rows["t"].transcript_text) == (cap.MANUAL, "hello you")
    assert (rows["file"].transcript_method, rows["file"].transcript_language) == (cap.SUBTITLE, "pt")
    assert (rows["speech"].transcript_method, rows["speech"].transcript_text) == ("faster_whisper_small", "a b")
    assert rows["t"].transcript_error is None
    assert all(rows[v].transcript_status == "failed" for v in ("empty", "none", "bad"))
    errors = {v: {k: e.type for k, e in rows[v].transcript_error.items()} for v in ("empty", "none", "bad")}
    assert errors["empty"] == {
        "youtube_transcript_api": "EmptyTranscript", "yt_dlp_subtitle": "YtDlpSubtitleError", "whisper": "AudioDownloadError"}
    assert errors["none"]["youtube_transcript_api"] == "NoMatchingTranscript"
    assert errors["none"]["whisper"] == "EmptyWhisperTranscript"
    assert len(rows["bad"].transcript_error["whisper"].message) == 4000


def test_cascade_without_later_strategies(spark):
    attempted = spark.createDataFrame([("a",)], "video_id string")
    got = tr.transcript_rows(tr.resolve_transcripts(attempted, tracks(spark, []), None, None, ["en"]), at()).collect()
    assert list(got[0].transcript_error) == ["youtube_transcript_api"]
    assert got[0].transcript_error["youtube_transcript_api"].message.endswith("['en'].")


def test_segments(spark):
    got = tr.transcript_segments(cascade(spark))
    assert values(got, "video_id", "segment_index", "start_seconds", "duration_seconds", "text", "source_method") == [
        ("speech", 0, 0.0, 1.5, "a", "faster_whisper_small"), ("speech", 2, 2.0, None, "b", "faster_whisper_small"),
        ("t", 0, 0.0, 1.0, "hello", cap.MANUAL), ("t", 3, 3.0, 1.0, " you ", cap.MANUAL)]


def test_preview(spark):
    rows = spark.createDataFrame([("a", "x" * 2500), ("b", None)], "video_id string, transcript_text string").selectExpr(
        "*", "'success' transcript_status", "'m' transcript_method", "'pt' transcript_language")
    segments = spark.createDataFrame([("a",), ("a",)], "video_id string")
    got = {r.video_id: r for r in tr.transcript_preview(rows, segments).collect()}
    assert (len(got["a"].transcript_preview), got["a"].text_length, got["a"].segment_count) == (1000, 2500, 2)
    assert (got["b"].transcript_preview, got["b"].segment_count) == (None, 0)


def test_errors_that_landed_are_kept(spark):
    attempted = spark.createDataFrame([("off",), ("both",), ("later",)], "video_id string")
    caps = tracks(spark, [("off", None, None, 1, None, "TranscriptsDisabled", "x" * 5000), ("off", None, None, 0, None, "IpBlocked", "first"),
                          ("both", None, None, 0, None, "IpBlocked", "once"), track("both", "en", False, 1, "text"),
                          ("unasked", None, None, 0, None, "IpBlocked", "m"), ("later", None, None, 0, None, "TranscriptsDisabled", "y" * 4001 + "z")])
    tried = spark.createDataFrame([("off", "DownloadError", "a" + "b" * 4000), ("both", "DownloadError", "m")], schemas.SUBTITLE_ATTEMPT)
    resolved = tr.resolve_transcripts(attempted, caps, files(spark), None, ["en"], subtitle_attempts=tried)
    got = {r.video_id: r for r in tr.transcript_rows(resolved, at()).collect()}
    errors = {v: {k: tuple(e) for k, e in (r.transcript_error or {}).items()} for v, r in got.items()}
    assert errors["off"] == {"youtube_transcript_api": ("IpBlocked", "first"), "yt_dlp_subtitle": ("DownloadError", "b" * 4000)}
    assert errors["both"] == {} and got["both"].transcript_text == "text"
    assert errors["later"]["youtube_transcript_api"] == ("TranscriptsDisabled", "y" * 3999 + "z")
    assert errors["later"]["yt_dlp_subtitle"][0] == "YtDlpSubtitleError"
