import json

import pytest

from corpus_engine import schemas
from corpus_engine.plans import expansion, review, search_plan
from corpus_engine.plans.study import Study, StudyOptions, run_study
from tests.helpers import landing_line, values, write_lines


def land(root, run, videos, failed_captions=()):
    """Everything one small run would leave behind."""
    write_lines(root / "search", f"{run}.json", [
        landing_line(run_id=run, seq=0, theme="t", query="q", search_order="relevance", page_number=1, response={
            "items": [{"id": {"videoId": v}, "snippet": {"channelId": f"c{v}", "title": v}} for v in videos]})])
    write_lines(root / "videos", f"{run}.json", [
        landing_line(run_id=run, seq=0, response={"items": [
            {"id": v, "snippet": {"channelId": f"c{v}", "title": f"{v}-{run}"}, "contentDetails": {"duration": "PT1M"}} for v in videos]})])
    write_lines(root / "channels", f"{run}.json", [
        landing_line(run_id=run, seq=0, response={"items": [{"id": f"c{v}"} for v in videos]})])
    write_lines(root / "captions", f"{run}.json", [
        landing_line(video_id=v, language="pt", is_generated=False, list_pos=0, captions=[{"text": f"said {v}", "start": 0.0, "duration": 1.0}])
        for v in videos if v not in failed_captions])
    write_lines(root / "threads", f"{run}.json", [
        landing_line(run_id=run, seq=i, video_id=v, page_number=1, response={"items": [
            {"id": f"t{v}", "snippet": {"totalReplyCount": 1, "topLevelComment": {"id": f"k{v}", "snippet": {"textDisplay": "hi"}}}}]})
        if v != "off" else landing_line(run_id=run, seq=i, video_id=v, page_number=1, error="403 commentsDisabled")
        for i, v in enumerate(videos)])
    write_lines(root / "replies", f"{run}.json", [
        landing_line(run_id=run, seq=50 + i, video_id=v, thread_id=f"t{v}", parent_id=f"k{v}", page_number=1,
                     response={"items": [{"id": f"k{v}.1", "snippet": {"textOriginal": "yo"}}]})
        for i, v in enumerate(videos)])


def test_two_runs_resume(spark, tmp_path):
    first, second, base = tmp_path / "in1", tmp_path / "in2", str(tmp_path / "data")
    land(first, "r1", ["a", "b", "off"], failed_captions=["b"])
    report = run_study(spark, base, "p", str(first), StudyOptions(formats=("parquet", "csv")), "r1", "2026-01-01T00:00:00Z").collect()[0]
    assert report.stages.discovery.asDict() == {
        "new_rows": 3, "total_rows": 3, "unique_videos": 3, "pages_quota": 0, "pages_failed": 0, "pages_unreadable": 0}
    assert report.stages.videos.asDict() == {"requested": 3, "new_rows": 3, "total_rows": 3}
    assert (report.stages.transcripts.successes, report.stages.transcripts.failures) == (2, 1)
    assert report.stages.transcripts.methods == {"youtube_transcript_api_manual": 2, "failed": 1}
    assert report.stages.comments.asDict() == {"requested": 3, "new_rows": 4, "total_rows": 4}
    saved = [json.loads(p.read_text()) for p in (tmp_path / "data/p/audit/runs/run_r1").glob("part-*")]
    assert json.loads(saved[0]["config"])["max_comments_per_video"] == 500
    assert saved[0]["run_id"] == "r1" and saved[0]["outputs"]["root"].endswith("/p")

    study = Study(spark, base, "p")
    for table, (schema, _, _) in schemas.TABLES.items():
        assert study.read(table).schema.fieldNames()[:len(schema)] == schema.fieldNames(), table
    assert values(study.read("videos"), "video_id", "transcript_text") == [("a", "said a"), ("b", None), ("off", "said off")]
    assert values(study.read("comments_status"), "video_id", "status", "rows_collected") == [
        ("a", "completed", 2), ("b", "completed", 2), ("off", "comments_disabled", 0)]

    land(second, "r2", ["a", "b", "new"])
    report = run_study(spark, base, "p", str(second), None, "r2", "2026-01-02T00:00:00Z").collect()[0]
    assert report.stages.videos.asDict() == {"requested": 1, "new_rows": 1, "total_rows": 4}
    assert report.stages.channels.asDict() == {"requested": 1, "new_rows": 1, "total_rows": 4}
    assert (report.stages.transcripts.requested, report.stages.transcripts.successes) == (2, 2)
    assert report.stages.comments.asDict() == {"requested": 1, "new_rows": 2, "total_rows": 6}
    assert values(study.read("videos"), "video_id", "title", "transcript_text") == [
        ("a", "a-r1", "said a"), ("b", "b-r1", "said b"), ("new", "new-r2", "said new"), ("off", "off-r1", "said off")]
    # a third run over the same landing finds nothing to do
    report = run_study(spark, base, "p", str(second), None, "r3", "2026-01-03T00:00:00Z").collect()[0]
    assert [report.stages[s].requested for s in ("videos", "channels", "transcripts", "comments")] == [0, 0, 0, 0]


def test_recapture_keeps_transcripts(spark, tmp_path):
    land(tmp_path / "in", "r1", ["a"])
    base = str(tmp_path / "data")
    run_study(spark, base, "p", str(tmp_path / "in"), None, "r1", "x")
    only = StudyOptions(stages=["videos"], resume=False)
    run_study(spark, base, "p", str(tmp_path / "in"), only, "r2", "y")
    assert values(Study(spark, base, "p").read("videos"), "captured_at", "transcript_text") == [("y", "said a")]


def test_subtitle_files_and_speech(spark, tmp_path):
    source = tmp_path / "in"
    land(source, "r1", ["a", "b", "c", "d"], failed_captions=["a", "b", "c", "d"])
    (source / "subtitles").mkdir()
    (source / "subtitles/a.pt-BR.vtt").write_bytes("WEBVTT\n\n1\n00:01.000 --> 00:02.000\n<c>olá</c> não\n".encode("latin-1"))
    (source / "subtitles/a.en.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nsrt\n")
    (source / "subtitles/b.en.json3").write_text('{"events":[{"segs":[{"utf8":"from"},{"utf8":"json"}]}]}')
    (source / "subtitles/c.fr.vtt").write_text("WEBVTT\n\nnot wanted\n")
    write_lines(source / "speech", "r1.json", [
        landing_line(video_id="c", language="pt", model_size="small", segments=[{"text": " heard ", "start": 1.0, "end": 2.5}])])
    run_study(spark, str(tmp_path / "data"), "p", str(source), None, "r1", "x")
    study = Study(spark, str(tmp_path / "data"), "p")
    assert values(study.read("transcripts"), "video_id", "transcript_method", "transcript_language", "transcript_text") == [
        ("a", "yt_dlp_subtitle", "pt-BR", "olá não"), ("b", "yt_dlp_subtitle", "en", "from json"),
        ("c", "faster_whisper_small", "pt", "heard"), ("d", "failed", None, None)]
    assert values(study.read("transcript_segments"), "video_id", "segment_index", "start_seconds", "duration_seconds", "text") == [
        ("c", 0, 1.0, 1.5, "heard")]
    errors = study.read("videos").where("video_id = 'd'").first().transcript_error
    assert sorted(errors) == ["whisper", "youtube_transcript_api", "yt_dlp_subtitle"]


def test_quota_ends_comment_run(spark, tmp_path):
    land(tmp_path / "in", "r1", ["a", "b", "c"])
    threads = tmp_path / "in/threads/r1.json"
    lines = threads.read_text().splitlines()
    lines[1] = landing_line(run_id="r1", seq=1, video_id="b", page_number=1, error="403 quotaExceeded")
    threads.write_text("\n".join(lines))
    run_study(spark, str(tmp_path / "data"), "p", str(tmp_path / "in"), None, "r1", "x")
    study = Study(spark, str(tmp_path / "data"), "p")
    assert values(study.read("comments_status"), "video_id", "status") == [("a", "completed"), ("b", "quota_exceeded")]
    assert values(study.read("comments").where("not is_reply"), "video_id") == [("a",)]


def test_preconditions(spark, tmp_path):
    for bad in ({"stages": ["nope"]}, {"max_pages_per_query": 0}, {"formats": ["xml"]}):
        with pytest.raises(ValueError):
            StudyOptions(**bad)
    with pytest.raises(RuntimeError):
        run_study(spark, str(tmp_path), "p", str(tmp_path / "nothing"), StudyOptions(stages=["videos"]))
    with pytest.raises(ValueError):
        Study(spark, str(tmp_path), " ")


def test_search_plan(spark):
    themes = {"t": ["a ", "b", "a", " "], "u": ["c"]}
    grid = search_plan.search_plan(spark, themes, start_date="2026-01-01", end_date="2026-01-03", window_days=2, orders=["date", "relevance"])
    assert grid.count() == 3 * 2 * 2 and grid.select("search_id").distinct().count() == 12
    open_grid = search_plan.request_parameters(search_plan.search_plan(spark, {"t": ["q"]}), region_code=None)
    assert json.loads(open_grid.first().request) == {
        "part": "snippet", "q": "q", "type": "video", "maxResults": 50, "order": "relevance", "relevanceLanguage": "pt"}
    for call in (lambda: search_plan.search_plan(spark, {"t": [" "]}), lambda: search_plan.search_plan(spark, {"t": ["q"]}, orders=["best"]),
                 lambda: search_plan.request_parameters(grid, 51)):
        with pytest.raises(ValueError):
            call()


def test_review(spark):
    hits = spark.createDataFrame(
        [("q", 2, "a", "r", 0), ("q", 1, "b", "r", 1), ("q", 1, "a", "r", 2), ("q", 3, "c", "r", 3), (None, 1, "z", "r", 4), ("p", 9, "x", "r", 5)],
        "query string, result_position long, video_id string, _run_id string, _seq long")
    videos = spark.createDataFrame([("a", "T")], "video_id string, title string").selectExpr(
        "*", *[f"cast(null as string) {c}" for c in review.DETAILS if c != "title"])
    got = review.ordered_review(review.discovery_review(hits, videos, per_query=2)).collect()
    assert [(r.query, r.result_position, r.video_id, r.title, r.relevance_label) for r in got] == [
        ("p", 9, "x", None, ""), ("q", 1, "a", "T", ""), ("q", 1, "b", None, "")]
    # the tie at position 1 goes to the earlier arrival
    assert values(review.best_hits(hits, 1).where("query = 'q'"), "video_id") == [("b",)]
    assert values(review.review_counts(review.best_hits(hits, 2)), "query", "n_videos") == [("p", 1), ("q", 2)]


def test_expansion(spark):
    hits = spark.createDataFrame([("c1", "a", "r", 0), (None, "b", "r", 1), ("c2", "b", "r", 2), ("c3", "z", "r", 3)],
                                 "channel_id string, video_id string, _run_id string, _seq long")
    channels = spark.createDataFrame([("c1", "C1", "U1"), ("c2", "C2", None), ("c3", "C3", "U3")],
                                     "channel_id string, channel_title string, uploads_playlist_id string")

    def item(video, day):
        return {"contentDetails": {"videoId": video, "videoPublishedAt": f"{day}T00:00:00Z"}, "snippet": {"title": video}}

    page = json.dumps({"items": [item("a", "2026-09-02"), item("n", "2026-09-03"), item("a", "2026-09-02"), item("o", "2026-08-31")]})
    pages = spark.createDataFrame([(c, 1, page) for c in ("c1", "c2", "c3")], "channel_id string, page_number long, response string")
    got = expansion.channel_expansion(hits, channels, pages, "2026-09-01", "2026-09-16", max_channels=2)
    assert values(got, "channel_id", "position_in_page", "video_id", "already_in_search", "new_vs_search") == [
        ("c1", 1, "a", True, False), ("c1", 2, "n", False, True)]
    assert values(expansion.expansion_counts(got), "candidates", "already_found", "new_videos") == [(2, 1, 1)]


def test_a_failed_search_page_ends_a_strict_run(spark, tmp_path):
    land(tmp_path / "in", "r1", ["a"])
    write_lines(tmp_path / "in" / "search", "failed.json", [
        landing_line(run_id="r1", seq=9, theme="t", query="q", search_order="relevance", page_number=2, error="HttpError 500 backendError")])
    options = dict(stages=["discovery", "videos"])
    with pytest.raises(RuntimeError, match="1 search pages failed"):
        run_study(spark, str(tmp_path / "data"), "p", str(tmp_path / "in"), StudyOptions(strict_search=True, **options), "r1", "x")
    assert Study(spark, str(tmp_path / "data"), "p").read("search_hits").count() == 0
    report = run_study(spark, str(tmp_path / "data"), "p", str(tmp_path / "in"), StudyOptions(**options), "r2", "x").first()
    assert (report.stages.discovery.pages_failed, report.stages.discovery.new_rows) == (1, 1)
