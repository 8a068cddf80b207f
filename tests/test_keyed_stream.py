"""Streams that remember the newest row of each key."""

import os
import random

import pytest
from pyspark.sql import functions as F

from checks import streams
from corpus_engine import schemas
from corpus_engine.operators.ordering import keep_last
from corpus_engine.sources.tables import COMPLETE
from corpus_engine.streaming import keyed
from corpus_engine.streaming.keyed import KINDS, keep_newest, newest_rows
from tests.helpers import landing_line, values, write_lines


def page(run, seq, **titles):
    return landing_line(run_id=run, seq=seq, response='{"items": [%s]}' % ", ".join(
        '{"id": "%s", "snippet": {"title": "%s"}}' % item for item in titles.items()))


@pytest.fixture
def stream(spark, tmp_path):
    class Stream:
        landing, table = str(tmp_path / "in"), str(tmp_path / "videos")

        def land(self, name, *lines):
            write_lines(tmp_path / "in", name, lines)
            os.utime(tmp_path / "in" / name, (int(name), int(name)))  # batches take files by age

        def run(self, kind="videos"):
            keep_newest(spark, self.landing, kind, self.table, str(tmp_path / "checkpoint"), F.col("run_id"), files_per_batch=1).awaitTermination()

        def rows(self, kind="videos", *columns):
            return values(newest_rows(spark, self.table, kind), *(columns or ("video_id", "title")))

        def changes(self):
            """What each batch gave out."""
            folders = sorted(p for p in (tmp_path / "videos.changes").iterdir() if (p / COMPLETE).exists())
            return [values(spark.read.parquet(str(p)), "video_id", "title") for p in folders]

        def at_once(self, kind="videos"):
            whole = spark.read.schema(KINDS[kind].envelope).json(self.landing)
            return keep_last(KINDS[kind].rows(whole, F.col("run_id")), KINDS[kind].keys, ("captured_at", "_run_id", "_seq"))

    return Stream()


def test_a_batch_gives_out_only_what_it_changed(spark, stream):
    stream.land("1", page("2026-02", 1, a="feb", b="feb"), page("2026-02", 2, b="feb, again", c="feb"))
    stream.run()
    stream.land("2", page("2026-01", 1, a="late", d="late"))
    stream.land("3", page("2026-02", 1, a="feb", b="feb"), page("2026-02", 2, b="feb, again", c="feb"))
    stream.run()  # a restart from the checkpoint
    stream.land("4", page("2026-03", 1, c="mar"), page("2026-03", 2))
    stream.run()
    stream.run()  # nothing new
    assert stream.changes() == [[("a", "feb"), ("b", "feb, again"), ("c", "feb")], [("d", "late")], [], [("c", "mar")]]
    assert stream.rows() == [("a", "feb"), ("b", "feb, again"), ("c", "mar"), ("d", "late")] == values(stream.at_once(), "video_id", "title")


def test_of_equal_arrivals_the_first_one_counts(spark, stream):
    stream.land("1", page("r1", 1, a="first"))
    stream.run()
    stream.land("2", page("r1", 1, a="changed in silence"))
    stream.run()
    assert stream.rows() == [("a", "first")] and stream.changes() == [[("a", "first")], []]


def test_unreadable_and_empty_pages(spark, stream):
    stream.land("1", landing_line(run_id="r1", seq=1, response='{"items": [{"id": "cut'), landing_line(run_id="r1", seq=2, response=None),
                landing_line(run_id="r1", seq=3, response='{"items": [{"snippet": {"title": "no id"}}, null]}'), "no json at all")
    stream.run()
    stream.land("2", page("r2", 1, a="x"))
    stream.run()
    assert stream.rows() == values(stream.at_once(), "video_id", "title") and stream.rows()[-1] == ("a", "x")
    assert newest_rows(spark, stream.table + "-other", "videos") is None


def test_a_repeated_batch_changes_nothing(spark, stream, tmp_path):
    """The driver died after a batch was written, before it was noted as done."""
    stream.land("1", page("r1", 1, a="one", b="one"))
    stream.run()
    stream.land("2", page("r2", 1, a="two"))
    stream.run()
    before = stream.changes()
    for note in (tmp_path / "checkpoint" / "commits").glob("*1*"):
        note.unlink()
    stream.run()
    assert stream.changes() == before and stream.rows() == [("a", "two"), ("b", "one")]


def test_comments_and_captions(spark, stream):
    thread = '{"items": [{"id": "t1", "snippet": {"totalReplyCount": "2", "topLevelComment": {"id": "c1", "snippet": {"textDisplay": "%s"}}}}]}'
    stream.land("1", landing_line(run_id="r1", seq=1, video_id="v", page_number=1, error=None, response=thread % "old"),
                landing_line(run_id="r2", seq=1, video_id="v", page_number=1, error="HttpError 500", response=None))
    stream.land("2", landing_line(run_id="r3", seq=1, video_id="v", page_number=1, error=None, response=thread % "new"))
    stream.run("threads")
    assert stream.rows("threads", "comment_id", "thread_id", "text", "total_reply_count", "captured_at") == [("c1", "t1", "new", 2, "r3")]


def test_failed_caption_calls_are_rows_too(spark, stream):
    track = dict(run_id="r1", seq=1, video_id="v", language="pt", is_generated=False, list_pos=0, captions=[dict(text="a", start=0.0, duration=1.0)])
    stream.land("1", landing_line(**track), landing_line(run_id="r1", seq=2, video_id="w", error_type="Disabled", error_message="m"))
    stream.land("2", landing_line(**{**track, "run_id": "r2", "captions": []}))
    stream.run("captions")
    got = values(newest_rows(spark, stream.table, "captions").select("video_id", "language", F.size("captions").alias("n"), "error_type", "captured_at"),
                 "video_id", "language", "n", "error_type", "captured_at")
    assert got == [("v", "pt", 0, None, "r2"), ("w", None, got[1][2], "Disabled", "r1")]


def test_every_kind_names_its_rows(spark):
    for kind, spec in KINDS.items():
        rows = spec.rows(spark.createDataFrame([], spec.envelope), F.col("run_id"))
        assert {*spec.keys, "captured_at", "_run_id", "_seq"} <= set(rows.columns), kind
        assert rows.schema["_seq"].dataType.simpleString() == schemas.SEQ.simpleString()


def test_all_tasks_land_and_a_batch_takes_a_runs_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "scratch_path", lambda *_: str(tmp_path))
    pages = spark.range(60).repartition(6).selectExpr("'r1' as run_id", "id as seq", """concat('{"items":[{"id":"', id, '","snippet":{"title":"t"}}]}') as response""")
    rows = values(streams._taken_in(spark, "videos", pages, "title"), "video_id", "title")
    landed = len(list((tmp_path / "landing").glob("part-*.json")))
    assert 5 * 5 <= landed <= 5 * 6  # with few pages, a task may have none of a run
    assert len(list((tmp_path / "videos.changes").glob("batch=*"))) <= 7
    run = lambda i: "r3" if i % 5 == 0 else "r2" if i % 3 else "r1"
    assert rows == sorted((str(i), f"{run(i)} t") for i in range(60) if i % 5 == 0 or i % 3 or i % 2 == 0)


def test_state_holds_places_not_rows(spark, stream, tmp_path):
    """State is many versions of each key; with the texts in it, it outgrew the pages."""
    texts = {f"v{i}": "%x" % random.Random(i).getrandbits(40_000) for i in range(60)}
    for number in range(1, 4):
        stream.land(str(number), page(f"r{number}", 1, **texts))
        stream.run()
    size = {name: sum(p.stat().st_size for p in (tmp_path / name).rglob("*") if p.is_file()) for name in ("in", "checkpoint")}
    assert size["checkpoint"] < size["in"] / 4
    assert stream.rows() == sorted(texts.items())


def test_rows_are_found_by_their_whole_place(spark, stream):
    """A page twice in a file is one, an item that comes again on a page is the last, other files' rows of the same place do not count."""
    twice = page("r1", 1, a="a", b="b")
    again = landing_line(run_id="r1", seq=2, response='{"items": [{"id": "c", "snippet": {"title": "1"}}, {"id": "c", "snippet": {"title": "2"}}, {"id": null}]}')
    stream.land("1", twice, twice, again)
    stream.land("2", page("r1", 1, a="other", d="d"), landing_line(run_id=None, seq=None, response='{"items": [{"id": "e"}]}'))
    stream.run()
    assert stream.changes() == [[(None, None), ("a", "a"), ("b", "b"), ("c", "2")], [("d", "d"), ("e", None)]]
    assert stream.rows("videos", "video_id", "captured_at", "_run_id") == [
        (None, "r1", "r1"), ("a", "r1", "r1"), ("b", "r1", "r1"), ("c", "r1", "r1"), ("d", "r1", "r1"), ("e", None, None)]


def test_files_of_odd_names(spark, stream, tmp_path):
    for name, item in (("a b.json", "a"), ("c%20d.json", "c"), ("e[1].json", "e")):
        write_lines(tmp_path / "in", name, [page("r1", 1, **{item: name})])
    stream.run()
    assert stream.rows() == [("a", "a b.json"), ("c", "c%20d.json"), ("e", "e[1].json")]


def test_the_capture_is_the_streams(spark, stream, tmp_path):
    """A capture that is no function of the page, such as the time, is noted once."""
    stream.land("1", page("r1", 1, a="one"))
    keep_newest(spark, stream.landing, "videos", stream.table, str(tmp_path / "checkpoint"), F.current_timestamp().cast("string")).awaitTermination()
    row = newest_rows(spark, stream.table, "videos").first()
    assert row["title"] == "one" and row["captured_at"]
    assert spark.read.parquet(f"{stream.table}.changes/*").where("cast(captured_at as timestamp) = _taken").count() == 1


def test_settings_are_the_streams_own(spark, stream):
    before = {name: spark.conf.get(name, None) for name in keyed.SETTINGS}
    stream.land("1", page("r1", 1, a="one"))
    stream.run()
    assert {name: spark.conf.get(name, None) for name in keyed.SETTINGS} == before


def test_comment_pages_are_decoded_once(spark):
    """A filter on the items, pushed below, would decode the response again."""
    for kind in ("threads", "replies"):
        pages = spark.createDataFrame([], KINDS[kind].envelope).repartition(2)  # else the plan is an empty table
        plan = KINDS[kind].rows(pages, F.col("run_id"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1, kind


def test_packed_landings_are_compressed_and_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "scratch_path", lambda *_: str(tmp_path))
    seen, keep = [], streams.keep_newest

    def spied(spark, landing, *more, **options):
        seen.append(sorted(p.name.partition(".")[2] for p in (tmp_path / "landing").glob("part-*")))
        assert 1 <= options["files_per_batch"] <= 6
        return keep(spark, landing, *more, **options)

    monkeypatch.setattr(streams, "keep_newest", spied)
    pages = spark.range(60).repartition(6).selectExpr("'r1' as run_id", "id as seq", """concat('{"items":[{"id":"', id, '","snippet":{"title":"t"}}]}') as response""")
    rows = values(streams._taken_in(spark, "videos", pages, "title", packed=True), "video_id", "title")
    assert [set(names) for names in seen] == [{"json.gz"}] * 3 and [len(names) > 9 for names in seen] == [False, True, True]
    assert not (tmp_path / "landing").exists()
    run = lambda i: "r3" if i % 5 == 0 else "r2" if i % 3 else "r1"
    assert rows == sorted((str(i), f"{run(i)} t") for i in range(60) if i % 5 == 0 or i % 3 or i % 2 == 0)
