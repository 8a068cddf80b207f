"""Interval unions, covered time, and the history of runs."""

import json
import random

import pytest
from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.operators import intervals
from corpus_engine.plans import run_history
from corpus_engine.plans.time_coverage import time_coverage
from tests.helpers import values, write_lines


def by_hand(spans):
    """Merged half-open spans of each key."""
    out = {}
    for key, begin, end in sorted((s for s in spans if s[1] is not None and s[2] is not None and s[1] < s[2]), key=lambda s: (s[0] or "", s[1])):
        made = out.setdefault(key, [])
        if made and begin <= made[-1][1]:
            made[-1][1] = max(made[-1][1], end)
        else:
            made.append([begin, end])
    return sorted(((k, b, e) for k, made in out.items() for b, e in made), key=str)


def spans_of(spark, rows):
    return spark.createDataFrame(rows, "k string, b bigint, e bigint")


@pytest.mark.parametrize("block", [3, 4096])
def test_unions_over_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(intervals.preceding_reach, "__defaults__", (block,))
    r = random.Random(block)
    rows = [(r.choice(["a", "a", "b", None]), b, b + r.randint(-2, 9)) for b in (r.randint(0, 400) for _ in range(150))]
    rows += [("a", 0, 300), ("c", 5, 5), ("d", None, 3), ("d", 3, None), ("e", 1, 2), ("e", 2, 3)]  # one span over many blocks
    got = intervals.united(spans_of(spark, rows), ["k"], "b", "e").collect()
    assert sorted((tuple(x) for x in got), key=str) == by_hand(rows)


def test_gaps_of_keys_with_and_without_spans(spark):
    islands = spans_of(spark, [("a", 0, 3), ("a", 5, 10), ("b", 2, 4), (None, 0, 1)])
    every = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "k string")
    got = values(intervals.gaps(islands, ["k"], "b", "e", every, 0, 10), "k", "b", "e")
    assert got == [(None, 1, 10), ("a", 3, 5), ("b", 0, 2), ("b", 4, 10), ("c", 0, 10)]


def page(run, seq, query, after, before, number=1, error=None, order="date"):
    return run, seq, "t", query, order, after, before, number, error, None


def test_covered_time(spark):
    day = lambda n: f"2024-01-{n:02d}T00:00:00Z"
    pages = spark.createDataFrame([
        page("r1", 1, "q", day(1), day(3)), page("r1", 2, "q", day(2), day(5)),  # overlapping
        page("r1", 3, "q", day(5), day(6)),  # touching
        page("r1", 4, "q", day(7), day(9)), page("r1", 5, "q", day(7), day(9), 2, "HttpError 500"),  # second page failed for good
        page("r1", 6, "q", day(7), day(8), 1, "HttpError 500"), page("r2", 1, "q", day(7), day(8)),  # read by a later run
        page("r1", 7, "q", day(20), day(25), 1, None, "date"), page("r1", 8, "q", day(20), day(25), 1, "HttpError 500", "viewCount"),
        page("r2", 9, "q", day(26), day(27)), page("r3", 1, "q", day(26), day(27), 1, "HttpError 500"),  # the latest outcome counts
        page("r1", 9, "open", None, day(2)), page("r1", 10, "open", day(30), None), page("r1", 11, "open", "no time", day(9)),
        page("r1", 12, "never", day(1), day(9), 1, "HttpError 500"), page("r1", 13, "beyond", "2020-01-01T00:00:00Z", "2030-01-01T00:00:00Z"),
    ], schemas.SEARCH_ENVELOPE)
    got = values(time_coverage(pages, day(1), "2024-02-01T00:00:00Z"), "query", "kind", "begin", "end")
    end = "2024-02-01T00:00:00Z"
    assert got == sorted([
        ("beyond", "covered", day(1), end), ("never", "missing", day(1), end),
        ("open", "covered", day(1), day(2)), ("open", "covered", day(30), end), ("open", "missing", day(2), day(30)),
        ("q", "covered", day(1), day(6)), ("q", "covered", day(20), day(25)), ("q", "covered", day(7), day(8)),
        ("q", "missing", day(25), end), ("q", "missing", day(6), day(7)), ("q", "missing", day(8), day(20))])
    assert time_coverage(pages.limit(0), day(1), day(9)).count() == 0
    for start, stop in ((day(9), day(1)), ("x", day(1)), (day(1), day(1))):
        with pytest.raises(ValueError):
            time_coverage(pages, start, stop)


def test_a_hot_query_is_many_windows(spark):
    spans = spark.range(20_000).selectExpr("'hot' as k", "id * 10 as b", "id * 10 + if(id % 7 = 0, 11, 9) as e")
    made = intervals.preceding_reach(spans, ["k"], "b", "e", "reach", block=100)
    assert "_block" in made._jdf.queryExecution().executedPlan().toString()
    assert intervals.united(spans, ["k"], "b", "e").count() == 20_000 - (20_000 + 6) // 7 + (19_999 % 7 == 0)


def test_reports_of_several_releases(spark, tmp_path):
    old = dict(run_id="r1", project="p", stages=dict(discovery=dict(new_rows=5, unique_videos=3), videos=dict(requested=3, new_rows=2, total_rows=2)))
    new = dict(run_id="r2", host="h", stages=dict(transcripts=dict(requested=4, failures=1, methods=dict(a=1, b=2)), videos=dict(requested="many", total_rows=7)))
    for name, line in (("run_r1", old), ("run_r2", new), ("run_r3", dict(run_id="r3", stages=None)), ("run_r4", dict(stages=dict(videos=dict(requested=1))))):
        write_lines(tmp_path / "audit" / "runs" / name, "part-0.json", [json.dumps(line)])
    write_lines(tmp_path / "audit" / "runs" / "run_r5", "part-0.json", ['{"run_id": "cut', ""])
    reports = run_history.stored_reports(spark, str(tmp_path))
    assert ("r2", "transcripts", "methods", '{"a": 1, "b": 2}') in values(reports, "run_id", "stage", "metric", "value")
    assert values(run_history.stage_history(reports), "run_id", "stage", "requested", "new_rows", "total_rows", "failures") == [
        ("r1", "discovery", None, 5, None, None), ("r1", "videos", 3, 2, 2, None),
        ("r2", "transcripts", 4, None, None, 1), ("r2", "videos", None, None, 7, None)]


def test_recovery(spark):
    rows = [("videos", "r1", "a", False), ("videos", "r1", "a", True), ("videos", "r1", "b", False), ("videos", "r2", "b", False), ("videos", "r3", "b", True),
            ("videos", "r3", "c", None), ("videos", "r1", None, False), ("channels", "r2", "b", True), ("channels", "r3", "b", False)]
    attempts = spark.createDataFrame(rows, "stage string, run_id string, item string, ok boolean")
    assert values(run_history.recovery(attempts), "stage", "run_id", "attempted", "failed", "recovered", "rate") == [
        ("channels", "r2", 1, 0, 0, None), ("channels", "r3", 1, 1, 0, 0.0),
        ("videos", "r1", 2, 1, 1, 1.0), ("videos", "r2", 1, 1, 1, 1.0), ("videos", "r3", 2, 1, 0, 0.0)]


def test_sessions_and_peaks(spark):
    hour = 3600
    at = [0, 10, 10, 10 + 29 * 60, 10 + 60 * 60, 23 * hour, 24 * hour - 1, 24 * hour, 24 * hour + 10, 50 * hour, 74 * hour - 1, 74 * hour]
    rows = [("videos", "r1", "x", i % 3 > 0, t) for i, t in enumerate(at)] + [("videos", "r1", "x", True, None), ("channels", "r2", "y", None, 5)]
    calls = spark.createDataFrame(rows, "stage string, run_id string, item string, ok boolean, s bigint").withColumn("at", F.timestamp_seconds("s"))
    sessions = run_history.call_sessions(calls).select("run_id", F.unix_seconds("begin").alias("b"), F.unix_seconds("end").alias("e"), "calls", "failed")
    assert values(sessions.where("run_id = 'r1'"), "b", "e", "calls") [:2] == [(0, 10 + 29 * 60, 4), (10 + 3600, 10 + 3600, 1)]
    assert values(sessions.where("run_id = 'r2'"), "b", "calls", "failed") == [(5, 1, 1)]
    most = max((sum(t - 24 * hour < u <= t for u in at), -t) for t in at)
    for frame in (calls, calls.withColumn("at", F.col("at").cast("timestamp_ntz"))):
        peaks = run_history.peak_calls(frame).select("stage", "calls", F.unix_seconds("until").alias("u"))
        assert values(peaks, "stage", "calls", "u") == [("channels", 1, 5), ("videos", most[0], -most[1])]
    assert values(run_history.peak_calls(calls, ()).select("calls"), "calls") == [(max(sum(t - 24 * hour < u <= t for u in [*at, 5]) for t in at),)]


@pytest.mark.parametrize("span", [run_history.DAY, 3 * run_history.HOUR + 7, 5])
def test_peaks_are_running_totals(spark, span):
    r, hour = random.Random(span), run_history.HOUR
    rows = [(r.choice(["a", "b", None]), r.choice([0, -30 * hour, 90 * hour]) + r.choice([r.randrange(40 * hour), r.randrange(9), r.randrange(4) * hour, span])) for _ in range(400)]
    calls = spark.createDataFrame(rows, "stage string, us bigint").withColumn("at", F.timestamp_micros("us"))
    peaks = run_history.peak_calls(calls, span=span)
    want = {}
    for key, until in rows:
        found = (sum(k == key and until - span < at <= until for k, at in rows), -until)
        want[key] = max(want.get(key, found), found)
    assert {k: (n, -u) for k, n, u in peaks.select("stage", "calls", F.unix_micros("until")).collect()} == want
    # A frame that slides is summed anew for each row, over all rows of the stretch.
    assert "RangeFrame, -" not in peaks._jdf.queryExecution().executedPlan().toString()
