"""Distinct ids that merge over runs, and bits that say which keys a table lacks."""

import random

import pytest
from pyspark.sql import functions as F

from corpus_engine.operators.membership import absent, bit_table, known_keys, marked, possible
from corpus_engine.operators.resume import mark_known, pending
from corpus_engine.plans.distinct import RunDistincts, relative_error
from corpus_engine.plans.study import Study, StudyOptions, run_study
from tests.helpers import values
from tests.test_study import land


def test_distincts_over_runs(spark, tmp_path):
    r = random.Random(4)
    runs = {f"r{k}": [(r.choice("abc"), None if r.random() < 0.05 else r.randint(0, 40_000 if k == 2 else 300)) for _ in range(3000)] for k in range(3)}
    runs["r3"] = runs["r0"]  # nothing new
    stored = RunDistincts(spark, str(tmp_path), ["q"], "v")
    seen = []
    for name, rows in runs.items():
        stored.store(spark.createDataFrame(rows, "q string, v bigint"), name)
        seen += rows
        want = sorted((q, len({v for k, v in seen if k == q and v is not None})) for q in "abc")
        assert values(stored.exact(), "q", "n") == want
    assert stored.exact([]).first()["n"] == len({v for _, v in seen if v is not None})
    for row in stored.estimated().collect():
        assert abs(row["estimate"] - dict(want)[row["q"]]) <= 5 * relative_error() * dict(want)[row["q"]] + 1
    before = values(stored.exact(), "q", "n")
    stored.store(spark.createDataFrame(runs["r1"], "q string, v bigint"), "r1")  # a run stored once more
    assert values(stored.exact(), "q", "n") == before
    numbers = stored._parts("numbers")
    assert numbers.agg(F.max("number")).first()[0] == numbers.count() == len({v for _, v in seen if v is not None})


def test_counting_reads_only_what_was_stored(spark, tmp_path):
    stored = RunDistincts(spark, str(tmp_path / "d"), ["q"], "v")
    stored.store(spark.createDataFrame([("a", None)], "q string, v string"), "r0")
    assert stored.exact().count() == 0 and stored.exact([]).first()["n"] is None
    stored.store(spark.createDataFrame([("a", "x"), (None, "x"), ("a", "x")], "q string, v string"), "r1")
    assert values(stored.exact(), "q", "n") == [(None, 1), ("a", 1)]
    scans = [line for line in stored.exact()._jdf.queryExecution().executedPlan().toString().splitlines() if "Location" in line]
    assert scans and all("bits#" in line for line in scans)


def frames(spark, n=400, m=90):
    stored = spark.createDataFrame([(f"k{i % n}", i) for i in range(2 * n)] + [(None, 0)], "k string, x int")
    ids = spark.createDataFrame([(f"k{i * 7}", i) for i in range(m)] + [(None, -1), ("k0", -2), ("", -3)], "k string, y int")
    return stored, ids


@pytest.mark.parametrize("bits", [None, 1024, 1 << 20])
def test_bits_change_no_row(spark, bits):
    stored, ids = frames(spark)
    table = bit_table(stored, "k", bits)
    assert values(absent(ids, stored, table, "k"), "k", "y") == values(pending(ids, stored, "k"), "k", "y") == values(pending(ids, stored, "k", bits=table), "k", "y")
    want = values(mark_known(ids, stored, "k", "known"), "k", "y", "known")
    assert values(marked(ids, stored, table, "k", "known"), "k", "y", "known") == want == values(mark_known(ids, stored, "k", "known", table), "k", "y", "known")
    assert (None, -1, False) in want and ("k0", -2, True) in want
    done = F.col("x") < 10
    assert values(pending(ids, stored, "k", done, bits=table), "k", "y") == values(pending(ids, stored, "k", done), "k", "y")
    assert pending(ids, stored, "k", resume=False, bits=table).count() == 92


def test_bits_say_no_only_of_what_is_not_stored(spark):
    stored, ids = frames(spark, 2000, 3000)
    tested = possible(ids.where("k is not null"), bit_table(stored, "k"), "k")
    inside = {f"k{i}" for i in range(2000)}
    rows = tested.collect()
    assert all(r["_set"] for r in rows if r["k"] in inside)
    wrong = sum(r["_set"] for r in rows if r["k"] not in inside)
    assert wrong < 0.15 * len(rows)  # one bit in eight or so is set
    assert possible(ids, bit_table(stored.limit(0), "k"), "k").where("_set").count() == 0


def test_only_likely_keys_are_shuffled(spark):
    """Stored keys are a hundred times the new ones; what joins by key is what has the hash of a candidate."""
    stored = spark.range(50_000).selectExpr("concat('s', id) as k")
    asked = spark.createDataFrame([(f"s{i}",) for i in range(0, 5000, 10)], "k string")
    found = known_keys(asked, stored, "k")
    assert found.count() == 500
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_piece" in plan and plan.count("Exchange hashpartitioning(k#") <= 2
    own = bit_table(asked, "k")
    assert possible(stored, own, "k").where("_set").count() < 50_000 * 0.15


def test_a_study_keeps_bits_of_its_versions(spark, tmp_path):
    base, options = str(tmp_path / "data"), StudyOptions(member_bits=True, stages=["discovery", "videos", "channels"])
    land(tmp_path / "in1", "r1", ["a", "b"])
    run_study(spark, base, "p", str(tmp_path / "in1"), options, "r1", "x")
    study = Study(spark, base, "p")
    assert study.bits("videos").count() > 0 and study.bits("comments") is None
    land(tmp_path / "in2", "r2", ["b", "c"])
    report = run_study(spark, base, "p", str(tmp_path / "in2"), options, "r2", "y").first()
    assert report.stages.videos.requested == 1 and report.stages.channels.requested == 1
    assert values(study.read("videos"), "video_id", "captured_at") == [("a", "x"), ("b", "x"), ("c", "y")]


def test_a_run_is_read_once(spark, tmp_path):
    """Ids that differ whenever they are read: numbers and bitmaps are of the same reading."""
    drawn = F.udf(lambda: __import__("uuid").uuid4().hex).asNondeterministic()
    stored = RunDistincts(spark, str(tmp_path), ["query"], "video_id")
    stored.store(spark.range(40).select(F.lit("q").alias("query"), drawn().alias("video_id")), "r1")
    assert [tuple(r) for r in stored.exact().collect()] == [("q", 40)]
