"""Physical plans: pruned scans, limits before shuffles, no Python, no cross product of data."""

import pytest

from checks import queries
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "discovery_review", "upsert_hits", "upsert_by_query_and_video", "pick_caption",
    "channel_expansion"])
def test_group_limit_before_shuffle(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"ingest_stream", "csv_roundtrip", "id_batches", "comment_threads_all", "study_run", "study_run_resumed", "study_run_videos"}))
def test_no_python_and_no_nested_loops(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    for slow in ("Python", "CartesianProduct", "MapInPandas"):
        assert slow not in plan, slow
    assert "NestedLoop" not in plan


def test_scans_read_only_what_is_used(spark):
    plan = physical(QUERIES["strategy_coverage"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_returnflag:string>" in plan
    assert "sha2" not in physical(QUERIES["discovery_review"](spark, SF))


@pytest.mark.parametrize("name", ["comment_threads_capped", "comments_until_failure"])
def test_comment_pages_are_decoded_before_the_plan_and_ranked_without_their_text(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    assert "from_json" not in plan and "WindowGroupLimit" not in plan
    assert not any("text" in line for line in plan.splitlines() if "Window" in line)


@pytest.mark.parametrize("name", ["quota_cut", "comment_run_outcomes"])
def test_cuts_do_not_shuffle_runs(spark, name):
    assert "hashpartitioning(run_id" not in physical(QUERIES[name](spark, SF)).replace("hashpartitioning(run_id#", "hashpartitioning(run_id").split("video_id")[0]


def test_failing_comment_pages_are_made_once(spark):
    threads, replies, _ = queries._flawed(spark, SF)
    assert not any("documents" in f for pages in (threads, replies) for f in pages.inputFiles())
