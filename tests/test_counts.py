"""Counts taken while tables are written, and histograms of free text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpus_engine.operators.sizing import Observed
from corpus_engine.plans import report
from corpus_engine.plans.study import run_study
from tests.helpers import values
from tests.test_study import land


def executed(spark):
    """Plans of all queries so far, by number."""
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {found.apply(i).executionId(): found.apply(i).physicalPlanDescription() for i in range(found.size())}


def test_a_run_reads_no_table_only_to_count_it(spark, tmp_path):
    land(tmp_path / "in", "r1", ["a", "b", "off"], failed_captions=["b"])
    before = set(executed(spark))
    run_study(spark, str(tmp_path / "data"), "p", str(tmp_path / "in"), None, "r1", "x")
    plans = {n: p for n, p in executed(spark).items() if n not in before}
    writes = [p for p in plans.values() if "InsertIntoHadoopFsRelationCommand" in p]
    assert len(writes) > 10 and any("CollectMetrics" in p for p in writes)
    for plan in plans.values():
        if plan not in writes:
            counting = re.search(r"Aggregate.*\n(?:.*\n)*?.*Keys: \[\]", plan) and "count(" in plan
            assert not (counting and re.search(r"Scan (parquet|json|csv)", plan)), plan


def test_rows_are_counted_by_the_write(spark, tmp_path):
    rows = spark.range(1000).repartition(7)
    seen = Observed(rows, even=F.count_if(F.col("id") % 2 == 0), top=report.top_sketch("id % 3"))
    seen.frame.write.parquet(str(tmp_path / "t"))
    assert (seen["rows"], seen["even"]) == (1000, 500)
    assert report.exact_from_sketch(seen["top"]) == {"0": 334, "1": 333, "2": 333}
    empty = Observed(rows.where("false"))
    empty.frame.write.parquet(str(tmp_path / "empty"))
    assert empty["rows"] == 0


def frame(spark, items):
    return spark.createDataFrame([(v,) for v in items], "v string")


def by_hand(items, k):
    counts = {}
    for v in items:
        counts[v] = counts.get(v, 0) + 1
    named = sorted(((v, n) for v, n in counts.items() if v is not None), key=lambda r: (-r[1], r[0]))
    rows = [("value", v, n) for v, n in named[:k]]
    rows += [("other", None, sum(n for _, n in named[k:]))] * (len(named) > k) + [("null", None, counts.get(None))] * (None in counts)
    return sorted(rows, key=str)


@pytest.mark.parametrize("k, tracked", [(3, 10_000), (3, 8), (50, 64), (1, 2)])
def test_top_values_are_exact(spark, k, tracked):
    r = random.Random(k)
    items = ["null"] * 40 + [None] * 30 + ["", " "] * 9 + [f"v{int(r.paretovariate(0.8))}" for _ in range(500)] + [f"once{i}" for i in range(200)]
    r.shuffle(items)
    got = report.top_values(frame(spark, items).repartition(5), "v", k, tracked).collect()
    assert sorted((tuple(x) for x in got), key=str) == by_hand(items, k)


def test_top_values_of_ties_and_nothing(spark):
    items = [f"t{i:03d}" for i in range(300)]  # all as rare: the sketch proves nothing
    assert values(report.top_values(frame(spark, items), "v", 5, 16), "kind", "value", "n_rows") == [
        ("other", None, 295), *(("value", f"t{i:03d}", 1) for i in range(5))]
    assert report.top_values(frame(spark, []), "v").count() == 0
    assert values(report.top_values(frame(spark, [None, None]), "v"), "kind", "value", "n_rows") == [("null", None, 2)]


def test_a_summary_tells_nulls_from_their_name(spark):
    rows = spark.createDataFrame([("null",), (None,), ("a",)], "transcript_method string")
    want = {"methods": {"a": 1, "null": 1}, "methods_null": 1, "methods_other": 0}
    assert report.method_summary(rows) == want
    sketch = rows.agg(report.top_sketch("transcript_method").alias("s")).first()["s"]
    assert report.method_summary(rows, sketch) == want
    many = spark.createDataFrame([(f"m{i:04d}",) for i in range(300)], "transcript_method string")
    sketch = many.agg(report.top_sketch("transcript_method").alias("s")).first()["s"]
    assert report.exact_from_sketch(sketch) is None and report.method_summary(many, sketch)["methods_other"] == 200
