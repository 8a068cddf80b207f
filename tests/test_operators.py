import random

import pytest
from pyspark.sql import functions as F

from corpus_engine.operators import ordering as o
from corpus_engine.operators.positions import id_batches, preceding_total, with_global_position
from corpus_engine.operators.ranking import top_n_per_group
from corpus_engine.operators.resume import mark_known, pending, refresh_columns
from tests.helpers import values

HITS = "k string, v int, _run_id string, _seq long"


def hot_rows(n=3000, keys=200, seed=3):
    """A third of all rows under one key, the rest spread."""
    rnd = random.Random(seed)
    order = list(range(n))
    rnd.shuffle(order)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(keys)}", i, f"r{i % 4}", order[i]) for i in range(n)]


def test_upsert_keeps_last_and_unites_columns(spark):
    old = spark.createDataFrame([("a", 1, "r1", 0), (None, 2, "r1", 1), ("c", 3, "r1", 2)], HITS)
    new = spark.createDataFrame(
        [("a", 9, "x", "r2", 0), (None, 8, "y", "r2", 1), ("d", 7, "z", "r2", 2), ("d", 6, "w", "r2", 3)],
        "k string, v int, extra string, _run_id string, _seq long")
    got = o.upsert(old, new, ["k"])
    assert got.columns == ["k", "v", "_run_id", "_seq", "extra"]
    assert values(got, "k", "v", "extra") == [(None, 8, "y"), ("a", 9, "x"), ("c", 3, None), ("d", 6, "w")]


def test_replace_rows_equals_upsert(spark):
    rows = [r for r in hot_rows(900, 50)] + [(None, 1, "r0", -5), (None, 2, "r3", -5)]
    df = spark.createDataFrame(rows, HITS).repartition(3)
    old = o.keep_last(df.where("_run_id < 'r2'"), ["k"])
    new = df.where("_run_id >= 'r2'")
    assert values(o.replace_rows(old, new, ["k"]), "k", "v") == values(o.upsert(old, new, ["k"]), "k", "v")
    assert "extra" in o.replace_rows(old, new.withColumn("extra", F.lit(1)), ["k"]).columns


def test_upsert_without_key_column_keeps_all(spark):
    old = spark.createDataFrame([("a", 1, "r1", 0), ("a", 2, "r1", 1)], HITS)
    assert o.upsert(old, old, ["absent"]).count() == 4


def test_upsert_is_idempotent_on_hot_keys(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, HITS).repartition(7)
    want = {}
    for k, v, run, seq in sorted(rows, key=lambda r: (r[2], r[3])):
        want[k] = v
    once = o.upsert(df.where("_run_id < 'r2'"), df.where("_run_id >= 'r2'"), ["k"])
    assert dict(values(once, "k", "v")) == want
    assert values(o.upsert(once, once, ["k"]), "k", "v") == values(once, "k", "v")


def test_order_is_required(spark):
    df = spark.createDataFrame([("a", 1, "r", 0)], HITS)
    for call in (lambda: o.keep_last(df, ["k"], []), lambda: o.first_seen(df, "k", []),
                 lambda: top_n_per_group(df, ["k"], [], 1)):
        with pytest.raises(ValueError):
            call()


def test_first_seen_and_first_n(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows + [(None, 0, "r0", -1)], HITS).repartition(5)
    want = []
    for k, *_ in sorted(rows, key=lambda r: (r[2], r[3])):
        if k not in want:
            want.append(k)
    seen = [r.k for r in o.first_seen(df, "k").orderBy("_run_id", "_seq").collect()]
    assert seen == want
    assert [r.k for r in o.first_n(df, "k", 10).orderBy("_run_id", "_seq").collect()] == want[:10]


@pytest.mark.parametrize("inclusive", [True, False])
def test_cut_at_first(spark, inclusive):
    rows = [("r1", 1, "ok"), ("r1", 2, "stop"), ("r1", 3, "ok"), ("r1", 4, "stop"), ("r2", 1, "ok"), ("r2", 2, "ok")]
    df = spark.createDataFrame(rows, "run string, seq long, s string")
    got = o.cut_at_first(df, "run", "seq", F.col("s") == "stop", inclusive)
    kept = [("r1", 1), ("r1", 2), ("r2", 1), ("r2", 2)] if inclusive else [("r1", 1), ("r2", 1), ("r2", 2)]
    assert values(got, "run", "seq") == kept


@pytest.mark.parametrize("n", [1, 20, 700, 1500])
def test_top_n_per_group(spark, n):
    rows = hot_rows(6000, keys=3)
    df = spark.createDataFrame(rows, HITS).repartition(6)
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        groups.setdefault(r[0], []).append(r[1])
    want = sorted((k, v) for k, vs in groups.items() for v in vs[:n])
    got = top_n_per_group(df, ["k"], [F.col("_run_id"), F.col("_seq")], n)
    assert got.columns == df.columns
    assert values(got, "k", "v") == want


@pytest.mark.parametrize("bound,block", [(None, 16), (None, 1024), (5000, 16), (900, 1024)])
def test_preceding_total(spark, bound, block):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 5}", i, rnd.randrange(5)) for i in range(900)]
    totals, want = {}, []
    for g, p, a in rows:
        want.append((g, p, totals.get(g, 0)))
        totals[g] = totals.get(g, 0) + a
    df = spark.createDataFrame(rows, "g string, p long, a long").repartition(5)
    got = preceding_total(df, ["g"], "p", "a", "before", group_bound=bound, block=block)
    assert values(got, "g", "p", "before") == sorted(want)


def test_global_positions_and_batches(spark):
    ids = [(f"id{i:04d}", (i * 7919) % 1237) for i in range(1237)]
    df = spark.createDataFrame(ids, "id string, place long").repartition(6)
    got = with_global_position(df, [F.col("place")], "pos")
    assert all(r.pos == r.place for r in got.collect())
    batches = {r.batch: r for r in id_batches(df, "id", [F.col("place")], 50).collect()}
    ordered = [i for i, _ in sorted(ids, key=lambda r: r[1])]
    assert len(batches) == 25 and batches[24].n_ids == 37
    assert all(batches[b].ids.split(",") == ordered[b * 50:b * 50 + 50] for b in batches)


def test_pending(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    state = spark.createDataFrame([("a", "success"), ("b", "failed")], "k string, s string")
    assert values(pending(ids, state, "k"), "k") == [("c",)]
    assert values(pending(ids, state, "k", F.col("s") == "success"), "k") == [("b",), ("c",)]
    assert values(pending(ids, state, "k", resume=False), "k") == [("a",), ("b",), ("c",)]
    open_ids = pending(ids, state, "k")
    done = ids.join(state, "k", "left_semi")
    assert open_ids.count() + done.count() == ids.where("k is not null").count()


def test_mark_known(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert values(mark_known(df, known, "k", "seen"), "v", "seen") == [(1, True), (2, False), (3, False)]


def test_refresh_columns(spark):
    base = spark.createDataFrame([("a", 1, "stale"), ("b", 2, "stale")], "k string, v int, s string")
    fresh = spark.createDataFrame(
        [("a", "old", "r1", 0), ("a", "new", "r2", 0)], "k string, s string, _run_id string, _seq long")
    assert values(refresh_columns(base, fresh, "k", ["s"]), "k", "v", "s") == [("a", 1, "new"), ("b", 2, None)]
    empty = fresh.where("false")
    assert values(refresh_columns(base, empty, "k", ["s"]), "k", "s") == [("a", None), ("b", None)]
