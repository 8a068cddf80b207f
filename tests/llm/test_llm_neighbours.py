"""Nearest neighbours: recall against all distances, and exact results where the graph holds everything."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus_engine.llm import queries
from corpus_engine.llm.common import table
from corpus_engine.llm.neighbour_graph import Settings, between, decoded, encoded, nearest_neighbours, usable

SCHEMA = "vec_id long, embedding array<double>, node string, code string, q string, id string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *["clash"] * 5) for i, v in rows], SCHEMA)


def by_hand(rows, asked, k=10):
    """(query id, rank, id, score) from all distances; a row is no candidate of its own."""
    kept = [(i, tuple(x + 0.0 for x in v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (i, v) in enumerate(kept):
        if asked(i):
            near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), j is None, j or 0) for o, (j, w) in enumerate(kept) if o != at and len(w) == len(v))
            out += [(i, rank, None if null else j, d) for rank, (d, null, j) in enumerate(near[:k], 1)]
    return out


def found(spark, rows, asked, s=Settings()):
    return [tuple(r) for r in nearest_neighbours(frame(spark, rows), asked, s).collect()]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0)
    assert [r[:3] for r in sorted(got, key=key)] == [r[:3] for r in sorted(want, key=key)]
    assert all(math.isclose(a[3], b[3], rel_tol=1e-12, abs_tol=1e-300) for a, b in zip(sorted(got, key=key), sorted(want, key=key)))


def points(seed, n, k):
    return [(i, v) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, k)).tolist())]


def test_odd_vectors_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    copies = [(1000 + i, [3.0, 3.0, 3.0]) for i in range(40)]
    rows = [*points(1, 60, 3), *copies, (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (4, [0.1, 0.0, 2.0]), (4, [0.1, -0.0, 2.0]), (2000, None), (2010, []), (2020, [0.0, -0.0, 0.0]),
            (2030, [1.0, None, 1.0]), (2040, [1.0, nan, 1.0]), (2050, [inf, 1.0, 1.0]), *((3000 + i, [i + 1.0, 2.0]) for i in range(6)), (4000, [1.0])]
    asked = lambda i: i is not None and i % 10 == 0 or i == 4
    got = found(spark, rows, (F.col("vec_id") % 10 == 0) | (F.col("vec_id") == 4))
    want = by_hand(rows, asked)
    same(got, want)
    assert {r[2] for r in got if r[0] == 1000} == {1001 + i for i in range(10)}
    assert len([r for r in got if r[0] == 3000]) == 5 and not [r for r in got if r[0] == 4000]


def test_null_ids_can_ask_and_be_found(spark):
    rows = [(None, [1.0, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 2.0]), (None, [5.0, 5.0])]
    same(found(spark, rows, F.col("vec_id").isNull()), by_hand(rows, lambda i: i is None))


def test_empty_tables_and_no_queries(spark):
    assert found(spark, [], F.lit(True)) == []
    assert found(spark, points(1, 5, 2), F.lit(False)) == []
    assert found(spark, [(1, None)], F.lit(True)) == []
    assert found(spark, [(1, [1.0])], F.lit(True)) == []


def test_extreme_sizes_do_not_break_the_search(spark):
    rows = [(i, [v, 1.0]) for i, v in enumerate([5e-324, 1e-300, 1.0, 1e150, 1.7e308, -1.7e308, 2.0])]
    got = found(spark, rows, F.lit(True))
    assert len(got) == 7 * 6 and not any(math.isnan(r[3]) for r in got)


def test_a_node_that_all_others_name(spark):
    # Points on a sphere are all nearest to its centre; their namers are dealt over cells.
    r = np.random.default_rng(3)
    shell = r.normal(size=(600, 24))
    shell = 10 * shell / np.linalg.norm(shell, axis=1, keepdims=True)
    rows = [(0, [0.01] * 24), *((i + 1, v) for i, v in enumerate(shell.tolist()))]
    got = found(spark, rows, F.col("vec_id") % 20 == 0)
    want = {r[:1] + r[2:3] for r in by_hand(rows, lambda i: i % 20 == 0)}
    assert len({r[:1] + r[2:3] for r in got} & want) >= 0.95 * len(want)


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op13_nearest_neighbours(spark, sf).collect()
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    want = by_hand(rows, lambda i: i % 100 == 0)
    assert len(got) == len(want)
    assert len({(r.query_id, r.vec_id) for r in got} & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)
    assert all(r["rank"] == k % 10 + 1 for k, r in enumerate(sorted(got, key=lambda r: (r.query_id, r.score, r.vec_id))))


@pytest.mark.parametrize("sizes", [(4, 4, 4), (1, 3, 2)])
def test_codes(sizes):
    rows = [np.random.default_rng(n).normal(size=n).tolist() for n in sizes]
    x, lengths = decoded(pa.array(encoded(pa.array(rows, pa.list_(pa.float64()))), pa.binary()))
    assert lengths.tolist() == list(sizes)
    assert all(np.abs(x[i, :n] - rows[i]).max() <= max(map(abs, rows[i])) / 250 for i, n in enumerate(sizes))
    assert (np.isinf(between(x, lengths)) == (lengths[:, None] != lengths) | np.eye(3, dtype=bool)).all()


def test_usable(spark):
    assert usable(frame(spark, [(1, [0.0]), (2, [1.0]), (3, [])]), "vec_id", "embedding").count() == 1
