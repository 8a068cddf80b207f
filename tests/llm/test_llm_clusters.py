"""Centroid clusters against plain loops over exact integers, and the query beside its SQL."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import duck, normal
from corpus_engine.llm import queries
from corpus_engine.llm.centroid_clusters import Centroids, Settings, centroid_clusters, integers

SCHEMA = "vec_id long, embedding array<double>, label int, id string, x string, cluster string, distance string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "clash", "clash", "clash", "clash") for i, v in rows], schema)


def by_hand(rows, s):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == s.dimension and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(Fraction(x) * s.scale) for x in v], v) for i, v in kept]
    draw = lambda i: hashlib.sha256(f"{s.seed}{'null' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v, _ in sorted(whole, key=lambda r: (draw(r[0]), r[2]))[:s.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(s.rounds):
        inside = {}
        for _, v, _ in whole:
            inside.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(c) // len(inside[k]) for c in zip(*inside[k])] if k in inside else old for k, old in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v, _ in whole]
    fits = lambda v: v if v < 1 << 63 else None
    total = {k: sum(d for _, d, c in found if c == k) for _, _, k in found}
    return [(i, k, fits(d), fits(total[k]) if all(fits(e) is not None for _, e, c in found if c == k) else None,
             fits(sum(total.values())) if all(fits(e) is not None for _, e, _ in found) else None, ",".join(map(str, centres[k]))) for i, d, k in found]


def check(spark, rows, s):
    got = [tuple(r) for r in centroid_clusters(frame(spark, rows), s).collect()]
    assert sorted(got, key=str) == sorted(by_hand(rows, s), key=str)
    return got


def vectors(seed, n, k, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) + i % 3 for _ in range(k)]) for i in range(n)]


def test_rounds_equal_plain_loops(spark):
    got = check(spark, vectors(1, 400, 5), Settings(dimension=5, clusters=12))
    assert len({r[1] for r in got}) == 12


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [*vectors(2, 40, 3), (None, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 2.0]), (7, [0.0, -0.0, 5e-324]), (7, [-1e-300, 0.0, 0.0]), (50, None), (51, []), (52, [1.0, 2.0]),
            (53, [1.0, None, 2.0]), (54, [1.0, nan, 2.0]), (55, [1.0, inf, 2.0]), (56, [1.0, 2.0, 3.0, 4.0]), *[(60, [0.5, 0.5, 0.5])] * 30]
    got = check(spark, rows, Settings(dimension=3, clusters=6, rounds=3))
    assert len(got) == 40 + 2 + 2 + 30
    assert centroid_clusters(frame(spark, []), Settings(dimension=3)).collect() == []
    assert centroid_clusters(frame(spark, [(1, None)]), Settings(dimension=3)).collect() == []


def test_fewer_vectors_than_centroids_ties_and_equal_vectors(spark):
    check(spark, [(i, [float(i % 2), 0.0]) for i in range(5)], Settings(dimension=2, clusters=40))
    check(spark, [(i, [3.25, -1.5]) for i in range(300)], Settings(dimension=2, clusters=7, rounds=2))
    check(spark, [(i, [i * 1.0]) for i in range(-20, 21)], Settings(dimension=1, scale=1, clusters=5))


def test_components_beyond_64_bits_are_exact(spark):
    rows = [(i, [v * (-1) ** i, v / 3, float(i)]) for i, v in enumerate([1.0, 1e3, 2.0**27, 1e9, 1e15, 3e18, 1e25, 1e40, 1e40 * (1 + 2**-50), 1e300, 1.7e308, -1.7e308])]
    got = check(spark, rows, Settings(dimension=3, clusters=3, rounds=3))
    assert any(r[2] is None for r in got)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=12), st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=12))
def test_search_equals_all_distances(centres, rows):
    numbers, best, _ = Centroids(centres).nearest(np.array(rows, np.int64))
    want = [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres)) for v in rows]
    assert list(zip(best.tolist(), numbers.tolist())) == want


def test_search_passes_over_far_centroids():
    r = np.random.default_rng(1)
    centres = (r.integers(-1000, 1000, (100, 1)) + r.integers(-5, 5, (100, 16))).tolist()
    x = np.array(centres)[r.integers(0, 100, 500)] + r.integers(-3, 3, (500, 16))
    _, best, tried = Centroids(centres).nearest(x)
    assert tried < 500 * 12 and best.max() < 16 * 36


def test_floor_is_exact():
    assert integers(np.array([[0.3, -0.3, -1 / 256, 1e-320, -1e-320]]), 256).tolist() == [[76, -77, -1, 0, -1]]


@pytest.mark.parametrize("parts", [1, 7])
def test_partitions_do_not_matter(spark, parts):
    s = Settings(dimension=4, clusters=9, rounds=4)
    rows = vectors(5, 200, 4)
    got = [tuple(r) for r in centroid_clusters(frame(spark, rows).repartition(parts), s).collect()]
    assert sorted(got) == sorted(by_hand(rows, s))


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_centroid_clusters"](spark, sf)
    cursor = duck(sf).execute(queries.ORACLE["op12_centroid_clusters"])
    columns = [d[0] for d in cursor.description]
    assert normal(got.columns, got.collect()) == normal(columns, cursor.fetchall()) and sorted(got.columns) == sorted(columns)
