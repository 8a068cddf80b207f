"""Centroid clustering by the equal-average equal-variance search, exact in integers.

A vector of ``dimension`` finite components becomes integers, floor(scale * x). The first centroids are the vectors with the
smallest hashes of their ids. In each round every vector goes to its nearest centroid (squared Euclidean distance; ties: the
smaller number), then a centroid becomes the exact floor of its vectors' mean; one without vectors stays. In the end the vectors are
assigned once more.

The search (:class:`Centroids`) has the centroids sorted by their component sum. A vector starts at its own sum and looks
outward, the centroid of the nearer sum first. With k components, sums S and deviations V (V*V = k * sum of squares - S*S) of vector and
centroid, k * distance >= (S - S')**2 + (V - V')**2. So when the next sum is too far for the best distance so far, the vector is done
(all others are farther), and a centroid whose deviation is too far is passed over. Both tests are taken in floating point with
a margin on the safe side; what they leave is settled by the exact integer distance.

The centroids are k * dimension numbers, broadcast in each round. A round reads the vectors once; tasks add up their own vectors, and what is
shuffled and sent to the driver are a task's sums and k * dimension totals. Nothing is grouped by vector, so equal vectors are no
hot key.

Defined results: vectors that are null, of another length, or with null or non-finite components are left out; with fewer
vectors than centroids there are as many centroids as vectors; an empty table gives no row; repeated rows each give a row, and
equal ids are ordered by their vectors; a null id counts as the text "null". Components of any finite size are exact; a
distance or sum beyond 64 bits is null. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.llm.common import prepare, settled

BATCH = 4096  # vectors that a task works on at a time
FITS = 1 << 27  # components below this have squared distances below 2**63 in up to 128 dimensions
HUGE = 1 << 1000
# Far above the rounding of sums and deviations (a share of the components' sizes), and of the tests on them.
ROUNDING, MARGIN = 1e-12, 1 - 1e-9
LIMB = 1 << 48  # sums travel in pieces of this size, so that adding them up stays within 64 bits
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    dimension: int = 64
    scale: int = 256
    clusters: int = 40
    rounds: int = 5
    seed: str = "2:"


def usable(vectors: DataFrame, s: Settings, key: str, vector: str) -> DataFrame:
    """``id`` and ``x`` (doubles) of the vectors that take part."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where((F.size("x") == s.dimension) & finite)


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit integers where all fit, else as Python's."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * scale)
    if not x.size or np.abs(scaled).max() < FITS:
        return scaled.astype(np.int64)
    exact = [int(y) if abs(y) < 2**53 else int(v) * scale if abs(v) >= 2**53 else math.floor(y) for y, v in zip(scaled.ravel().tolist(), x.ravel().tolist())]
    return np.array(exact, object).reshape(x.shape)


def squares(rows: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(1)


def floats(rows: np.ndarray) -> np.ndarray:
    """As doubles; integers that are too large become infinite."""
    if rows.dtype != object:
        return rows.astype(np.float64)
    return np.array([float(v) if abs(v) < HUGE else (math.inf if v > 0 else -math.inf) for v in rows.ravel().tolist()]).reshape(rows.shape)


class Centroids:
    """Centroids in the order of their sums, ready to be searched."""

    def __init__(self, rows: list[list[int]]):
        wide = max((abs(v) for row in rows for v in row), default=0) >= FITS
        self.rows = np.array(rows, object if wide else np.int64)
        sums, deviations, slack = self._facts(self.rows)
        order = np.lexsort((np.arange(len(rows)), sums))
        self.numbers, self.sums, self.deviations, self.sorted = order, sums[order], deviations[order], self.rows[order]
        self.slack = slack.max()

    @staticmethod
    def _facts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Component sums, deviations times the root of the number of components, and more than the rounding of either."""
        v = floats(rows)
        k = v.shape[1]
        with np.errstate(over="ignore", invalid="ignore"):
            sums = v.sum(1)
            centred = v - sums[:, None] / k
            return sums, np.sqrt(k * (centred * centred).sum(1)), ROUNDING * k * np.abs(v).sum(1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row the number of the nearest centroid and the squared distance; and how many distances were worked out."""
        centres, n, k = self.sorted, len(x), x.shape[1]
        if x.dtype == object or centres.dtype == object or k > 128:
            x, centres = x.astype(object), centres.astype(object)
        sums, deviations, slack = self._facts(x)
        slack = slack + self.slack
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        best, number, tried, last = np.zeros(n, x.dtype), np.full(n, -1), 0, len(self.sums) - 1

        def least(gap: np.ndarray, rows: np.ndarray) -> np.ndarray:
            return np.nan_to_num(np.maximum(np.abs(gap) - slack[rows], 0), nan=0, posinf=math.inf)

        active = np.arange(n)
        with np.errstate(over="ignore", invalid="ignore"):
            while len(active):
                u, d = up[active], down[active]
                above = least(self.sums[np.minimum(u, last)] - sums[active], active)
                below = least(sums[active] - self.sums[np.maximum(d, 0)], active)
                upward = (u <= last) & ((d < 0) | (above <= below))
                gap, at = np.where(upward, above, below), np.where(upward, u, d)
                up[active] += upward
                down[active] -= ~upward
                first, bound = number[active] < 0, floats(best[active]) * k
                left = (at >= 0) & (first | ~(gap * gap * MARGIN > bound))  # else every other sum is farther still
                active, at, gap, first, bound = active[left], at[left], gap[left], first[left], bound[left]
                apart = least(deviations[active] - self.deviations[at], active)
                tested = first | ~((gap * gap + apart * apart) * MARGIN > bound)
                which, centre = active[tested], at[tested]
                distance, label = squares(x[which] - centres[centre]), self.numbers[centre]
                tried += len(which)
                better = (number[which] < 0) | (distance < best[which]) | ((distance == best[which]) & (label < number[which]))
                best[which[better]], number[which[better]] = distance[better], label[better]
        return number, best, tried


def batched(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and integer vectors, some thousands at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, s.dimension)
            yield part.column("id").to_pylist(), integers(x, s.scale)


def first_centroids(rows: DataFrame, s: Settings) -> list[list[int]]:
    """The vectors of the smallest hashes: at most ``clusters`` rows come to the driver."""
    draw = F.sha2(F.concat(F.lit(s.seed), F.coalesce(F.col("id").cast("string"), F.lit("null"))).cast("binary"), 256)
    drawn = rows.withColumn("draw", draw).orderBy("draw", "x").limit(s.clusters).select("draw", "x").collect()
    return [integers(np.array([r["x"]], np.float64), s.scale)[0].tolist() for r in drawn]


def moved(spark: SparkSession, rows: DataFrame, centroids: list[list[int]], s: Settings) -> list[list[int]]:
    """The centroids after one round."""
    held = spark.sparkContext.broadcast(Centroids(centroids))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = {}, {}
        for _, x in batched(batches, s):
            numbers, _, _ = held.value.nearest(x)
            for c in np.unique(numbers).tolist():
                inside = x[numbers == c]
                sums[c] = sums.get(c, 0) + inside.sum(0).astype(object)
                counts[c] = counts.get(c, 0) + len(inside)
        out = [(c, -1, 0, n) for c, n in counts.items()]
        for c, total in sums.items():
            for place, v in enumerate(total.tolist()):
                sign, rest, limb = (1 if v >= 0 else -1), abs(v), 0
                while rest:
                    rest, low = divmod(rest, LIMB)
                    out.append((c, place, limb, sign * low))
                    limb += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(col, pa.int64()) for col in zip(*out)], ["cluster", "place", "limb", "part"])

    parts = rows.mapInArrow(add, "cluster long, place long, limb long, part long")
    totals = parts.groupBy("cluster", "place", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect()
    held.unpersist()
    sums, counts = {}, {}
    for r in totals:
        if r["place"] < 0:
            counts[r["cluster"]] = int(r["part"])
        else:
            at = (r["cluster"], r["place"])
            sums[at] = sums.get(at, 0) + int(r["part"]) * LIMB ** r["limb"]
    return [[sums.get((c, i), 0) // counts[c] for i in range(s.dimension)] if c in counts else old for c, old in enumerate(centroids)]


def centroid_clusters(vectors: DataFrame, s: Settings = Settings(), key="vec_id", vector="embedding") -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid`` (its components as text)."""
    spark = vectors.sparkSession
    prepare(spark, BATCH)
    rows = usable(vectors, s, key, vector)
    centroids = first_centroids(rows, s)
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid string")
    for _ in range(s.rounds):
        centroids = moved(spark, rows, centroids, s)
    held = spark.sparkContext.broadcast(Centroids(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in batched(batches, s):
            numbers, distances, _ = held.value.nearest(x)
            fit = [d if d <= LONG else None for d in distances.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(fit, pa.int64())], ["vec_id", "cluster", "distance"])

    assigned = settled(rows.mapInArrow(assign, "vec_id long, cluster int, distance long"), "centroid-assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    complete = F.count("distance") == F.count(F.lit(1))
    sums = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.when(complete, exact).alias("total")).collect()}
    fitting = lambda v: int(v) if v is not None and v <= LONG else None
    whole = fitting(sum(sums.values())) if None not in sums.values() else None
    facts = [(c, fitting(v), whole, ",".join(map(str, centroids[c]))) for c, v in sums.items()]  # a row for each cluster
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
