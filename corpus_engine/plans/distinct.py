"""Distinct ids over many runs, without reading the rows of earlier ones.

Each run stores, beside its tables, what it saw per key: bitmaps over numbered ids, which merge exactly, and sketches, which merge
within a stated error and need no numbers. Either way a count over any runs reads only these.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_engine.operators.positions import with_global_position
from corpus_engine.sources.tables import exists, staged

SKETCH_BITS = 14  # of an HLL sketch: two to this many registers


def relative_error(bits: int = SKETCH_BITS) -> float:
    """One standard deviation of a sketch's estimate."""
    return 1.04 / sqrt(2**bits)


def numbered(known: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Numbers for ids that ``known`` (``key``, ``number``) lacks, contiguous and after its largest: bitmaps stay dense."""
    fresh = ids.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key)).distinct().join(known, key, "left_anti")
    highest = known.agg(F.max("number")).first()[0] or 0
    placed = with_global_position(fresh, [F.col(key)], "_place")
    return placed.select(key, (F.col("_place") + 1 + F.lit(highest)).alias("number"))


def id_bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``bits`` of the numbers seen for each key, in buckets of 32,768; reduced in the tasks first."""
    return rows.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def id_sketches(rows: DataFrame, keys: Sequence[str], key: str, bits: int = SKETCH_BITS) -> DataFrame:
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(F.col(key).cast("string"), F.lit(bits)).alias("sketch"))


class RunDistincts:
    """The stored distincts below a folder: ``numbers``, ``bitmaps`` and ``sketches``, with a part for each run."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], key: str):
        self.spark, self.root, self.keys, self.key = spark, root.rstrip("/"), list(keys), key

    def _parts(self, kind: str) -> DataFrame | None:
        path = f"{self.root}/{kind}"
        if not exists(self.spark, path):
            return None
        return self.spark.read.option("recursiveFileLookup", "true").parquet(path)

    def store(self, rows: DataFrame, run_id: str) -> None:
        """What ``rows`` saw; storing a run once more puts the same in place. Runs are stored one after the other.

        The rows are read once: their distinct pairs are written, and numbers, bitmaps and sketches are made from those.
        """
        pairs = staged(rows.where(F.col(self.key).isNotNull()).select(*self.keys, F.col(self.key).cast("string").alias(self.key)).distinct(), "pairs")
        numbers, part = self._parts("numbers"), f"run={run_id}"
        if numbers is None:
            numbers = self.spark.createDataFrame([], f"{self.key} string, number bigint")
        own = f"{self.root}/numbers/{part}"
        if not exists(self.spark, own):
            numbered(numbers, pairs, self.key).write.mode("overwrite").parquet(own)
        numbers = self._parts("numbers")
        id_bitmaps(pairs.join(numbers, self.key), self.keys).write.mode("overwrite").parquet(f"{self.root}/bitmaps/{part}")
        id_sketches(pairs, self.keys, self.key).write.mode("overwrite").parquet(f"{self.root}/sketches/{part}")

    def exact(self, keys: Sequence[str] | None = None) -> DataFrame:
        """``n``, the distinct ids of each key over all stored runs; fewer ``keys`` (or none) merge further."""
        keys = self.keys if keys is None else list(keys)
        merged = self._parts("bitmaps").groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n"))

    def estimated(self, keys: Sequence[str] | None = None) -> DataFrame:
        """``estimate``, within :func:`relative_error` in the sense of a standard deviation."""
        keys = self.keys if keys is None else list(keys)
        return self._parts("sketches").groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
