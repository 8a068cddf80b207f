"""Unions of intervals and what lies between them, also where one key has very many."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.operators.positions import with_global_position

BLOCK = 4096


def preceding_reach(spans: DataFrame, keys: Sequence[str], begin: str, end: str, into: str, block: int = BLOCK) -> DataFrame:
    """The largest ``end`` among the key's spans with a smaller ``begin`` (distinct per key); null for its first one.

    A sort over all spans deals a key's spans to many tasks. Runs of ``block`` spans are one window each; what reaches into a run from
    the ones before is a running maximum over one row per run.
    """
    placed = with_global_position(spans, [*[F.col(k) for k in keys], F.col(begin)], "_place")
    placed = placed.withColumn("_block", F.floor(F.col("_place") / block))
    before = (Window.unboundedPreceding, -1)
    tops = placed.groupBy(*keys, "_block").agg(F.max(end).alias("_top"))
    across = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*before)
    carried = tops.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_block").alias("_of_block"), F.max("_top").over(across).alias("_carried"))
    local = placed.withColumn("_local", F.max(end).over(Window.partitionBy(*keys, "_block").orderBy(begin).rowsBetween(*before)))
    # Keys may be null, so they are compared as such.
    same = [F.col("_block") == F.col("_of_block"), *[F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]]
    return local.join(carried, same).select(*spans.columns, F.greatest("_local", "_carried").alias(into))


def united(spans: DataFrame, keys: Sequence[str], begin: str, end: str) -> DataFrame:
    """Each key's half-open spans merged where they overlap or touch; empty and backward ones, and those without both ends, do not count.

    With :func:`preceding_reach` the spans that begin an island are known, and where the island before it ended. An island's own end
    stands at the next island's beginning, one place further in the order of islands, or else is the key's largest end.
    """
    longest = spans.where(F.col(begin) < F.col(end)).groupBy(*keys, begin).agg(F.max(end).alias(end))
    reached = preceding_reach(longest, keys, begin, end, "_reach")
    starts = reached.where(F.col("_reach").isNull() | (F.col(begin) > F.col("_reach"))).select(*keys, begin, "_reach")
    placed = with_global_position(starts, [*[F.col(k) for k in keys], F.col(begin)], "_place")
    following = placed.where(F.col("_reach").isNotNull()).select((F.col("_place") - 1).alias("_place"), F.col("_reach").alias("_until"))
    whole = longest.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.max(end).alias("_most"))
    islands = placed.drop("_reach").join(following, "_place", "left")
    last = islands.where(F.col("_until").isNull()).drop("_until").join(whole, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return islands.where(F.col("_until").isNotNull()).select(*keys, begin, F.col("_until").alias(end)).unionByName(
        last.select(*keys, begin, F.col("_most").alias(end)))


def gaps(islands: DataFrame, keys: Sequence[str], begin: str, end: str, every: DataFrame, first, last) -> DataFrame:
    """What of ``first`` to ``last`` no island covers, for each of ``every`` key; islands lie within those bounds and are disjoint.

    Islands and keys are put in one order; what lies between an island and the next edge of its key is a gap.
    """
    edges = islands.select(*keys, F.col(begin).alias("_from"), F.col(end).alias("_to"))
    bounds = every.select(*keys).distinct()
    opened = bounds.select(*keys, F.lit(first).alias("_from"), F.lit(first).alias("_to"))
    closed = bounds.select(*keys, F.lit(last).alias("_from"), F.lit(last).alias("_to"))
    order = [*[F.col(k) for k in keys], F.col("_from"), F.col("_to")]
    placed = with_global_position(opened.unionByName(edges).unionByName(closed), order, "_place")
    after = placed.select((F.col("_place") - 1).alias("_place"), F.col("_from").alias("_next"), *[F.col(k).alias(f"_of_{k}") for k in keys])
    met = placed.join(after, "_place")
    for k in keys:
        met = met.where(F.col(k).eqNullSafe(F.col(f"_of_{k}")))
    return met.where(F.col("_next") > F.col("_to")).select(*keys, F.col("_to").alias(begin), F.col("_next").alias(end))
