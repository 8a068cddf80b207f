"""Operators whose result depends on arrival order, each with that order as an argument.

``row_number() <= 1`` is planned with a group limit in front of the shuffle, so every input
partition sends at most one row per key: a key holding a third of all rows costs its reducer one
row per partition and no more.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.operators.sizing import settled_side

ARRIVAL = ("_run_id", "_seq")


def _require(order_by: Sequence, what: str) -> None:
    if not order_by:
        raise ValueError(f"{what} needs a total order; pass order_by")


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ARRIVAL) -> DataFrame:
    """The latest row of every key; null keys equal each other. Absent key columns mean no dedupe."""
    _require(order_by, "keep_last")
    if not set(keys) <= set(df.columns):
        return df
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order_by])


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ARRIVAL) -> DataFrame:
    """The earliest row of every key."""
    _require(order_by, "keep_first")
    return _one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order_by])


def upsert(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Union by name (absent columns become null, existing columns first), then the latest per key."""
    return keep_last(existing.unionByName(new, allowMissingColumns=True), keys, order_by)


def replace_rows(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Upsert into a table that is unique per key and older than every new row.

    Stored rows are only checked against the arriving keys: they are neither sorted nor, while the
    new keys are few enough for the optimizer to broadcast, shuffled.
    """
    latest = keep_last(new, keys, order_by)
    arriving = latest.select([F.col(k).alias(f"_new_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    kept = existing.join(arriving, reduce(and_, same), "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def first_seen(df: DataFrame, key: str, order_by: Sequence[str] = ARRIVAL) -> DataFrame:
    """Distinct non-null values of ``key`` as text, with the order columns of their first row."""
    _require(order_by, "first_seen")
    order = F.struct(*[F.col(c) for c in order_by])
    return (
        df.where(F.col(key).isNotNull())
        .select(F.col(key).cast("string").alias(key), order.alias("_first"))
        .groupBy(key)
        .agg(F.min("_first").alias("_first"))
        .select(key, "_first.*")
    )


def first_n(df: DataFrame, key: str, n: int, order_by: Sequence[str] = ARRIVAL) -> DataFrame:
    """The first ``n`` distinct values of ``key`` in arrival order."""
    return first_seen(df, key, order_by).orderBy(*order_by).limit(n)


def cut_at_first(
    df: DataFrame, run_key: str, seq: str, stop: Column, inclusive: bool
) -> DataFrame:
    """Rows of each run up to the first one where ``stop`` holds, with or without that row.

    The cuts, one narrow row for each run that has one, are worked out and counted when the frame is
    built, and broadcast while they are few; so rows of a run are neither gathered nor shuffled by it.
    """
    cuts = settled_side(df.where(stop).groupBy(run_key).agg(F.min(seq).alias("_cut")))
    joined = df.join(cuts, run_key, "left")
    before = (F.col(seq) <= F.col("_cut")) if inclusive else (F.col(seq) < F.col("_cut"))
    return joined.where(F.col("_cut").isNull() | before).select(*df.columns)
