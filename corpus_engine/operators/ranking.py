"""Top rows per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.operators.positions import with_global_position
from corpus_engine.operators.sizing import counted


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of every group in the given total order.

    Up to the optimizer's threshold a window does it, with the limit applied before the shuffle: a
    hot group sends ``n`` rows per input partition. Beyond the threshold there is no such limit, so
    groups are counted first: those within ``n`` pass as they are, and rows of the larger ones are
    numbered by a distributed sort that splits a hot group over many tasks.
    """
    if not order_by:
        raise ValueError("top_n_per_group needs a total order; pass order_by")
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= threshold:
        window = Window.partitionBy(*keys).orderBy(*order_by)
        ranked = df.withColumn("_rank", F.row_number().over(window))
        return ranked.where(F.col("_rank") <= n).drop("_rank")

    group = [F.col(k).alias(f"_of_{k}") for k in keys]
    same_group = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    large, found = counted(sizes.where(F.col("_size") > n).drop("_size"))
    if not found:
        return df
    contested = df.join(large, same_group, "left_semi")
    placed = with_global_position(contested, [*[F.col(k) for k in keys], *order_by], "_place")
    starts = placed.groupBy(*group).agg(F.min("_place").alias("_start"))
    kept = placed.join(starts, same_group).where(F.col("_place") - F.col("_start") < n)
    return df.join(large, same_group, "left_anti").unionByName(kept.select(*df.columns))
