"""Running positions without gathering a whole group, or the whole table, in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.session import shared_dir

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits


def preceding_total(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    amount: str,
    into: str,
    group_bound: int | None = None,
    block: int = 1024,
) -> DataFrame:
    """Sum of ``amount`` over the group's rows before each row, by ``position`` (distinct integers).

    A group known to hold at most ``block`` rows is one window. Otherwise groups are cut into
    blocks of positions: totals per block (one row each) are summed first and carried into a
    window per block, so no task sorts more than ``block`` rows of one group.
    """
    before = (Window.unboundedPreceding, -1)
    if group_bound is not None and group_bound <= block:
        window = Window.partitionBy(*keys).orderBy(position).rowsBetween(*before)
        return df.withColumn(into, F.coalesce(F.sum(amount).over(window), F.lit(0)))

    blocked = df.withColumn("_block", F.floor(F.col(position) / block))
    totals = blocked.groupBy(*keys, "_block").agg(F.sum(amount).alias("_total"))
    across = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*before)
    carried = totals.select(*keys, "_block", F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_carried"))
    within = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(*before)
    local = blocked.withColumn("_local", F.coalesce(F.sum(amount).over(within), F.lit(0)))
    return (
        local.join(carried, [*keys, "_block"])
        .withColumn(into, F.col("_local") + F.col("_carried"))
        .select(*df.columns, into)
    )


def with_global_position(df: DataFrame, order_by: Sequence[Column], into: str) -> DataFrame:
    """Contiguous 0-based positions over the whole table in the given total order.

    A range sort spreads the rows; each then knows its partition and its place in it. The sorted
    rows are checkpointed because their partition bounds must not change between counting and
    numbering, nor when an executor is lost. The offsets hold one row per partition.
    """
    shared_dir(df.sparkSession)
    numbered = df.orderBy(*order_by).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_mid", ROW_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    across = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(across), F.lit(0)).alias("_offset"))
    place = F.col("_mid").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per sorted partition
        .withColumn(into, F.col("_offset") + place)
        .select(*df.columns, into)
    )


def id_batches(ids: DataFrame, key: str, order_by: Sequence[Column], size: int = 50) -> DataFrame:
    """Ids in order, cut into request batches: ``batch``, ``n_ids`` and the comma-joined ``ids``."""
    placed = with_global_position(ids, order_by, "_position")
    member = F.struct(F.col("_position"), F.col(key).alias("id"))
    return (
        placed.groupBy(F.floor(F.col("_position") / size).alias("batch"))
        .agg(F.array_sort(F.collect_list(member)).alias("_members"))  # at most `size` members
        .select(
            "batch",
            F.size("_members").cast("bigint").alias("n_ids"),
            F.array_join(F.col("_members.id"), ",").alias("ids"),
        )
    )
