"""What is still to do, what is already known, and refreshing merged columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine.operators.membership import absent, marked
from corpus_engine.operators.ordering import ARRIVAL, keep_last
from corpus_engine.operators.sizing import settled_side


def pending(
    ids: DataFrame, state: DataFrame, key: str, done_when: Column | None = None, resume: bool = True, bits: DataFrame | None = None
) -> DataFrame:
    """Rows of ``ids`` whose key is not finished in ``state``; a null key is never pending.

    ``bits``, the bit table of all of ``state``, spares ids that certainly are not in it the comparison, and ``state`` the shuffle.
    """
    wanted = ids.where(F.col(key).isNotNull())
    if not resume:
        return wanted
    if bits is not None:
        return absent(wanted, state if done_when is None else state.where(done_when), bits, key)
    done = state if done_when is None else state.where(done_when)
    return wanted.join(done.select(F.col(key).cast("string").alias(key)), key, "left_anti")


def mark_known(df: DataFrame, known: DataFrame, key: str, into: str, bits: DataFrame | None = None) -> DataFrame:
    """Adds a flag: does the row's key occur in ``known``, of which ``bits`` may be the bit table?

    The rows' keys are counted when the frame is built and broadcast while they are few, so a large ``known`` is reduced
    to those before it is shuffled.
    """
    if bits is not None:
        return marked(df, known, bits, key, into)
    asked = settled_side(df.where(F.col(key).isNotNull()).select(key).distinct())
    found = known.join(asked, key, "left_semi").select(key).distinct().withColumn("_found", F.lit(True))
    return (
        df.join(found, key, "left")
        .withColumn(into, F.coalesce(F.col("_found"), F.lit(False)))
        .select(*df.columns, into)
    )


def conform(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """The schema's columns in order, absent ones as typed nulls, plus those of ``extra`` present."""
    cols = [
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols, *[c for c in extra if c in df.columns])


def refresh_columns(
    base: DataFrame, fresh: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str] = ARRIVAL, unique: bool = False
) -> DataFrame:
    """Replaces ``columns`` of ``base`` by the latest values in ``fresh``; unmatched rows get nulls.

    ``unique``: ``fresh`` has one row per key already, as a published table has, and need not be ranked.
    """
    order = [c for c in order_by if c in fresh.columns]
    latest = fresh if unique else keep_last(fresh.select(key, *columns, *order), [key], order)
    return base.drop(*columns).join(latest.select(key, *columns), key, "left")
