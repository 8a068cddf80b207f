"""Which keys a large table certainly lacks, from a small table of bits.

A bit table says of a hashed key whether any stored key has the same hash. It is two bytes a stored key, is written once beside each
version, and is joined by the number of a piece of bits: a key whose bit is not set is not stored, so only the others are compared
with stored keys, and stored keys are compared only where one of the others has their hash. Comparing is by the key itself, so
equal hashes of different keys change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_engine.operators.sizing import settled_side

BITS_PER_KEY = 16
PIECE = 128  # bytes of a bitmap that travel together
PIECE_BITS = 8 * PIECE


def _number(key: Column, size: Column) -> Column:
    """The key's bit, from 1 as Spark's bitmaps count."""
    return F.pmod(F.xxhash64(key.cast("string")), size) + 1


def bit_table(stored: DataFrame, key: str, bits: int | None = None) -> DataFrame:
    """``piece``, ``bytes`` and ``size``: the bits of all non-null keys; ``bits`` in all, else some for each row of ``stored``.

    Rows are reduced in the tasks, so what is shuffled is bitmaps, and a key that stands in very many rows is one bit.
    """
    keys = stored.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    size = bits or max(PIECE_BITS, BITS_PER_KEY * keys.count())
    number = _number(F.col("_key"), F.lit(size).cast("bigint"))
    maps = keys.select(number.alias("_n")).groupBy(F.bitmap_bucket_number("_n").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("_bits"))
    pieces = 4096 // PIECE
    cut = maps.select("_bucket", "_bits", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("_i"))
    return cut.select(
        ((F.col("_bucket") - 1) * pieces + F.col("_i")).alias("piece"),
        F.substring(F.col("_bits"), F.col("_i") * PIECE + 1, F.lit(PIECE)).alias("bytes"),
        F.lit(size).cast("bigint").alias("size")).where(F.col("bytes") != F.lit(bytes(PIECE)))


def _tested(rows: DataFrame, bits: DataFrame, key: str, size: int) -> DataFrame:
    """Rows with ``_set``: whether the key's bit is set. Keys are not null."""
    placed = rows.withColumn("_n", _number(F.col(key), F.lit(size).cast("bigint")) - 1).withColumn("_piece", F.floor(F.col("_n") / PIECE_BITS))
    inside = F.col("_n") % PIECE_BITS
    byte = F.conv(F.hex(F.substring(F.col("bytes"), (F.floor(inside / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (inside % 8).cast("int")) == 1, F.lit(False))
    return placed.join(bits.select(F.col("piece").alias("_piece"), "bytes"), "_piece", "left").withColumn("_set", found).select(*rows.columns, "_set")


def possible(rows: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """Rows with ``_set``, false where the key is certainly not among those of the bit table; a null key is not."""
    size = bits.agg(F.first("size")).first()[0]
    if size is None:
        return rows.withColumn("_set", F.lit(False))
    named = rows.where(F.col(key).isNotNull())
    return _tested(named, bits, key, size).unionByName(rows.where(F.col(key).isNull()).withColumn("_set", F.lit(False)))


def known_keys(candidates: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The distinct ``candidates`` keys that ``stored`` has; of stored keys only those with the hash of a candidate are shuffled.

    The candidates' own bits, two bytes each, say which those are; they are counted, and broadcast while they are few.
    """
    asked = settled_side(candidates.select(key).distinct())
    own = settled_side(bit_table(asked, key))
    likely = possible(stored.select(F.col(key).cast("string").alias(key)), own, key).where("_set").select(key)
    return likely.join(asked, key, "left_semi").distinct()


def absent(ids: DataFrame, stored: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """Rows of ``ids`` whose key ``stored`` lacks, ``bits`` being its bit table; rows with a null key are left out."""
    tested = possible(ids.where(F.col(key).isNotNull()), bits, key)
    candidates = tested.where("_set").drop("_set")
    found = known_keys(candidates, stored, key)
    return tested.where("not _set").drop("_set").unionByName(candidates.join(found, key, "left_anti"))


def marked(rows: DataFrame, stored: DataFrame, bits: DataFrame, key: str, into: str) -> DataFrame:
    """Adds a flag: does ``stored`` have the row's key? ``bits`` is its bit table."""
    tested = possible(rows, bits, key)
    sure = tested.where("not _set").drop("_set").withColumn(into, F.lit(False))
    candidates = tested.where("_set").drop("_set")
    found = known_keys(candidates, stored, key).withColumn(into, F.lit(True))
    return sure.unionByName(candidates.join(found, key, "left").withColumn(into, F.coalesce(into, F.lit(False))))
