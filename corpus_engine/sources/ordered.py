"""Tables of files whose order is the rows' order: evaluation files that people read from top to bottom.

A range sort deals the rows over files, nulls last; each file is sorted and its name carries its number. A manifest says which
rows each file holds and where it begins, so rows are read back in order, or a file looked up, without a sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine.sources.tables import read_csv, write_csv

PART = r"part-(\d+)-"


def write_ordered(df: DataFrame, path: str, order_by: Sequence[str], files: int = 1) -> DataFrame:
    """Writes CSV files in the order of the given columns, nulls last, and their manifest, which is returned.

    ``files`` is how many, at most; one file is what a reviewer opens, more let a table of any size be sorted and written in parallel. Rows
    equal in ``order_by`` may stand in any order, so it should name a row.
    """
    if not order_by or files < 1:
        raise ValueError("an ordered table needs columns to order by and a file to write")
    order = [F.col(c).asc_nulls_last() for c in order_by]
    ranged = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    write_csv(ranged, f"{path}/rows")
    manifest = _manifest(df.sparkSession, f"{path}/rows", df.schema, order_by)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return read_manifest(df.sparkSession, path)


def _manifest(spark: SparkSession, rows: str, schema: T.StructType, order_by: Sequence[str]) -> DataFrame:
    """``number``, ``file``, ``n_rows``, ``first`` and ``last``: the bounds are texts of the ordering columns, as they stand in the files."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields if not f.name.startswith("_")])
    bounds = F.struct(*[F.col(c) for c in order_by if c in texts.names])
    # A file is one split, since its cells may hold line breaks; row numbers within it follow the file.
    seen = spark.read.schema(texts).csv(rows, header=True, multiLine=True, escape='"', enforceSchema=True).select(
        F.col("_metadata.file_name").alias("file"), bounds.alias("_at"), F.monotonically_increasing_id().alias("_row"))
    return seen.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min_by("_at", "_row").alias("first"), F.max_by("_at", "_row").alias("last"),
    ).select(F.regexp_extract("file", PART, 1).cast("int").alias("number"), "file", "n_rows", "first", "last")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def read_ordered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows with their ``place``, from 1, in the order of the files: partition after partition, with neither sort nor shuffle.

    A frame for each file; the manifest, a row for each, comes to the driver.
    """
    files = sorted((r["number"], r["file"], r["n_rows"]) for r in read_manifest(spark, path).select("number", "file", "n_rows").collect())
    parts, before = [], 0
    for _, file, n_rows in files:
        rows = read_csv(spark, f"{path}/rows/{file}", schema)
        parts.append(rows.withColumn("place", F.monotonically_increasing_id() + F.lit(before + 1)))
        before += n_rows
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("place", T.LongType())]))
    return reduce(DataFrame.union, parts)
