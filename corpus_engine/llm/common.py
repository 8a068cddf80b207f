"""What the operators share: reading tables, settling results, words, and files that executors write."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from corpus_engine.session import scratch_path

# Fixed value: the white space of the word pattern [^\x20\x09-\x0D]+; bytes.split() splits on exactly these.
SPACES = b" \t\n\x0b\x0c\r"
# Rows go to Python a few at a time, so that a batch of very long texts still fits in a worker.
BATCH_ROWS = 512
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Before a frame with Python stages is built: bounds the rows of a batch, and lets workers import this package.

    On a cluster the package comes with ``--py-files`` or is installed; a path that is missing there does no harm."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [PACKAGE_ROOT, *known]))


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """A session setting for as long as the block runs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there; cuts lineage. What the writing shuffled is dropped at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the id, as ``id`` (long), and the text's UTF-8 bytes, as ``body`` (null stays null)."""
    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").cast("binary").alias("body"))


def mark(text: Column) -> Column:
    """A hash of the text. Id and mark together name a document the same way at every reading of a table, which a
    row number does not: how files are split can change when an executor is lost."""
    return F.xxhash64(text.cast("string").cast("binary"))


def held_out_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the text "null"."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("null")).cast("binary")) % modulus


def packed(body: Column) -> Column:
    """The text's bytes, compressed for a shuffle; null stays null."""

    @F.pandas_udf(BinaryType())
    def press(part: pd.Series) -> pd.Series:
        compressor = zstandard.ZstdCompressor(level=1)
        return part.map(lambda b: None if b is None else compressor.compress(b))

    return press(body)


def unpacked(body: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body) if body else b""


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and bodies (bytes, or None) of each batch made by :func:`texts`."""
    for batch in batches:
        yield batch.column("id").to_pylist(), batch.column("body").to_pylist()


def as_uri(path: str) -> str:
    return path if "://" in path or path.startswith(("file:", "viewfs:", "hdfs:")) else f"file://{path}"


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared folder, from any process."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri.removeprefix("file:").replace("///", "/", 1)
    return pafs.FileSystem.from_uri(uri)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``rows`` rows; for narrow rows only."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


@contextmanager
def written_file(uri: str, name: str):
    """A file that appears under its final, attempt-unique name only when complete; yields (stream, path)."""
    fs, folder = open_folder(uri)
    fs.create_dir(folder, recursive=True)
    final = posixpath.join(folder, f"{name}-{uuid.uuid4().hex}")
    aside = f"{final}.part"
    with fs.open_output_stream(aside) as stream:
        yield stream, final
    fs.move(aside, final)
