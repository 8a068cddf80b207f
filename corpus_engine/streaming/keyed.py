"""Pages of items with a key of their own, taken in by a stream that remembers the newest row of every key.

A row's place in time is its capture, then its run and arrival (:data:`LATEST`), so late pages never undo newer ones, and of
pages that land twice the first landing counts. The stream's state is one place per key, with the file it came from; a batch gives out only
the places that it changed, reads their rows from its files, and appends those to a log of changes. The newest row of the log is the table
(:func:`newest_rows`), the same as if all pages had been read at once.

State lives in the stream's checkpoint, in as many parts as shuffle partitions were set when it was first started; it is kept by RocksDB, so it
need not fit in memory, and holds no texts, so each version of it stays small beside the pages. Places of a batch are reduced in the tasks before
they are shuffled, so a key that lands very often sends one place of each task. Checkpoints of streams whose state held whole rows cannot be
continued.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpus_engine import schemas
from corpus_engine.operators.ordering import keep_last
from corpus_engine.sources import captions, pages
from corpus_engine.sources.tables import SCRATCH_CODEC, append_batch, read_batches
from corpus_engine.streaming.ingest import LATEST

# A restart needs the newest version of the state and the one before; maintenance deletes older ones, and what an ended stream had on local disks.
# Files that a batch shuffled are of no use after it.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@dataclass(frozen=True)
class Kind:
    """A kind of landed page: its envelope, its rows, and what names a row."""

    envelope: T.StructType
    rows: Callable[[DataFrame, Column], DataFrame]
    keys: tuple[str, ...]


KINDS = {
    "videos": Kind(schemas.DETAIL_ENVELOPE, pages.flatten_video_pages, ("video_id",)),
    "channels": Kind(schemas.DETAIL_ENVELOPE, pages.flatten_channel_pages, ("channel_id",)),
    "threads": Kind(schemas.THREAD_ENVELOPE, pages.thread_page_comments, ("comment_id",)),
    "replies": Kind(schemas.REPLY_ENVELOPE, pages.reply_page_comments, ("comment_id",)),
    "captions": Kind(schemas.CAPTION_PAGE, captions.caption_page_tracks, ("video_id", "language", "is_generated")),
}


def newest_places(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] = LATEST) -> DataFrame:
    """Of a streaming frame the place of the newest row of each key, in each batch only those that the batch brought.

    ``_earliest`` falls with the batch's time, which a batch that is repeated after a failure has again. Of rows equal in ``order_by`` the
    one taken first stays, so a page that lands once more changes nothing. All columns are read, though only places are kept: what cannot be
    read for one of them must not have a place that :func:`rows_at` does not find.
    """
    earliest = -F.unix_micros(F.current_timestamp())
    taken = rows.withColumns({"_earliest": earliest, "_file": F.input_file_name(), "_read": F.hash(*rows.columns) % 1})
    newest = taken.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(
        F.max(F.struct(*order_by, "_earliest", "_file", "_read")).alias("_newest"))
    return newest.where(F.col("_newest._earliest") == earliest)


def rows_at(rows: DataFrame, places: DataFrame, keys: Sequence[str], files: DataFrame) -> DataFrame:
    """The row at each place, with the capture that the stream noted and its batch's time as ``_taken``.

    ``rows`` are read from their files, which ``files`` numbers. They are joined by the whole place, nulls equal to nulls, so rows of a key that
    lands very often go to many tasks. Rows that stand twice at a place of one file are one.
    """
    ids = ["_run_id", "_seq", "_number"]
    rest = [c for c in rows.columns if c not in (*keys, *ids)]
    found = rows.withColumn("_file", F.input_file_name()).join(F.broadcast(files), "_file").select(F.struct(*keys, *ids).alias("_spot"), *rest)
    noted = places.select(*[f"_of_{k}" for k in keys], "_newest.*").join(F.broadcast(files), "_file").select(
        F.struct(*[F.col(f"_of_{k}").alias(k) for k in keys], *ids).alias("_at"), F.col("captured_at").alias("_noted"), "_earliest")
    joined = found.join(noted, F.col("_spot") == F.col("_at"))  # already dealt by the noted place, whose fields may all be null
    return keep_last(joined, ["_at"], ["captured_at"]).select(
        *[F.col("_noted").alias(c) if c == "captured_at" else c if c in rest else F.col(f"_at.{c}") for c in rows.columns],
        F.timestamp_micros(-F.col("_earliest")).alias("_taken"))


def keep_newest(
    spark: SparkSession, landing: str, kind: str, table: str, checkpoint: str, captured_at: Column, files_per_batch: int = 1000
) -> StreamingQuery:
    """Starts a query that takes in all files present, in batches, and then stops; ``captured_at`` may use the envelope's run."""
    chosen = KINDS[kind]
    landed = spark.readStream.schema(chosen.envelope).option("maxFilesPerTrigger", files_per_batch).json(landing)

    def append(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch.write.mode("overwrite").option("compression", SCRATCH_CODEC).parquet(f"{table}.places")
        places = session.read.schema(batch.schema).parquet(f"{table}.places")
        names = sorted(f for f, in places.select("_newest._file").distinct().collect())  # of one batch
        files = session.createDataFrame([*enumerate(names)], "_number int, _file string")
        pages = session.read.schema(chosen.envelope).json(landing).where(
            F.col("_metadata.file_name").isin([f.rpartition("/")[2] for f in names]))
        # Were a page's file gone by now, its rows would be missing.
        append_batch(rows_at(chosen.rows(pages, captured_at), places, chosen.keys, files), f"{table}.changes", number, rows=places.count())

    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)  # a query takes its settings along when it starts
    try:
        return (
            newest_places(chosen.rows(landed, captured_at), chosen.keys)
            .writeStream.outputMode("update").foreachBatch(append)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def newest_rows(spark: SparkSession, table: str, kind: str) -> DataFrame | None:
    """The newest row of each key among all that was taken in; None before the first batch."""
    changes = read_batches(spark, f"{table}.changes")
    return None if changes is None else keep_last(changes, KINDS[kind].keys, LATEST).drop("_taken")
