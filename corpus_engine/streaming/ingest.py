"""New page files of a landing folder, flattened and merged into a table as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpus_engine import schemas
from corpus_engine.operators.ordering import keep_last
from corpus_engine.sources.pages import decoded_search_pages, hits_of_pages
from corpus_engine.sources.tables import append_batch, merge_into_table, read_batches

# Late pages must not undo newer ones, so the capture time decides before the arrival order.
LATEST = ("captured_at", "_run_id", "_seq")


def ingest_stream(
    spark: SparkSession,
    landing: str,
    envelope: T.StructType,
    flatten: Callable[[DataFrame], DataFrame],
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    order_by: Sequence[str] = LATEST,
    files_per_batch: int = 1000,
    buckets: int | None = None,
) -> StreamingQuery:
    """Starts a query that handles all files present, in batches, and then stops.

    A batch that is repeated after a failure merges the same rows again, which changes nothing.
    ``flatten`` sees the pages of one batch, so it is for pages whose rows do not depend on other pages; search pages,
    whose positions and quota cut do, are taken in by :func:`ingest_search_pages`.
    """
    pages = (
        spark.readStream.schema(envelope)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_into_table(flatten(batch), table, keys, order_by, buckets)

    return (
        pages.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_search_pages(
    spark: SparkSession, landing: str, table: str, checkpoint: str, captured_at: Column, files_per_batch: int = 1000
) -> StreamingQuery:
    """Starts a query that decodes all files present, in batches, and keeps the pages; see :func:`ingested_hits`.

    A hit's position and whether it lies before the quota cut depend on pages that may come in any batch. So each
    batch only adds its decoded pages, and positions and cuts are worked out over all pages when hits are read.
    """
    pages = (
        spark.readStream.schema(schemas.SEARCH_ENVELOPE)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        append_batch(decoded_search_pages(batch, captured_at), f"{table}.pages", batch_id)

    return (
        pages.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested_hits(spark: SparkSession, table: str, max_pages: int | None = None, stop_on_quota: bool = True) -> DataFrame:
    """Hits of all pages taken in so far, the same as if they had landed at once; the newest row of each key."""
    found = read_batches(spark, f"{table}.pages")
    if found is None:
        return spark.createDataFrame([], schemas.SEARCH_HITS)
    _, keys, _ = schemas.TABLES["search_hits"]
    return keep_last(hits_of_pages(found, max_pages, stop_on_quota), keys, LATEST)
