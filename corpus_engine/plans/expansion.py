"""Channel expansion: which uploads of discovered channels did the searches miss?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpus_engine.operators.ordering import ARRIVAL, first_n, keep_first
from corpus_engine.operators.resume import mark_known
from corpus_engine.operators.sizing import settled_side
from corpus_engine.plans.review import with_labels
from corpus_engine.sources.ordered import write_ordered
from corpus_engine.sources.pages import flatten_playlist_pages


def discovered_channels(
    hits: DataFrame, channels: DataFrame, max_channels: int = 10, order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Channels among the first ``max_channels`` discovered that have an uploads playlist."""
    wanted = first_n(hits, "channel_id", max_channels, order_by)
    return channels.join(wanted, "channel_id", "left_semi").where(
        F.col("uploads_playlist_id").isNotNull()
    ).select("channel_id", "channel_title", "uploads_playlist_id")


def channel_expansion(
    hits: DataFrame,
    channels: DataFrame,
    playlist_pages: DataFrame,
    start_date: str,
    end_date: str,
    max_channels: int = 10,
    max_pages: int = 2,
    order_by: Sequence[str] = ARRIVAL,
    known: DataFrame | None = None,
) -> DataFrame:
    """Uploads of the first discovered channels in a date range, marked as found by search or new."""
    # at most `max_channels` rows, worked out once for the page filter and the titles
    chosen = settled_side(discovered_channels(hits, channels, max_channels, order_by))
    pages = playlist_pages.join(chosen.select("channel_id"), "channel_id", "left_semi")
    uploads = flatten_playlist_pages(pages, max_pages, (start_date, end_date))
    place = ["page_number", "position_in_page"]
    once = keep_first(uploads, ["channel_id", "video_id"], place)
    marked = mark_known(once, hits if known is None else known, "video_id", "already_in_search")
    rows = marked.join(chosen, "channel_id").select(
        "channel_id", "channel_title", "uploads_playlist_id", *place, "video_id", "title",
        "description", "published_at", "already_in_search",
        (~F.col("already_in_search")).alias("new_vs_search"),
    )
    return with_labels(rows)


def write_expansion(expansion: DataFrame, found: DataFrame, path: str, files: int = 1) -> DataFrame:
    """The expansion as CSV for reviewers: channels as they were discovered (``found``: channel_id and the order columns of :func:`first_seen`),
    uploads in page order. Returns the files' manifest."""
    order = [c for c in found.columns if c != "channel_id"]
    place = F.row_number().over(Window.orderBy(*order)).alias("_channel")  # at most max_channels rows
    chosen = found.join(F.broadcast(expansion.select("channel_id").distinct()), "channel_id", "left_semi").select("channel_id", place)
    placed = expansion.join(F.broadcast(chosen), "channel_id").select("_channel", *expansion.columns)
    return write_ordered(placed, path, ["_channel", "page_number", "position_in_page", "video_id"], files)


def expansion_counts(expansion: DataFrame) -> DataFrame:
    """Candidates, those search had found, and new ones."""
    return expansion.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if("already_in_search").alias("already_found"),
        F.count_if("new_vs_search").alias("new_videos"),
    )
