"""Relevance review: the best places of every query, with video details and empty labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.operators.ordering import ARRIVAL
from corpus_engine.operators.ranking import top_n_per_group
from corpus_engine.operators.sizing import settled_side
from corpus_engine.sources.ordered import write_ordered

DETAILS = ["channel_title", "title", "description", "published_at", "duration_seconds", "view_count", "video_url"]
ORDER = ["query", "result_position", "video_id"]
LABELS = ["relevance_label", "relevance_reason"]


def with_labels(df: DataFrame) -> DataFrame:
    """Empty text columns for the reviewer."""
    return df.withColumns({label: F.lit("") for label in LABELS})


def best_hits(
    hits: DataFrame, per_query: int = 20, order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The first ``per_query`` distinct videos of each query by position, ties by arrival.

    A first pass finds how deep each query has to be read: the best position per (query, video) is
    a hash aggregate over three columns, folded before its shuffle. Only rows that reach the depth
    of their query are then put in arrival order, which is a small share of the hits.
    """
    asked = hits.where(F.col("query").isNotNull())
    position = F.col("result_position")
    best = asked.groupBy("query", "video_id").agg(F.min(position).alias("result_position"))
    places = top_n_per_group(best, ["query"], [position.asc_nulls_last(), F.col("video_id")], per_query)
    # a video without any position makes its query be read in full
    depth = places.groupBy("query").agg(
        F.when(F.count(position) == F.count(F.lit(1)), F.max(position)).alias("_depth"))
    near = asked.select("query", "video_id", "result_position", *order_by).join(
        settled_side(depth), "query").where(F.col("_depth").isNull() | (position <= F.col("_depth")))
    place = F.struct(position.isNull().alias("unplaced"), position, *[F.col(c) for c in order_by])
    first = near.groupBy("query", "video_id").agg(F.min(place).alias("_place"))
    return top_n_per_group(first, ["query"], [F.col("_place")], per_query).select(
        "query", "_place.result_position", "video_id")


def discovery_review(
    hits: DataFrame, videos: DataFrame, per_query: int = 20, order_by: Sequence[str] = ARRIVAL
) -> DataFrame:
    """Review rows; order them by query, position and video id on output."""
    details = videos.select("video_id", *DETAILS)
    sample = best_hits(hits, per_query, order_by)
    joined = sample.join(details, "video_id", "left").select(
        "query", "result_position", "video_id", *DETAILS)
    return with_labels(joined)


def ordered_review(review: DataFrame) -> DataFrame:
    return review.orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])


def write_review(review: DataFrame, path: str, files: int = 1) -> DataFrame:
    """The review as CSV for reviewers, by query, position and video, nulls last; returns the files' manifest."""
    return write_ordered(review, path, ORDER, files)


def review_counts(review: DataFrame) -> DataFrame:
    """Videos per query."""
    return review.where(F.col("query").isNotNull()).groupBy("query").agg(F.count("video_id").alias("n_videos"))
