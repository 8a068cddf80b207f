"""Coverage, integrity and manifest summaries over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def strategy_coverage(hits: DataFrame, strategy: str = "query") -> DataFrame:
    """Hits, distinct videos and channels of every search strategy."""
    return hits.groupBy(strategy).agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.count_distinct("video_id").alias("n_videos"),
        F.count_distinct("channel_id").alias("n_channels"),
    )


def strategy_overlap(hits: DataFrame, strategy: str = "query") -> DataFrame:
    """Per strategy: videos only it found, videos others found too, and all their finders summed.

    Works from the count of strategies per video, so no pairs of strategies are ever formed.
    """
    pairs = hits.where(F.col("video_id").isNotNull() & F.col(strategy).isNotNull()).select(
        strategy, "video_id").distinct()
    finders = pairs.groupBy("video_id").agg(F.count(F.lit(1)).alias("_finders"))
    return pairs.join(finders, "video_id").groupBy(strategy).agg(
        F.count(F.lit(1)).alias("n_videos"),
        F.count_if(F.col("_finders") == 1).alias("exclusive_videos"),
        F.count_if(F.col("_finders") > 1).alias("shared_videos"),
        F.sum("_finders").alias("finder_total"),
    ).withColumn("exclusive_share", F.col("exclusive_videos") / F.col("n_videos"))


def overlap_with(hits: DataFrame, baseline: str, strategy: str = "query") -> DataFrame:
    """Every other strategy against one baseline: shared videos and Jaccard similarity."""
    pairs = hits.where(F.col("video_id").isNotNull()).select(strategy, "video_id").distinct()
    base = pairs.where(F.col(strategy) == baseline).select("video_id", F.lit(1).alias("_base"))
    counted = pairs.where(F.col(strategy) != baseline).join(base, "video_id", "left").groupBy(strategy).agg(
        F.count(F.lit(1)).alias("n_videos"), F.count("_base").alias("shared_videos"))
    sized = counted.withColumn("baseline_videos", base.agg(F.count(F.lit(1))).scalar())
    union = F.col("n_videos") + F.col("baseline_videos") - F.col("shared_videos")
    return sized.withColumn("jaccard", F.col("shared_videos") / union)


def _unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct non-null keys of ``left`` have no row in ``right``."""
    keys = left.where(F.col(key).isNotNull()).select(key).distinct()
    return keys.join(right.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("n"))


def corpus_profile(
    hits: DataFrame, videos: DataFrame, channels: DataFrame, comments: DataFrame, transcripts: DataFrame
) -> DataFrame:
    """Named measures: volume, keys without a partner along the relations, transcript success rate."""
    measures = {
        "hits": hits.agg(F.count(F.lit(1)).alias("n")),
        "videos": videos.agg(F.count(F.lit(1)).alias("n")),
        "channels": channels.agg(F.count(F.lit(1)).alias("n")),
        "comments": comments.agg(F.count(F.lit(1)).alias("n")),
        "transcripts": transcripts.agg(F.count(F.lit(1)).alias("n")),
        "hit_videos_without_details": _unmatched(hits, videos, "video_id"),
        "hit_channels_without_details": _unmatched(hits, channels, "channel_id"),
        "video_channels_without_details": _unmatched(videos, channels, "channel_id"),
        "comment_videos_without_details": _unmatched(comments, videos, "video_id"),
        "transcript_success_rate": transcripts.agg(
            F.avg((F.col("transcript_status") == "success").cast("double")).alias("n")),
    }
    parts = [df.select(F.lit(name).alias("measure"), F.col("n").cast("double").alias("value"))
             for name, df in measures.items()]
    profile = parts[0]
    for part in parts[1:]:
        profile = profile.unionByName(part)
    return profile


def study_manifest(
    hits: DataFrame, videos: DataFrame, statuses: DataFrame, transcripts: DataFrame
) -> DataFrame:
    """Per query: volume and time span covered, with video recovery, transcript and comment outcomes.

    Everything is joined once per distinct (query, video) pair.
    """
    found = hits.where(F.col("query").isNotNull()).groupBy("query", "video_id").agg(
        F.count(F.lit(1)).alias("_hits"),
        F.min("search_published_at").alias("_first"),
        F.max("search_published_at").alias("_last"),
    )
    joined = (
        found.join(videos.select("video_id", F.lit(1).alias("_video")), "video_id", "left")
        .join(transcripts.select("video_id", "transcript_status"), "video_id", "left")
        .join(statuses.select("video_id", "status"), "video_id", "left")
    )
    return joined.groupBy("query").agg(
        F.sum("_hits").alias("n_hits"),
        F.count("video_id").alias("n_videos"),
        F.min("_first").alias("first_published"),
        F.max("_last").alias("last_published"),
        F.count("_video").alias("videos_recovered"),
        F.count_if(F.col("transcript_status") == "success").alias("transcripts_ok"),
        F.count_if(F.col("transcript_status") == "failed").alias("transcripts_failed"),
        F.count_if(F.col("status") == "quota_exceeded").alias("quota_failures"),
        F.count_if(F.col("status") == "error").alias("other_failures"),
    ).withColumn("recovery_rate", F.col("videos_recovered") / F.col("n_videos"))
