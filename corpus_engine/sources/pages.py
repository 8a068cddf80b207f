"""Landed response pages to table rows.

A landed page is an envelope (run, sequence number, what was asked) plus the response: JSON text,
or the struct that ``spark.read.schema(...).json`` makes of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpus_engine import schemas
from corpus_engine.functions.status import is_quota_error
from corpus_engine.functions.values import (
    CHANNEL_URL_PREFIX,
    VIDEO_URL_PREFIX,
    first_object_field,
    first_text,
    iso_duration_seconds,
    or_empty,
    prefixed,
    present,
    safe_int,
    stable_id,
)
from corpus_engine.operators.ordering import cut_at_first
from corpus_engine.operators.positions import preceding_total
from corpus_engine.operators.sizing import settled_side
from corpus_engine.sources.tables import staged


def read_landing(spark: SparkSession, path: str, envelope: T.StructType) -> DataFrame:
    """JSON-lines pages under ``path``; what does not fit the envelope's types reads as null."""
    return spark.read.schema(envelope).json(path)


def _parsed(pages: DataFrame, schema: T.StructType) -> DataFrame:
    if isinstance(pages.schema["response"].dataType, T.StringType):
        pages = pages.withColumn("response", F.from_json("response", schema))
    return pages.withColumn("items", F.col("response.items")).drop("response")


def _each_item(pages: DataFrame, *columns: str | Column) -> DataFrame:
    """One row per item of a parsed page, with its place ``_pos``.

    From an outer generator the optimizer infers no filter on ``items``; pushed below, such a filter decodes the response anew.
    """
    return pages.select(*columns, F.posexplode_outer("items").alias("_pos", "item")).where(F.col("_pos").isNotNull())


def _item_seq(pos: str, reply: bool = False) -> Column:
    """Arrival of an item, see ``schemas.SEQ``: no number is too large for its place."""
    return F.struct(F.col("seq").cast("bigint").alias("page"), F.lit(int(reply)).alias("kind"), F.col(pos).cast("int").alias("pos"))


def decoded_search_pages(pages: DataFrame, captured_at: Column) -> DataFrame:
    """Search pages with their items read and those without a video id left out; ``_n`` counts the rest."""
    return _parsed(pages, schemas.SEARCH_RESPONSE).withColumns({
        "search_id": stable_id(*[F.col(c) for c in (
            "theme", "query", "search_order", "published_after", "published_before")]),
        "items": F.filter("items", lambda i: present(i["id"]["videoId"])),
        "captured_at": captured_at,
    }).withColumn("_n", F.coalesce(F.size("items"), F.lit(0)).cast("bigint"))


def flatten_search_pages(
    pages: DataFrame,
    captured_at: Column,
    max_pages: int | None = None,
    stop_on_quota: bool = True,
) -> DataFrame:
    """Search hits with their running position across the pages of one search, see :func:`hits_of_pages`."""
    return hits_of_pages(decoded_search_pages(pages, captured_at), max_pages, stop_on_quota)


def hits_of_pages(found: DataFrame, max_pages: int | None = None, stop_on_quota: bool = True) -> DataFrame:
    """Rows of decoded search pages, in whatever batches these were decoded.

    Items without a video id neither appear nor count. With ``stop_on_quota`` a run ends before
    its first quota failure; pages that failed otherwise carry no items, see :func:`page_accounting`. Where to
    cut and where each page starts is worked out on narrow facts per page; the items travel once, keyed by page.
    """
    if max_pages is not None:
        found = found.where(F.col("page_number") <= max_pages)
    facts = found.select("run_id", "seq", "search_id", "page_number", "error", "_n")
    if stop_on_quota:
        facts = cut_at_first(facts, "run_id", "seq", is_quota_error(F.col("error")), inclusive=False)
    offsets = preceding_total(
        facts.where(F.col("error").isNull() & (F.col("_n") > 0)),
        ["run_id", "search_id"], "page_number", "_n", "_offset", group_bound=max_pages)
    item = found.where(F.col("error").isNull()).join(
        offsets.select("run_id", "seq", "_offset"), ["run_id", "seq"]
    ).select("*", F.posexplode("items").alias("_pos", "item"))
    snippet = "item.snippet"
    return item.select(
        "search_id", "theme", "query", "search_order",
        F.col("published_after").alias("search_published_after"),
        F.col("published_before").alias("search_published_before"),
        "page_number",
        (F.col("_offset") + F.col("_pos") + 1).alias("result_position"),
        F.col("item.id.videoId").alias("video_id"),
        F.col(f"{snippet}.channelId").alias("channel_id"),
        F.col(f"{snippet}.title").alias("search_title"),
        F.col(f"{snippet}.description").alias("search_description"),
        F.col(f"{snippet}.publishedAt").alias("search_published_at"),
        first_object_field("url", *[
            F.col(f"{snippet}.thumbnails.{size}") for size in ("high", "medium", "default")
        ]).alias("thumbnail_url"),
        "captured_at",
        F.col("run_id").alias("_run_id"),
        _item_seq("_pos").alias("_seq"),
    )


def flatten_video_pages(pages: DataFrame, captured_at: Column) -> DataFrame:
    """One row per returned video."""
    item = _parsed(pages, schemas.VIDEO_RESPONSE).select(
        "run_id", "seq", F.posexplode("items").alias("_pos", "item"))
    snippet, content, stats, status = (
        f"item.{part}" for part in ("snippet", "contentDetails", "statistics", "status"))
    return item.select(
        F.col("item.id").alias("video_id"),
        F.col(f"{snippet}.channelId").alias("channel_id"),
        F.col(f"{snippet}.channelTitle").alias("channel_title"),
        F.col(f"{snippet}.title").alias("title"),
        F.col(f"{snippet}.description").alias("description"),
        F.col(f"{snippet}.publishedAt").alias("published_at"),
        or_empty(F.col(f"{snippet}.tags")).alias("tags"),
        F.col(f"{snippet}.categoryId").alias("category_id"),
        F.col(f"{snippet}.defaultLanguage").alias("default_language"),
        F.col(f"{snippet}.defaultAudioLanguage").alias("default_audio_language"),
        F.col(f"{snippet}.liveBroadcastContent").alias("live_broadcast_content"),
        first_object_field("url", *[
            F.col(f"{snippet}.thumbnails.{size}") for size in ("maxres", "standard", "high")
        ]).alias("thumbnail_url"),
        F.col(f"{content}.duration").alias("duration_iso8601"),
        iso_duration_seconds(F.col(f"{content}.duration")).alias("duration_seconds"),
        F.col(f"{content}.dimension").alias("dimension"),
        F.col(f"{content}.definition").alias("definition"),
        F.col(f"{content}.caption").alias("caption"),
        F.col(f"{content}.licensedContent").alias("licensed_content"),
        F.col(f"{content}.projection").alias("projection"),
        safe_int(F.col(f"{stats}.viewCount")).alias("view_count"),
        safe_int(F.col(f"{stats}.likeCount")).alias("like_count"),
        safe_int(F.col(f"{stats}.commentCount")).alias("comment_count"),
        F.col(f"{status}.privacyStatus").alias("privacy_status"),
        F.col(f"{status}.madeForKids").alias("made_for_kids"),
        F.col(f"{status}.selfDeclaredMadeForKids").alias("self_declared_made_for_kids"),
        or_empty(F.col("item.topicDetails.topicCategories")).alias("topic_categories"),
        prefixed(VIDEO_URL_PREFIX, F.col("item.id")).alias("video_url"),
        captured_at.alias("captured_at"),
        F.col("run_id").alias("_run_id"),
        _item_seq("_pos").alias("_seq"),
    )


def flatten_channel_pages(pages: DataFrame, captured_at: Column) -> DataFrame:
    """One row per returned channel."""
    item = _parsed(pages, schemas.CHANNEL_RESPONSE).select(
        "run_id", "seq", F.posexplode("items").alias("_pos", "item"))
    snippet, stats = "item.snippet", "item.statistics"
    return item.select(
        F.col("item.id").alias("channel_id"),
        F.col(f"{snippet}.title").alias("channel_title"),
        F.col(f"{snippet}.description").alias("channel_description"),
        F.col(f"{snippet}.publishedAt").alias("channel_published_at"),
        F.col(f"{snippet}.country").alias("country"),
        F.col(f"{snippet}.customUrl").alias("custom_url"),
        first_object_field("url", *[
            F.col(f"{snippet}.thumbnails.{size}") for size in ("high", "medium", "default")
        ]).alias("thumbnail_url"),
        safe_int(F.col(f"{stats}.subscriberCount")).alias("subscriber_count"),
        F.col(f"{stats}.hiddenSubscriberCount").alias("hidden_subscriber_count"),
        safe_int(F.col(f"{stats}.viewCount")).alias("channel_view_count"),
        safe_int(F.col(f"{stats}.videoCount")).alias("video_count"),
        F.col("item.contentDetails.relatedPlaylists.uploads").alias("uploads_playlist_id"),
        F.col("item.status.privacyStatus").alias("privacy_status"),
        F.col("item.status.madeForKids").alias("made_for_kids"),
        or_empty(F.col("item.topicDetails.topicCategories")).alias("topic_categories"),
        prefixed(CHANNEL_URL_PREFIX, F.col("item.id")).alias("channel_url"),
        captured_at.alias("captured_at"),
        F.col("run_id").alias("_run_id"),
        _item_seq("_pos").alias("_seq"),
    )


def flatten_playlist_pages(
    pages: DataFrame, max_pages: int | None = None, published_between: tuple[str, str] | None = None
) -> DataFrame:
    """Uploads of a channel with their 1-based place in the page, which counts skipped items too."""
    if max_pages is not None:
        pages = pages.where(F.col("page_number") <= max_pages)
    item = _parsed(pages, schemas.PLAYLIST_RESPONSE).select(
        "channel_id", "page_number", F.posexplode("items").alias("_pos", "item"))
    uploads = item.select(
        "channel_id",
        "page_number",
        (F.col("_pos") + 1).cast("bigint").alias("position_in_page"),
        first_text(F.col("item.contentDetails.videoId"), F.col("item.snippet.resourceId.videoId"))
        .alias("video_id"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.description").alias("description"),
        first_text(F.col("item.contentDetails.videoPublishedAt"), F.col("item.snippet.publishedAt"))
        .alias("published_at"),
    ).where(present(F.col("video_id")) & present(F.col("published_at")))
    if published_between is not None:
        uploads = uploads.where(F.left("published_at", F.lit(10)).between(*published_between))
    return uploads


def _comment_columns(comment: str, is_reply: bool, captured_at: Column) -> list[Column]:
    snippet = f"{comment}.snippet"
    return [
        F.col(f"{comment}.id").alias("comment_id"),
        F.col("video_id"),
        F.col("thread_id"),
        F.col("parent_comment_id"),
        F.lit(is_reply).alias("is_reply"),
        F.col(f"{snippet}.authorDisplayName").alias("author_name"),
        F.col(f"{snippet}.authorChannelId.value").alias("author_channel_id"),
        F.col(f"{snippet}.authorChannelUrl").alias("author_channel_url"),
        first_text(F.col(f"{snippet}.textDisplay"), F.col(f"{snippet}.textOriginal")).alias("text"),
        safe_int(F.col(f"{snippet}.likeCount")).alias("like_count"),
        F.col(f"{snippet}.publishedAt").alias("published_at"),
        F.col(f"{snippet}.updatedAt").alias("updated_at"),
        F.col("total_reply_count"),
        captured_at.alias("captured_at"),
        F.col("run_id").alias("_run_id"),
        _item_seq("_pos", is_reply).alias("_seq"),
    ]


def thread_page_comments(pages: DataFrame, captured_at: Column) -> DataFrame:
    """The top comments of thread pages that were read, each page by itself: no cap, no cut at failures, no replies."""
    item = _each_item(_parsed(pages.where(F.col("error").isNull()), schemas.THREAD_RESPONSE), "run_id", "seq", "video_id")
    rows = item.select(
        "*", F.col("item.id").alias("thread_id"), F.lit(None).cast("string").alias("parent_comment_id"),
        F.coalesce(safe_int(F.col("item.snippet.totalReplyCount")), F.lit(0)).alias("total_reply_count"))
    return rows.select(*_comment_columns("item.snippet.topLevelComment", False, captured_at))


def reply_page_comments(pages: DataFrame, captured_at: Column) -> DataFrame:
    """The replies of reply pages that were read, each page by itself."""
    item = _each_item(
        _parsed(pages.where(F.col("error").isNull()), schemas.REPLY_RESPONSE), "run_id", "seq", "video_id", "thread_id",
        F.col("parent_id").alias("parent_comment_id"), F.lit(None).cast("bigint").alias("total_reply_count"))
    return item.select(*_comment_columns("item", True, captured_at))


def _unlifted(failed: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """Failed pages that were not read later in the run; a retry that succeeded lifts a failure."""
    read = pages.where(F.col("error").isNull()).groupBy(*keys).agg(F.max("seq").alias("_read"))
    return failed.join(read, keys, "left").where(F.col("_read").isNull() | (F.col("_read") <= F.col("seq"))).drop("_read")


def _preceding_in_page(keys: list[str]) -> Window:
    """The rows before a row on its own page, which bounds the window."""
    return Window.partitionBy(*keys).orderBy("_pos", "seq").rowsBetween(Window.unboundedPreceding, -1)


def failed_thread_pages(threads: DataFrame) -> DataFrame:
    """Thread pages that failed for good."""
    keys = ["run_id", "video_id", "page_number"]
    return _unlifted(threads.where(F.col("error").isNotNull()), threads, keys)


def failed_reply_pages(replies: DataFrame) -> DataFrame:
    """Reply pages that failed for good."""
    keys = ["run_id", "video_id", "parent_id", "page_number"]
    return _unlifted(replies.where(F.col("error").isNotNull()), replies, keys)


def flatten_comment_threads(
    threads: DataFrame,
    replies: DataFrame,
    captured_at: Column,
    max_per_video: int = 500,
    include_replies: bool = True,
) -> DataFrame:
    """Comments of each video in reading order (comment, its replies, next comment …), cut at the cap.

    A failed thread page ends its video before that page. A failed reply page ends it as well: the
    comment it belongs to is the last row, and its replies read before the failure are not kept.

    Pages are decoded once, into written rows, and their texts travel once, page by page, to the places that they keep: places in
    reading order are sums over narrow rows (items per page, and the rows before on a page), the cap is a filter on the place, and a page of
    which nothing is kept is never taken apart. Building the frame runs the jobs that write the decoded pages and the places,
    and count the cuts.
    """
    if max_per_video <= 0:
        raise ValueError("max_per_video must be positive")
    video = ["run_id", "video_id"]
    page, parent = [*video, "page_number"], [*video, "parent_id"]
    none = F.lit(None)
    tops = staged(_parsed(threads.where(F.col("error").isNull()), schemas.THREAD_RESPONSE).select(*page, "seq", "items"), "threads")
    stops = settled_side(failed_thread_pages(threads).groupBy(*video).agg(F.min("page_number").alias("_stop")))
    facts = F.transform("items", lambda i: F.struct(
        i["id"].alias("thread_id"), i["snippet"]["topLevelComment"]["id"].alias("parent_id"),
        F.coalesce(safe_int(i["snippet"]["totalReplyCount"]), F.lit(0)).alias("total_reply_count")))
    read = tops.join(stops, video, "left").where(F.col("_stop").isNull() | (F.col("page_number") < F.col("_stop")))
    read = read.select(*page, "seq", facts.alias("_facts"))
    # A page whose top comments alone come too late need not be looked at.
    least = preceding_total(read.groupBy(*page).agg(F.sum(F.size("_facts")).alias("_n")), video, "page_number", "_n", "_least")
    near = read.join(least.where(F.col("_least") < max_per_video).select(*page), page, "left_semi")
    narrow = near.select(*page, "seq", F.posexplode("_facts").alias("_pos", "_fact")).select("*", "_fact.*").drop("_fact")
    answered = (F.col("total_reply_count") > 0) & present(F.col("parent_id"))
    if include_replies:
        answers = staged(_parsed(replies.where(F.col("error").isNull()), schemas.REPLY_RESPONSE).select(
            *parent, "page_number", "seq", "items"), "replies")
        reply_page = [*parent, "page_number"]
        landings = answers.where(F.size("items") > 0).groupBy(*reply_page).agg(
            F.sum(F.size("items")).alias("_n"), F.collect_list(F.struct("seq", F.size("items").alias("n"))).alias("_landings"))
        totals = landings.groupBy(*parent).agg(F.sum("_n").alias("_replies"))
        narrow = narrow.join(totals, parent, "left").withColumn(
            "_rows", 1 + F.when(answered, F.coalesce("_replies", F.lit(0))).otherwise(0)).drop("_replies")
    else:
        narrow = narrow.withColumn("_rows", F.lit(1).cast("bigint"))

    before = preceding_total(narrow.groupBy(*page).agg(F.sum("_rows").alias("_n")), video, "page_number", "_n", "_before")
    within = F.coalesce(F.sum("_rows").over(_preceding_in_page(page)), F.lit(0))
    places = narrow.withColumn("_within", within).join(before.select(*page, "_before"), page).withColumn(
        "_place", F.col("_before") + F.col("_within")).where(F.col("_place") < max_per_video)
    places = staged(places.select(*page, "seq", "_pos", "thread_id", "parent_id", "total_reply_count", "_place"), "places")
    if include_replies:
        ends = failed_reply_pages(replies).select(*parent).distinct().join(places.where(answered), parent)
        ends = settled_side(ends.groupBy(*video).agg(F.min("_place").alias("_end")))
        places = places.join(ends, video, "left").where(F.col("_end").isNull() | (F.col("_place") <= F.col("_end")))

    kept = places.groupBy(*page, "seq").agg(F.collect_list(F.struct("_pos", "total_reply_count")).alias("_kept"))  # of one page's items
    rows = tops.join(kept, [*page, "seq"]).select(
        *page, "seq", F.explode(F.transform("_kept", lambda k: F.struct(k["_pos"], k["total_reply_count"], F.get("items", k["_pos"]).alias("item")))).alias("_row"),
    ).select("*", "_row.*").select(
        "*", F.col("item.id").alias("thread_id"), none.cast("string").alias("parent_comment_id"),
    ).select(*_comment_columns("item.snippet.topLevelComment", False, captured_at))
    if not include_replies:
        return rows

    # The comment at which a failure ends the video keeps none of its replies.
    asked = places.where(answered & (F.col("_end").isNull() | (F.col("_place") < F.col("_end")))).select(*parent, "thread_id", "_place")
    earlier = preceding_total(landings.select(*reply_page, "_n"), parent, "page_number", "_n", "_before")
    spots = landings.join(earlier.select(*reply_page, "_before"), reply_page).join(asked, parent)
    spots = spots.withColumn("_first", F.col("_place") + 1 + F.col("_before")).where(F.col("_first") < max_per_video)
    # Items of a page that landed more than once stand side by side: by place on the page, then by arrival.
    beside = F.aggregate("_landings", F.lit(0).cast("bigint"), lambda n, other: (
        n + F.least(other["n"], F.col("_pos")) + ((other["seq"] < F.col("seq")) & (other["n"] > F.col("_pos"))).cast("bigint")))
    spread = answers.join(spots.select(*reply_page, "thread_id", "_first", "_landings"), reply_page).select(
        *parent, "seq", "thread_id", "_first", "_landings", F.posexplode("items").alias("_pos", "item"))
    spread = spread.where(F.col("_first") + beside < max_per_video).select(
        "*", F.col("parent_id").alias("parent_comment_id"), none.cast("bigint").alias("total_reply_count"))
    return rows.unionByName(spread.select(*_comment_columns("item", True, captured_at)))


OUTCOMES = ["read", "empty", "quota", "failed", "unreadable"]


def page_outcome(items: Column) -> Column:
    """Which of :data:`OUTCOMES` a landed page is.

    A page counts as unreadable when it has no error but no list of items either, as when its text was cut short.
    """
    error = F.col("error")
    return (
        F.when(is_quota_error(error), "quota").when(error.isNotNull(), "failed")
        .when(items.isNull(), "unreadable").when(F.size(items) == 0, "empty").otherwise("read"))


def page_accounting(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed pages of each run by outcome, one column each: read, empty, quota, failed, unreadable."""
    found = _parsed(pages, schema)
    return found.select("run_id", page_outcome(F.col("items")).alias("_outcome")).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("pages"), *[F.count_if(F.col("_outcome") == k).alias(f"pages_{k}") for k in OUTCOMES])
