import json

from pyspark.sql import functions as F

from corpus_engine import schemas
from corpus_engine.sources import pages
from tests.helpers import values


def at():
    return F.lit("2026-01-01T00:00:00Z")


def page_frame(spark, envelope, rows):
    """Rows of envelope values; the response, last, is given as a Python object."""
    ready = [tuple(r[:-1]) + (r[-1] if isinstance(r[-1], (str, type(None))) else json.dumps(r[-1]),) for r in rows]
    return spark.createDataFrame(ready, envelope)


def hit(video, **snippet):
    return {"id": {"videoId": video} if video is not None else {}, "snippet": snippet}


def search_row(run, seq, query, page, items, error=None):
    return (run, seq, "t", query, "relevance", None, None, page, error, {"items": items})


def test_search_positions_run_across_pages(spark):
    rows = [
        search_row("r1", 0, "q", 1, [hit("a"), hit(None), hit(""), hit("b", thumbnails={"high": {}, "medium": {"url": "m"}})]),
        search_row("r1", 1, "q", 2, [{"id": None}, hit("c", thumbnails={"high": {"width": 1}, "medium": {"url": "m"}}), {}]),
        search_row("r1", 2, "p", 1, [hit("a")]),
        ("r1", 3, "t", "empty", "date", "x", "y", 1, None, {"nextPageToken": "z"}),
    ]
    df = page_frame(spark, schemas.SEARCH_ENVELOPE, rows)
    for options in ({}, {"max_pages": 5}):
        got = pages.flatten_search_pages(df, at(), **options)
        assert values(got, "query", "page_number", "result_position", "video_id", "thumbnail_url") == [
            ("p", 1, 1, "a", None), ("q", 1, 1, "a", None), ("q", 1, 2, "b", "m"), ("q", 2, 3, "c", None)]
    assert got.columns == schemas.SEARCH_HITS.fieldNames() + ["_run_id", "_seq"]
    assert got.select("search_id").distinct().count() == 2
    assert pages.flatten_search_pages(df, at(), max_pages=1).where("query = 'q'").count() == 2


def test_search_stops_before_quota_failure(spark):
    rows = [
        search_row("r1", 0, "a", 1, [hit("a")]),
        search_row("r1", 1, "b", 1, [], "HttpError 403 dailyLimitExceeded"),
        search_row("r1", 2, "c", 1, [hit("c")]),
        search_row("r2", 0, "a", 1, [hit("d")]),
        search_row("r2", 1, "b", 1, [hit("x")], "HttpError 500"),
        search_row("r2", 2, "c", 1, [hit("e")]),
    ]
    df = page_frame(spark, schemas.SEARCH_ENVELOPE, rows)
    assert values(pages.flatten_search_pages(df, at()), "video_id") == [("a",), ("d",), ("e",)]
    assert values(pages.flatten_search_pages(df, at(), stop_on_quota=False), "video_id") == [
        ("a",), ("c",), ("d",), ("e",)]


def test_unreadable_page_gives_no_rows(spark):
    rows = [("r1", 0, "t", "q", "date", None, None, 1, None, "{broken"), search_row("r1", 1, "q", 2, [hit("a")])]
    got = pages.flatten_search_pages(page_frame(spark, schemas.SEARCH_ENVELOPE, rows), at())
    assert values(got, "video_id", "result_position") == [("a", 1)]


def test_videos(spark):
    items = [
        {"id": "v1",
         "snippet": {"channelId": "c", "title": "t", "thumbnails": {"maxres": {}, "standard": {"url": "s"}}, "tags": ["x", "y"]},
         "contentDetails": {"duration": "PT1M", "licensedContent": True, "caption": "false"},
         "statistics": {"viewCount": "10", "likeCount": "3.7", "commentCount": ""},
         "status": {"madeForKids": False}, "topicDetails": {"topicCategories": ["k"]}},
        {"id": "v2", "contentDetails": {"duration": "P1W"}},
        {"id": None},
    ]
    got = pages.flatten_video_pages(page_frame(spark, schemas.DETAIL_ENVELOPE, [("r1", 0, {"items": items})]), at())
    assert got.columns[:-2] == schemas.VIDEO_FACTS.fieldNames()
    assert dict(got.dtypes)["tags"] == "array<string>"
    rows = {r.video_id: r for r in got.collect()}
    v1, v2 = rows["v1"], rows["v2"]
    assert (v1.thumbnail_url, v1.duration_seconds, v1.view_count, v1.like_count, v1.comment_count) == ("s", 60, 10, None, None)
    assert (v1.tags, v1.topic_categories, v1.licensed_content, v1.made_for_kids) == (["x", "y"], ["k"], True, False)
    assert (v2.tags, v2.topic_categories, v2.duration_seconds, v2.title) == ([], [], None, None)
    assert v2.video_url.endswith("=v2") and None in rows


def test_one_wrong_type_does_not_lose_the_page(spark):
    items = [{"id": "v1", "snippet": {"title": "t", "thumbnails": "none", "tags": "no list"}}, {"id": "v2", "snippet": 5}]
    got = pages.flatten_video_pages(page_frame(spark, schemas.DETAIL_ENVELOPE, [("r1", 0, {"items": items})]), at())
    assert values(got, "video_id", "title", "thumbnail_url") == [("v1", "t", None), ("v2", None, None)]


def test_channels(spark):
    items = [{"id": "c1", "snippet": {"title": "t", "thumbnails": {"default": {"url": "d"}}},
              "statistics": {"subscriberCount": "5", "hiddenSubscriberCount": False},
              "contentDetails": {"relatedPlaylists": {"uploads": "UU1"}}}, {"id": "c2"}]
    got = pages.flatten_channel_pages(page_frame(spark, schemas.DETAIL_ENVELOPE, [("r1", 0, {"items": items})]), at())
    assert got.columns[:-2] == schemas.CHANNELS.fieldNames()
    assert values(got, "channel_id", "thumbnail_url", "subscriber_count", "uploads_playlist_id", "topic_categories") == [
        ("c1", "d", 5, "UU1", []), ("c2", None, None, None, [])]


def test_playlist(spark):
    items = [
        {"contentDetails": {"videoId": "a", "videoPublishedAt": "2026-09-01T23:00:00Z"}, "snippet": {"title": "A"}},
        {"contentDetails": {"videoId": ""}, "snippet": {"resourceId": {"videoId": "b"}, "publishedAt": "2026-09-16T23:59:59Z"}},
        {"snippet": {"publishedAt": "2026-09-10T00:00:00Z"}},
        {"contentDetails": {"videoId": "c", "videoPublishedAt": "2026-09-17T00:00:00Z"}},
        {"contentDetails": {"videoId": "d"}},
    ]
    df = page_frame(spark, schemas.PLAYLIST_ENVELOPE, [
        ("r1", 0, "ch", 1, {"items": items}), ("r1", 1, "ch", 3, {"items": items[:1]})])
    got = pages.flatten_playlist_pages(df, 2, ("2026-09-01", "2026-09-16"))
    assert values(got, "page_number", "position_in_page", "video_id") == [(1, 1, "a"), (1, 2, "b")]


def comment(cid, text="x", original=None, author=None):
    return {"id": cid, "snippet": {"textDisplay": text, "textOriginal": original, "authorChannelId": author, "likeCount": "1"}}


def thread(tid, top, replies):
    return {"id": tid, "snippet": {"totalReplyCount": replies, "topLevelComment": top}}


def threads_and_replies(spark):
    threads = page_frame(spark, schemas.THREAD_ENVELOPE, [
        ("r1", 0, "v", 1, None, {"items": [
            thread("t1", comment("c1", author={"value": "ch"}), 3), thread("t2", comment("c2", "", "orig", author="plain"), 0)]}),
        ("r1", 3, "v", 2, None, {"items": [thread("t3", comment("c3"), "1"), thread("t4", {}, 2)]}),
        ("r1", 9, "w", 1, None, {"items": [thread("t9", comment("c9"), 0)]}),
    ])
    replies = page_frame(spark, schemas.REPLY_ENVELOPE, [
        ("r1", 1, "v", "t1", "c1", 1, None, {"items": [comment("c1.1"), comment("c1.2")]}),
        ("r1", 2, "v", "t1", "c1", 2, None, {"items": [comment("c1.3")]}),
        ("r1", 4, "v", "t3", "c3", 1, None, {"items": [comment("c3.1")]}),
        ("r1", 5, "v", "t2", "c2", 1, None, {"items": [comment("never asked")]}),
    ])
    return threads, replies


READING_ORDER = ["c1", "c1.1", "c1.2", "c1.3", "c2", "c3", "c3.1", None]


def test_comment_cap_is_a_prefix_of_the_reading_order(spark):
    threads, replies = threads_and_replies(spark)
    for cap in (1, 3, 4, 6, 8, 500, 2000):
        got = pages.flatten_comment_threads(threads, replies, at(), cap).where("video_id = 'v'")
        assert {r.comment_id for r in got.collect()} == set(READING_ORDER[:cap])
    tops = pages.flatten_comment_threads(threads, replies, at(), 500, include_replies=False)
    assert {r.comment_id for r in tops.collect()} == {"c1", "c2", "c3", "c9", None}


def test_failed_reply_page_ends_its_video(spark):
    threads, replies = threads_and_replies(spark)
    broken = page_frame(spark, schemas.REPLY_ENVELOPE, [("r1", 4, "v", "t3", "c3", 2, "500 backendError", None)])
    got = pages.flatten_comment_threads(threads, replies.unionByName(broken), at())
    assert values(got.where("video_id = 'v'"), "comment_id") == [("c1",), ("c1.1",), ("c1.2",), ("c1.3",), ("c2",), ("c3",)]
    assert got.where("video_id = 'w'").count() == 1
    first = page_frame(spark, schemas.REPLY_ENVELOPE, [("r1", 2, "v", "t1", "c1", 2, "403 quotaExceeded", None)])
    got = pages.flatten_comment_threads(threads, replies.unionByName(first), at())
    assert values(got.where("video_id = 'v'"), "comment_id") == [("c1",)]


def test_comment_columns(spark):
    threads, replies = threads_and_replies(spark)
    got = pages.flatten_comment_threads(threads, replies, at())
    assert got.columns[:-2] == schemas.COMMENTS.fieldNames()
    rows = {r.comment_id: r for r in got.collect()}
    assert (rows["c1"].author_channel_id, rows["c2"].author_channel_id) == ("ch", None)
    assert (rows["c2"].text, rows["c1"].total_reply_count, rows["c1.1"].total_reply_count) == ("orig", 3, None)
    assert (rows["c1.3"].parent_comment_id, rows["c1.3"].thread_id, rows["c1.3"].is_reply) == ("c1", "t1", True)
    assert (rows["c1"].parent_comment_id, rows["c1"].is_reply) == (None, False)


def test_table_to_pages_and_back(spark):
    """Rows written as response pages flatten to the same rows."""
    rows = [(f"v{i}", f"c{i % 3}", f"título {i} \"x\"\n", i, i % 2 == 0, [f"t{j}" for j in range(i % 3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, channel string, title string, views long, kids boolean, tags array<string>")
    item = F.struct(
        "id", F.struct(F.col("channel").alias("channelId"), "title", "tags").alias("snippet"),
        F.struct(F.col("views").cast("string").alias("viewCount")).alias("statistics"),
        F.struct(F.col("kids").alias("madeForKids")).alias("status"))
    landed = df.select(
        F.lit("r1").alias("run_id"), F.col("views").alias("seq"),
        F.to_json(F.struct(F.array(item).alias("items"))).alias("response"))
    back = pages.flatten_video_pages(landed, at())
    columns = ("video_id", "channel_id", "title", "view_count", "made_for_kids", "tags")
    assert values(back, *columns) == sorted(rows)


def test_failed_thread_page_ends_its_video_unless_it_was_read_later(spark):
    threads, replies = threads_and_replies(spark)
    broken = page_frame(spark, schemas.THREAD_ENVELOPE, [("r1", 3, "w", 2, "500 backendError", None), ("r1", 2, "v", 2, "500 backendError", None)])
    more = page_frame(spark, schemas.THREAD_ENVELOPE, [("r1", 4, "w", 3, None, {"items": [thread("t5", comment("c5"), 0)]})])
    got = pages.flatten_comment_threads(threads.unionByName(broken).unionByName(more), replies, at())
    assert values(got.where("video_id = 'w'"), "comment_id") == [("c9",)]
    assert {r.comment_id for r in got.where("video_id = 'v'").collect()} == set(READING_ORDER)  # its page 2 was read as well


def test_arrival_order_has_no_largest_page(spark):
    items = {"items": [{"id": "a"}, {"id": "b"}]}
    df = page_frame(spark, schemas.DETAIL_ENVELOPE, [("r1", 2**62, items), ("r1", 1764600000000000, items), ("r1", 5, items)])
    got = pages.flatten_video_pages(df, at()).orderBy("_seq").select("_seq.page", "video_id").collect()
    assert [tuple(r) for r in got] == [(s, v) for s in (5, 1764600000000000, 2**62) for v in "ab"]
    threads, replies = threads_and_replies(spark)
    kinds = pages.flatten_comment_threads(threads, replies, at()).select("is_reply", "_seq.kind").distinct().collect()
    assert {tuple(k) for k in kinds} == {(False, 0), (True, 1)}


def test_page_accounting(spark):
    df = spark.createDataFrame([("r1", None, '{"items": [{"id": {"videoId": "a"}}]}'), ("r1", None, '{"items": ['), ("r1", None, '{"items": []}'),
                                ("r1", "403 quotaExceeded", None), ("r1", "500 backendError", None), ("r2", None, None)],
                               "run_id string, error string, response string")
    got = {r.run_id: tuple(r)[1:] for r in pages.page_accounting(df, schemas.SEARCH_RESPONSE).collect()}
    assert got == {"r1": (5, 1, 1, 1, 1, 1), "r2": (1, 0, 0, 0, 0, 1)}
