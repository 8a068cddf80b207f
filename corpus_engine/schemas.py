"""Column contracts of the published tables and of the raw response pages.

Every table also carries ``_run_id`` and ``_seq``: rows have no physical order in Spark, so the
arrival order that "last wins" and "first seen" depend on is data. In published tables ``_seq`` is
``SEQ``; elsewhere it may be any orderable type, and it is not part of the fixed schemas.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
STRINGS = T.ArrayType(S)
ERROR = T.StructType([T.StructField("type", S), T.StructField("message", S)])
ERRORS = T.MapType(S, ERROR)
# A thumbnail is read as a map so that `{}` (skipped) differs from an object without url (taken).
THUMB = T.MapType(S, S)


# Arrival within a run: the landed page, whether it is a reply page, and the item's place on it.
SEQ = T.StructType([T.StructField("page", L), T.StructField("kind", T.IntegerType()), T.StructField("pos", T.IntegerType())])


def fields(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in cols.items()])


# --- published and state tables -------------------------------------------------------------

SEARCH_HITS = fields(
    search_id=S, theme=S, query=S, search_order=S, search_published_after=S,
    search_published_before=S, page_number=L, result_position=L, video_id=S, channel_id=S,
    search_title=S, search_description=S, search_published_at=S, thumbnail_url=S, captured_at=S,
)

TRANSCRIPTS = fields(
    video_id=S, transcript_status=S, transcript_method=S, transcript_language=S,
    transcript_text=S, transcript_error=ERRORS, transcript_captured_at=S,
)

VIDEO_FACTS = fields(
    video_id=S, channel_id=S, channel_title=S, title=S, description=S, published_at=S,
    tags=STRINGS, category_id=S, default_language=S, default_audio_language=S,
    live_broadcast_content=S, thumbnail_url=S, duration_iso8601=S, duration_seconds=L,
    dimension=S, definition=S, caption=S, licensed_content=B, projection=S, view_count=L,
    like_count=L, comment_count=L, privacy_status=S, made_for_kids=B,
    self_declared_made_for_kids=B, topic_categories=STRINGS, video_url=S, captured_at=S,
)

VIDEOS = T.StructType(VIDEO_FACTS.fields + TRANSCRIPTS.fields[1:])

CHANNELS = fields(
    channel_id=S, channel_title=S, channel_description=S, channel_published_at=S, country=S,
    custom_url=S, thumbnail_url=S, subscriber_count=L, hidden_subscriber_count=B,
    channel_view_count=L, video_count=L, uploads_playlist_id=S, privacy_status=S,
    made_for_kids=B, topic_categories=STRINGS, channel_url=S, captured_at=S,
)

COMMENTS = fields(
    comment_id=S, video_id=S, thread_id=S, parent_comment_id=S, is_reply=B, author_name=S,
    author_channel_id=S, author_channel_url=S, text=S, like_count=L, published_at=S,
    updated_at=S, total_reply_count=L, captured_at=S,
)

SEGMENTS = fields(
    video_id=S, segment_index=L, start_seconds=D, duration_seconds=D, text=S, source_method=S,
)

COMMENTS_STATUS = fields(
    video_id=S, status=S, rows_collected=L, error_type=S, error_message=S, captured_at=S,
)

# table -> (schema, key columns, folder)
TABLES: dict[str, tuple[T.StructType, list[str], str]] = {
    "search_hits": (SEARCH_HITS, ["search_id", "video_id", "result_position"], "processed"),
    "videos": (VIDEOS, ["video_id"], "processed"),
    "channels": (CHANNELS, ["channel_id"], "processed"),
    "comments": (COMMENTS, ["comment_id"], "processed"),
    "transcripts": (TRANSCRIPTS, ["video_id"], "intermediate"),
    "transcript_segments": (SEGMENTS, ["video_id", "segment_index", "source_method"], "intermediate"),
    "comments_status": (COMMENTS_STATUS, ["video_id"], "intermediate"),
}

# --- raw response pages ---------------------------------------------------------------------
# Counts are strings because the API sends them so and `safe_int` decides what is a number.


def _items(item: T.StructType) -> T.StructType:
    return fields(items=T.ArrayType(item), nextPageToken=S)


SEARCH_RESPONSE = _items(fields(
    id=fields(videoId=S),
    snippet=fields(
        channelId=S, title=S, description=S, publishedAt=S,
        thumbnails=fields(high=THUMB, medium=THUMB, default=THUMB),
    ),
))

VIDEO_RESPONSE = _items(fields(
    id=S,
    snippet=fields(
        channelId=S, channelTitle=S, title=S, description=S, publishedAt=S, tags=STRINGS,
        categoryId=S, defaultLanguage=S, defaultAudioLanguage=S, liveBroadcastContent=S,
        thumbnails=fields(maxres=THUMB, standard=THUMB, high=THUMB),
    ),
    contentDetails=fields(
        duration=S, dimension=S, definition=S, caption=S, licensedContent=B, projection=S),
    statistics=fields(viewCount=S, likeCount=S, commentCount=S),
    status=fields(privacyStatus=S, madeForKids=B, selfDeclaredMadeForKids=B),
    topicDetails=fields(topicCategories=STRINGS),
))

CHANNEL_RESPONSE = _items(fields(
    id=S,
    snippet=fields(
        title=S, description=S, publishedAt=S, country=S, customUrl=S,
        thumbnails=fields(high=THUMB, medium=THUMB, default=THUMB),
    ),
    statistics=fields(
        subscriberCount=S, hiddenSubscriberCount=B, viewCount=S, videoCount=S),
    contentDetails=fields(relatedPlaylists=fields(uploads=S)),
    status=fields(privacyStatus=S, madeForKids=B),
    topicDetails=fields(topicCategories=STRINGS),
))

COMMENT = fields(
    id=S,
    snippet=fields(
        authorDisplayName=S, authorChannelId=fields(value=S), authorChannelUrl=S, textDisplay=S,
        textOriginal=S, likeCount=S, publishedAt=S, updatedAt=S,
    ),
)

THREAD_RESPONSE = _items(fields(
    id=S, snippet=fields(totalReplyCount=S, topLevelComment=COMMENT)))

REPLY_RESPONSE = _items(COMMENT)

PLAYLIST_RESPONSE = _items(fields(
    snippet=fields(title=S, description=S, publishedAt=S, resourceId=fields(videoId=S)),
    contentDetails=fields(videoId=S, videoPublishedAt=S),
))

CAPTIONS = T.ArrayType(fields(text=S, start=D, duration=D))

JSON3 = fields(events=T.ArrayType(fields(segs=T.ArrayType(fields(utf8=S)))))

# --- envelopes of landed pages --------------------------------------------------------------

SEARCH_ENVELOPE = fields(
    run_id=S, seq=L, theme=S, query=S, search_order=S, published_after=S, published_before=S,
    page_number=L, error=S, response=S,
)
DETAIL_ENVELOPE = fields(run_id=S, seq=L, response=S)
THREAD_ENVELOPE = fields(run_id=S, seq=L, video_id=S, page_number=L, error=S, response=S)
REPLY_ENVELOPE = fields(
    run_id=S, seq=L, video_id=S, thread_id=S, parent_id=S, page_number=L, error=S, response=S)
PLAYLIST_ENVELOPE = fields(run_id=S, seq=L, channel_id=S, page_number=L, response=S)
CAPTION_ENVELOPE = fields(
    video_id=S, language=S, is_generated=B, list_pos=L, captions=CAPTIONS, error_type=S, error_message=S)
CAPTION_PAGE = T.StructType([*fields(run_id=S, seq=L).fields, *CAPTION_ENVELOPE.fields])
SUBTITLE_ATTEMPT = fields(video_id=S, error_type=S, error_message=S)
SPEECH_ENVELOPE = fields(
    video_id=S, language=S, model_size=S,
    segments=T.ArrayType(fields(text=S, start=D, end=D)), error_type=S, error_message=S)


def landed(envelope: T.StructType, response: T.StructType) -> T.StructType:
    """The envelope with its response read straight into a struct instead of text."""
    return T.StructType([
        T.StructField(f.name, response if f.name == "response" else f.dataType) for f in envelope])
