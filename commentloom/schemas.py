"""Table layouts. Every layer has a declared schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

COUNT = T.DecimalType(38, 6)

# Column names, order and types of the raw and clean layers.
STAGING_VIDEOS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("video_id", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("default_language", T.StringType()),
        T.StructField("default_audio_language", T.StringType()),
        T.StructField("content_duration", T.StringType()),
        T.StructField("view_count", COUNT),
        T.StructField("like_count", COUNT),
        T.StructField("favourite_count", COUNT),
        T.StructField("comment_count", COUNT),
        T.StructField("topic_categories", T.StringType()),
    ]
)

CLEAN_VIDEOS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("channel_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("language_name", T.StringType()),
        T.StructField("duration_seconds", T.IntegerType()),
        T.StructField("view_count", T.DoubleType()),
        T.StructField("like_count", T.DoubleType()),
        T.StructField("favourite_count", T.DoubleType()),
        T.StructField("comment_count", T.DoubleType()),
        T.StructField("topic_categories", T.ArrayType(T.StringType())),
    ]
)

RAW_COMMENTS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("comment_id", T.LongType()),
        T.StructField("channel_id", T.LongType()),
        T.StructField("video_id", T.StringType()),
        T.StructField("author_id", T.LongType()),
        T.StructField("text_original", T.StringType()),
        T.StructField("parent_comment_id", T.LongType()),
        T.StructField("like_count", COUNT),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

ENRICHMENT = T.StructType(
    [
        T.StructField("sentiment", T.StringType()),
        T.StructField("sentiment_score_positive", T.DoubleType()),
        T.StructField("sentiment_score_negative", T.DoubleType()),
        T.StructField("sentiment_score_neutral", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("category_confidence", T.DoubleType()),
        T.StructField("quality_score", T.IntegerType()),
        T.StructField("is_spam", T.BooleanType()),
        T.StructField("language", T.StringType()),
        T.StructField("language_confidence", T.DoubleType()),
        T.StructField("comment_length", T.IntegerType()),
    ]
)

# What an enrichment run gives: the key and the enrichment.
ENRICHED = T.StructType(
    [
        T.StructField("comment_id", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
        *ENRICHMENT.fields,
    ]
)

COMMENTS = T.StructType(RAW_COMMENTS.fields + ENRICHMENT.fields)

SCORES = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)

# Header names of the camelCase video export, by clean-layer name.
CAMEL_VIDEO_COLUMNS = {
    "kind": "kind",
    "videoId": "video_id",
    "publishedAt": "published_at",
    "channelId": "channel_id",
    "title": "title",
    "description": "description",
    "tags": "tags",
    "defaultLanguage": "default_language",
    "defaultAudioLanguage": "default_audio_language",
    "contentDuration": "content_duration",
    "viewCount": "view_count",
    "likeCount": "like_count",
    "favouriteCount": "favourite_count",
    "commentCount": "comment_count",
    "topicCategories": "topic_categories",
}
