"""Video cleaning as one narrow, JVM-only projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from commentloom.functions.text import fill_text, strip_hashtags
from commentloom.functions.videos import (
    as_count,
    duration_in,
    fill_count,
    language_name,
    parse_duration,
    resolve_lang,
    topic_names,
)
from commentloom.schemas import CLEAN_VIDEOS

COUNTS = ("view_count", "like_count", "favourite_count", "comment_count")


def clean_videos(
    staging: DataFrame,
    strip_tags: bool = True,
    fill_tags: bool = False,
    whole_counts: bool = False,
    longer_units: bool = False,
) -> DataFrame:
    """Raw to clean videos.

    The options give the variant of the standalone cleaning script: hashtags kept, missing tags
    and counts filled, durations in minutes and hours added.
    """
    description = strip_hashtags if strip_tags else fill_text
    count = fill_count if whole_counts else as_count
    seconds = parse_duration("content_duration")
    code = resolve_lang("default_language", "default_audio_language")
    sources = {
        "description": description("description"),
        "tags": fill_text("tags") if fill_tags else "tags",
        "published_at": "cast(published_at AS timestamp)",
        "language_name": language_name(code),
        "duration_seconds": f"try_cast({seconds} AS INT)",
        "topic_categories": topic_names("topic_categories"),
        **{name: count(name) for name in COUNTS},
    }
    columns = [f"{sources.get(n, n)} AS {n}" for n in CLEAN_VIDEOS.fieldNames()]
    if longer_units:
        columns += [
            f"{duration_in(seconds, 60)} AS duration_minutes",
            f"{duration_in(seconds, 3600)} AS duration_hours",
        ]
    return staging.selectExpr(*columns)
