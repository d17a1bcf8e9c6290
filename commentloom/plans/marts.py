"""Dashboard tables over enriched comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.functions.sentiment import LABELS
from commentloom.operators.ranking import salt
from commentloom.sources.tables import WEEK, overwrite_parts, part_week, rows_of_parts, stored

ORPHAN_BUCKETS = 256


def comments_with_videos(
    comments: DataFrame, videos: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Comments with columns of their video, prefixed ``video_``; comments without one are kept.

    Comments that name no video cannot match, so they are spread over many join keys instead of
    meeting in the partition of NULL. A huge video is left to the skew-join splitting of AQE,
    which works here because the video side is unique.
    """
    side = videos.select(
        F.col("video_id").alias("_video_id"), *[F.col(c).alias(f"video_{c}") for c in columns]
    )
    orphan = F.concat(
        F.lit("\u0000"), salt(["comment_id", "published_at"], ORPHAN_BUCKETS).cast("string")
    )
    joined = comments.withColumn("_join", F.coalesce(F.col("video_id"), orphan)).join(
        side, F.col("_join") == F.col("_video_id"), "left"
    )
    return joined.drop("_join", "_video_id")


def share_within(count: str, groups: Sequence[str]) -> str:
    """Part of a count in the total of its group; runs over aggregated rows only."""
    part = f"PARTITION BY {', '.join(groups)}" if groups else ""
    return f"{count} / sum({count}) OVER ({part}) AS share"


def sentiment_trend(enriched: DataFrame, bucket: str = "day") -> DataFrame:
    """Comments per time bucket and sentiment: count, mean scores, share of the bucket."""
    means = [F.expr(f"avg(sentiment_score_{s}) AS mean_{s}") for s in LABELS]
    return (
        enriched.groupBy(F.date_trunc(bucket, "published_at").alias("bucket"), "sentiment")
        .agg(F.expr("count(1) AS comments"), *means)
        .selectExpr("*", share_within("comments", ["bucket"]))
    )


def category_breakdown(enriched: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Comments per category and sentiment, within optional further dimensions."""
    return (
        enriched.groupBy(*dims, "category", "sentiment")
        .agg(
            F.expr("count(1) AS comments"),
            F.expr("avg(category_confidence) AS mean_confidence"),
            F.expr("avg(quality_score) AS mean_quality"),
        )
        .selectExpr("*", share_within("comments", dims))
    )


def group_comparison(enriched: DataFrame, by: str) -> DataFrame:
    """Sentiment mix and net score of each group, such as a channel."""
    mix = [F.expr(f"count_if(sentiment = '{s.capitalize()}') AS {s}") for s in LABELS]
    net = F.expr("avg(sentiment_score_positive - sentiment_score_negative) AS net_score")
    return enriched.groupBy(by).agg(F.expr("count(1) AS comments"), *mix, net)


TREND_PARTS = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        T.StructField("sentiment", T.StringType()),
        T.StructField("delivery", T.StringType()),
        T.StructField("comments", T.LongType()),
        *[T.StructField(f"sum_{s}", T.DoubleType()) for s in LABELS],
    ]
)


def trend_parts(enriched: DataFrame, delivery: str, bucket: str = "day") -> DataFrame:
    """What one delivery adds to the sentiment trend: counts and sums, which can be added up, unlike means."""
    return enriched.groupBy(F.date_trunc(bucket, "published_at").alias("bucket"), "sentiment").agg(
        F.count(F.lit(1)).alias("comments"),
        *[F.sum(f"sentiment_score_{s}").alias(f"sum_{s}") for s in LABELS],
    ).select("bucket", "sentiment", F.lit(delivery).alias("delivery"), "comments", *[f"sum_{s}" for s in LABELS])


def add_to_trend(enriched: DataFrame, table: str, delivery: str, bucket: str = "day") -> None:
    """Put a delivery into the declared table of trend parts; only the weeks that it touches are read and written.

    A delivery that is put in again takes the place of what it was in those weeks. One run at a time.
    """
    added = stored(trend_parts(enriched, delivery, bucket).withColumn(WEEK, part_week(F.col("bucket"))), "trend")
    weeks = stored(added.groupBy(WEEK).agg(F.count(F.lit(1)).alias("n")), "weeks")
    held = rows_of_parts(added.sparkSession.table(table), weeks, WEEK).where(F.col("delivery") != delivery)
    overwrite_parts(held.select(*added.columns).union(added), table)


def trend_of_parts(parts: DataFrame) -> DataFrame:
    """The sentiment trend from the parts of all deliveries: a pass over a few rows per bucket."""
    sums = parts.groupBy("bucket", "sentiment").agg(
        F.sum("comments").alias("comments"), *[F.sum(f"sum_{s}").alias(f"sum_{s}") for s in LABELS]
    )
    means = [f"sum_{s} / comments AS mean_{s}" for s in LABELS]
    return sums.selectExpr("bucket", "sentiment", "comments", *means, share_within("comments", ["bucket"]))
