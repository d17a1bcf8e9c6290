"""Newest-first ranking per group, built so that one huge group never lands in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.operators.running import running_total

SAMPLE_PER_VIDEO = 50
SALT_BUCKETS = 16
# Width of the time slices that a full rank is put together from.
SLICE_SECONDS = 3600


def newest_first() -> list[Column]:
    """Newest comment first; the id makes the order total."""
    return [F.col("published_at").desc(), F.col("comment_id").desc()]


def salt(columns: Sequence[str], buckets: int) -> Column:
    """A bucket number that depends on the row only, so a retried task gives the same one."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    spread_by: Sequence[str],
    buckets: int = SALT_BUCKETS,
    rank: str = "rank",
) -> DataFrame:
    """First k rows of each group, with their rank.

    The group is split by salt first, each part keeps its own first k, and only those meet in the
    final ranking. Both rankings are cut to k before their shuffle as well (WindowGroupLimit).
    """
    part = W.partitionBy(*keys, "_salt").orderBy(*order)
    whole = W.partitionBy(*keys).orderBy(*order)
    survivors = (
        df.withColumn("_salt", salt(spread_by, buckets))
        .withColumn("_part_rank", F.row_number().over(part))
        .where(F.col("_part_rank") <= k)
        .drop("_salt", "_part_rank")
    )
    return survivors.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def with_ties(df: DataFrame, first: Sequence[Column], keys: Sequence[str]) -> list[Column]:
    """An order that the remaining columns make total, so that a retried task picks the same row."""
    return [*first, *[F.col(f"`{c}`") for c in df.columns if c not in keys]]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order, ties broken by the other columns.

    Every map task passes on at most one row per key, so a key with many copies stays small.
    """
    window = W.partitionBy(*keys).orderBy(*with_ties(df, order, keys))
    return (
        df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")
    )


def priority_sample(pending: DataFrame, k: int = SAMPLE_PER_VIDEO) -> DataFrame:
    """Keys of the newest k pending comments of each video; comments without video are one group."""
    return top_k_per_group(
        pending.select("comment_id", "video_id", "published_at"),
        keys=["video_id"],
        order=newest_first(),
        k=k,
        spread_by=["comment_id", "published_at"],
    )


def priority_rank(pending: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Newest-first rank of every pending comment within its video.

    A video's comments are counted per time slice; the counts of newer slices plus the place within
    the slice give the rank. No task holds more of a video than one slice of it.
    """
    keyed = pending.select("comment_id", "video_id", "published_at")
    # Slices rise from new to old; comments without a time come last.
    seconds = F.unix_seconds(F.col("published_at").cast("timestamp"))
    old = F.coalesce(-F.floor(seconds / slice_seconds), F.lit(2**62))
    ahead = running_total(
        keyed.withColumn("_slice", old), ["video_id"], "_slice", newest_first(), F.lit(1), "_ahead"
    )
    return ahead.select(*keyed.columns, (F.col("_ahead") + 1).alias("rank"))


def enrichment_phase(
    pending: DataFrame, k: int = SAMPLE_PER_VIDEO, buckets: int = SALT_BUCKETS
) -> DataFrame:
    """Phase 1 for the newest k pending comments of each video, phase 2 for the rest.

    Both phases are taken from one snapshot of the pending rows. The k-th newest row of a video
    is its cut-off: one small row per video, copied once per salt so that the comments of a huge
    video (or those without one) are spread over tasks.
    """
    keyed = pending.select("comment_id", "video_id", "published_at")
    cutoffs = (
        priority_sample(pending, k)
        .where(F.col("rank") == k)
        .select(
            F.col("video_id").alias("_video"),
            F.struct("published_at", "comment_id").alias("_cut"),
            F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_cut_salt"),
        )
    )
    salted = keyed.withColumn("_salt", salt(["comment_id", "published_at"], buckets))
    same = F.col("video_id").eqNullSafe(F.col("_video")) & (F.col("_salt") == F.col("_cut_salt"))
    in_sample = F.col("_cut").isNull() | (
        F.struct("published_at", "comment_id") >= F.col("_cut")
    )
    return salted.join(cutoffs, same, "left").select(
        "comment_id",
        "video_id",
        "published_at",
        F.when(in_sample, F.lit(1)).otherwise(F.lit(2)).alias("phase"),
    )


def ordered_batch(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows in a stated order, for callers that want a bounded batch."""
    if not order:
        raise ValueError("a batch needs an order; without one its rows are arbitrary")
    return df.orderBy(*order).limit(n)
