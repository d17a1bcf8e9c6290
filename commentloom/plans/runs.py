"""Whole runs over declared tables: enrich what is pending, clean what is staged."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from commentloom.operators.language import LanguageProfile
from commentloom.operators.merging import apply_enrichment, drain_staging, fetch_by_ids, still_pending
from commentloom.operators.ranking import SAMPLE_PER_VIDEO, dedupe_latest, enrichment_phase
from commentloom.operators.scoring import Scorer
from commentloom.plans.comments import enrich_comments
from commentloom.plans.videos import clean_videos
from commentloom.sources.tables import WEEK, overwrite_parts, rows_of_parts, stored, upsert_into


def run_enrichment(
    spark: SparkSession,
    comments: str = "comments",
    k: int = SAMPLE_PER_VIDEO,
    profile: LanguageProfile | None = None,
    scorer: Scorer | None = None,
) -> None:
    """Enrich the pending comments of the declared table, the newest k of each video first.

    Both phases come from one snapshot of the pending ids, stored once. Each phase is written when it is done, so
    dashboards have the sample early, and a run that is broken off goes on with what is pending then. Only the weeks
    of enriched comments are read and written again. One run at a time.
    """
    phases = enrichment_phase(still_pending(spark.table(comments)), k)
    pending = stored(phases.groupBy("comment_id").agg(F.min("phase").alias("phase")), "pending")
    for phase in (1, 2):
        table = spark.table(comments)
        # All rows of an id share its enrichment, that of the newest one.
        rows = fetch_by_ids(table, pending.where(F.col("phase") == phase))
        weeks = stored(rows.groupBy(WEEK).agg(F.count(F.lit(1)).alias("n")), "weeks")
        if weeks.isEmpty():
            continue
        enriched = stored(enrich_comments(rows, profile, scorer), "enriched")
        merged = apply_enrichment(rows_of_parts(table, weeks, WEEK), enriched.drop("published_at"))
        overwrite_parts(merged, comments)


def run_cleaning(spark: SparkSession, staging: str = "videos_staging", videos: str = "videos") -> None:
    """Clean the staged videos, upsert them and take them out of the staging table.

    A run that is broken off in between is made good by the next: the same rows are upserted once more. One run at a
    time, and no load into the staging table meanwhile.
    """
    staged = spark.table(staging)
    cleaned = dedupe_latest(clean_videos(staged), ["video_id"], [F.col("published_at").desc()])
    cleaned = stored(cleaned, "cleaned")
    left = stored(drain_staging(staged, cleaned), "left")
    upsert_into(cleaned, videos)
    overwrite_parts(left, staging)
