"""Key-based joins that keep raw, pending, enriched and clean layers in step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.functions import quote
from commentloom.schemas import ENRICHMENT

# What a comment that was triaged but not scored gets.
SKIP_DEFAULTS = {
    "sentiment": "N/A",
    "sentiment_score_positive": 0.0,
    "sentiment_score_negative": 0.0,
    "sentiment_score_neutral": 0.0,
    "category": "Skipped",
    "category_confidence": 0.0,
    "quality_score": 1,
    "is_spam": False,
    "language": "unknown",
    "language_confidence": 0.0,
    "comment_length": 0,
}


def with_skip_defaults(df: DataFrame) -> DataFrame:
    """Complete enrichment rows: absent columns and NULLs get their defaults."""
    present = df.columns
    others = [f"`{c}`" for c in present if c not in SKIP_DEFAULTS]
    filled = []
    for field in ENRICHMENT.fields:
        value = SKIP_DEFAULTS[field.name]
        literal = quote(value) if isinstance(value, str) else str(value).lower()
        default = f"cast({literal} AS {field.dataType.simpleString()})"
        source = f"coalesce(`{field.name}`, {default})" if field.name in present else default
        filled.append(f"{source} AS `{field.name}`")
    return df.selectExpr(*others, *filled)


def pending_comments(comments: DataFrame, enriched: DataFrame) -> DataFrame:
    """Comments whose id has no enrichment yet."""
    return comments.join(enriched.select("comment_id"), "comment_id", "left_anti")


def still_pending(comments: DataFrame) -> DataFrame:
    """The same on a merged table, where NULL sentiment means pending."""
    return comments.where(F.col("sentiment").isNull())


def fetch_by_ids(comments: DataFrame, ids: DataFrame) -> DataFrame:
    """Every row whose id is listed, all rows of a shared id included."""
    return comments.join(ids.select("comment_id"), "comment_id", "left_semi")


def merge_triage_and_scores(triage: DataFrame, scores: DataFrame) -> DataFrame:
    """Per id, triage columns next to scoring columns; unscored rows keep the defaults.

    ``scores`` holds one row per id.
    """
    return with_skip_defaults(triage.join(scores, "comment_id", "left"))


def apply_enrichment(comments: DataFrame, enriched: DataFrame) -> DataFrame:
    """Comments with enrichment columns replaced wherever the id is enriched.

    The enriched side holds one row per id. A matched row takes all of its columns, defaults for
    missing ones included; an unmatched row keeps what it had.
    """
    update = with_skip_defaults(enriched).selectExpr(
        "comment_id", f"struct({', '.join(ENRICHMENT.fieldNames())}) AS _update"
    )
    present = comments.columns
    others = [f"`{c}`" for c in present if c not in SKIP_DEFAULTS]
    replaced = []
    for field in ENRICHMENT.fields:
        old = f"`{field.name}`" if field.name in present else "NULL"
        kind = field.dataType.simpleString()
        replaced.append(
            f"if(_update IS NOT NULL, _update.{field.name}, cast({old} AS {kind})) AS `{field.name}`"
        )
    return comments.join(update, "comment_id", "left").selectExpr(*others, *replaced)


def upsert(target: DataFrame, source: DataFrame, key: str = "video_id") -> DataFrame:
    """Insert or replace whole rows by key; a NULL in the source replaces a value too.

    The source holds one row per key (see ``dedupe_latest``).
    """
    kept = target.join(source.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def drain_staging(staging: DataFrame, processed: DataFrame, key: str = "video_id") -> DataFrame:
    """Staging rows that are still to do."""
    return staging.join(processed.select(key), key, "left_anti").select(*staging.columns)
