"""Comment triage and enrichment as lazy plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.functions.categories import category_of, confidence_of
from commentloom.functions.sentiment import dominant_sentiment, spread_scores
from commentloom.functions.text import comment_length, word_count
from commentloom.functions.triage import (
    is_relevant,
    is_spam,
    language_confidence,
    quality_from_words,
)
from commentloom.operators.language import UNKNOWN, LanguageProfile, detect_language
from commentloom.operators.merging import with_skip_defaults
from commentloom.operators.ranking import dedupe_latest
from commentloom.operators.scoring import LexiconScorer, Scorer
from commentloom.schemas import ENRICHMENT

KEY = ("comment_id", "published_at")


def triage_comments(
    comments: DataFrame, keep: Sequence[str] = KEY, text: str = "text_original"
) -> DataFrame:
    """Spam flag, relevance, word count and length per comment."""
    return comments.selectExpr(
        *keep,
        text,
        f"{is_spam(text)} AS is_spam",
        f"{word_count(text)} AS word_count",
        f"{comment_length(text)} AS comment_length",
        f"{language_confidence(text)} AS language_confidence",
    ).selectExpr("*", f"{is_relevant('is_spam', 'word_count')} AS is_relevant")


def score_comments(
    triaged: DataFrame, scorer: Scorer, keep: Sequence[str], text: str = "text_original"
) -> DataFrame:
    """Sentiment, category and quality for relevant rows; NULL for the others.

    The scorer sees NULL instead of an irrelevant text, so the model never runs on it.
    """
    body = f"if(is_relevant, {text}, NULL)"
    scored = scorer.add_scores(triaged, body, "_scores").select(*keep, text, "word_count", "_scores")
    # No scores, whether skipped or failed, means no category either.
    lowered = scored.selectExpr(
        *keep,
        text,
        f"{dominant_sentiment('_scores')} AS sentiment",
        *spread_scores("_scores"),
        f"if(_scores IS NOT NULL, {quality_from_words('word_count')}, NULL) AS quality_score",
        f"if(_scores IS NOT NULL, lower({text}), NULL) AS _lowered",
    )
    categorised = lowered.selectExpr(
        "* EXCEPT (_lowered)",
        f"if(_lowered IS NOT NULL, {category_of('_lowered')}, NULL) AS category",
    )
    return categorised.selectExpr("*", f"{confidence_of('category')} AS category_confidence")


def enrich_rows(
    comments: DataFrame,
    scorer: Scorer | None = None,
    keep: Sequence[str] = KEY,
    text: str = "text_original",
) -> DataFrame:
    """Row-local part of the enrichment: everything but the language. One narrow stage."""
    triaged = triage_comments(comments, keep, text)
    carried = [*keep, "is_spam", "comment_length", "language_confidence"]
    return score_comments(triaged, scorer or LexiconScorer(), carried, text)


def enrich_comments(
    comments: DataFrame,
    profile: LanguageProfile | None = None,
    scorer: Scorer | None = None,
    text: str = "text_original",
) -> DataFrame:
    """One enrichment row per comment id: the id, its newest publish time and 11 columns.

    Without a language profile every language is ``unknown``.
    """
    rows = enrich_rows(comments, scorer, KEY, text)
    if profile is None:
        rows = rows.drop(text).withColumn("language", F.lit(UNKNOWN))
    else:
        narrow = [c for c in rows.columns if c != text]
        rows = detect_language(rows, profile, text, narrow)
    # Copies of an id share one enrichment, that of the newest; only narrow rows are shuffled.
    newest = dedupe_latest(rows, ["comment_id"], [F.col("published_at").desc()])
    return with_skip_defaults(newest).select(*KEY, *ENRICHMENT.fieldNames())
