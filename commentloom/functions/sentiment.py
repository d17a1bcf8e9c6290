"""From scorer output, an array of (label, score), to sentiment columns."""

from __future__ import annotations

from commentloom.functions import quote

# Fixed values.
DEFAULT_SENTIMENT = "Neutral"
LABELS = ("positive", "negative", "neutral")
SCORE_COLUMNS = tuple(f"sentiment_score_{label}" for label in LABELS)


def dominant_sentiment(scores: str) -> str:
    """Label of the first largest score above zero, capitalised; otherwise Neutral."""
    top = f"array_max({scores}.score)"
    label = f"try_element_at({scores}.label, int(array_position({scores}.score, {top})))"
    return (
        f"CASE WHEN {scores} IS NULL THEN NULL "
        f"WHEN {top} > 0 THEN concat(upper(left({label}, 1)), lower(substring({label}, 2))) "
        f"ELSE {quote(DEFAULT_SENTIMENT)} END"
    )


def score_for(scores: str, label: str) -> str:
    """Score of a label, matched without case; the last wins, and a missing one is 0.0."""
    same = f"filter({scores}, s -> lower(s.label) = {quote(label)})"
    return f"if({scores} IS NULL, NULL, coalesce(try_element_at({same}, -1).score, 0.0D))"


def spread_scores(scores: str) -> list[str]:
    return [f"{score_for(scores, label)} AS sentiment_score_{label}" for label in LABELS]
