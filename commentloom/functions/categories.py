"""Keyword categories, compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from commentloom.functions import quote

# Categories in priority order, each with its keywords.
CATEGORY_RULES: dict[str, tuple[str, ...]] = {
    "Ingredient Mention": (
        "spf", "retinol", "vitamin c", "hyaluronic", "niacinamide", "ingredient",
        "formula", "chemical", "fragrance", "paraben", "sulfate", "acid",
    ),
    "Application Tip": (
        "apply", "how to", "tutorial", "technique", "blend", "brush", "tip", "trick",
        "routine", "step", "use it",
    ),
    "Brand Loyalty": (
        "love this brand", "always buy", "loyal", "favorite brand", "will never switch",
        "best brand", "only brand",
    ),
    "Product Inquiry": (
        "where can i", "which one", "recommend", "which product", "does it work", "how long",
        "available", "price", "how much", "worth it",
    ),
    "Negative Experience": (
        "broke out", "irritat", "burn", "sting", "rash", "ruin", "worst", "return", "refund",
        "disappoint", "waste", "scam", "fake",
    ),
    "Product Praise": (
        "love", "amazing", "great", "perfect", "flawless", "glow", "obsessed", "holy grail",
        "repurchas", "recommended", "works great",
    ),
}
FALLBACK_CATEGORY = "General Feedback"
MATCH_CONFIDENCE = 0.9
FALLBACK_CONFIDENCE = 0.5


def contains_any(lowered: str, keywords: Sequence[str]) -> str:
    return " OR ".join(f"contains({lowered}, {quote(k)})" for k in keywords)


def category_of(lowered: str, rules: Mapping[str, Sequence[str]] = CATEGORY_RULES) -> str:
    """First category, in declared order, with a keyword inside the lower-cased text."""
    return first_match(lowered, list(rules.items()))


def first_match(lowered: str, ordered: Sequence[tuple[str, Sequence[str]]]) -> str:
    branches = [
        f"WHEN {contains_any(lowered, keywords)} THEN {quote(name)}" for name, keywords in ordered
    ]
    fallback = quote(FALLBACK_CATEGORY)
    return f"CASE {' '.join(branches)} ELSE {fallback} END" if branches else fallback


def keyword_category(text: str, rules: Mapping[str, Sequence[str]] = CATEGORY_RULES) -> str:
    # A one-element transform names the lowered text, so it is worked out once.
    lowered = f"array(lower(coalesce({text}, '')))"
    return f"transform({lowered}, lowered -> {category_of('lowered', rules)})[0]"


def confidence_of(category: str) -> str:
    """Confidence that goes with a category picked by ``category_of``."""
    return (
        f"CASE WHEN {category} = {quote(FALLBACK_CATEGORY)} THEN {FALLBACK_CONFIDENCE}D "
        f"WHEN {category} IS NOT NULL THEN {MATCH_CONFIDENCE}D END"
    )


def rules_table(
    spark: SparkSession, rules: Mapping[str, Sequence[str]] = CATEGORY_RULES
) -> DataFrame:
    """The mapping as rows of (priority, category, keyword)."""
    rows = [
        f"({priority}, {quote(name)}, {quote(keyword)})"
        for priority, (name, keywords) in enumerate(rules.items(), start=1)
        for keyword in keywords
    ]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(priority, category, keyword)")
