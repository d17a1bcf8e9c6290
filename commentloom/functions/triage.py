"""Cheap row-local checks that decide which comments are worth scoring."""

from __future__ import annotations

from commentloom.functions import quote
from commentloom.functions.text import WHITESPACE, has_text, word_count

# Fixed values.
LINK_MARKERS = ("http://", "https://")
MIN_RELEVANT_WORDS = 4
MAX_QUALITY = 5
WORDS_PER_QUALITY_POINT = 10


def is_spam(text: str) -> str:
    """A link (case-sensitive), or fewer than three characters once stripped; no text is not spam."""
    links = " OR ".join(f"contains({text}, {quote(m)})" for m in LINK_MARKERS)
    # Three stripped characters = two non-blanks with something in between; no copy is made.
    long_enough = f"{text} RLIKE {quote(f'(?s)[^{WHITESPACE}].+[^{WHITESPACE}]')}"
    return f"CASE WHEN {has_text(text)} THEN {links} OR NOT ({long_enough}) ELSE false END"


def is_relevant(spam: str, words: str) -> str:
    return f"(NOT {spam} AND {words} >= {MIN_RELEVANT_WORDS})"


def language_confidence(text: str) -> str:
    return f"CASE WHEN {has_text(text)} THEN 1.0D ELSE 0.0D END"


def quality_from_words(words: str) -> str:
    points = f"({words} DIV {WORDS_PER_QUALITY_POINT})"
    return f"int(least({MAX_QUALITY}, greatest(1, {points})))"


def quality_score(text: str) -> str:
    return quality_from_words(f"({word_count(text)})")
