"""Text primitives with Unicode-aware whitespace and word rules."""

from __future__ import annotations

from commentloom.functions import quote

# The Unicode whitespace set, as the body of a regex character class.
# Java's \s covers only part of it, and trim() only U+0020.
WHITESPACE = (
    r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a"
    r"\u2028\u2029\u202f\u205f\u3000"
)
HASHTAG = r"#[\p{L}\p{N}_]+"


def has_text(text: str) -> str:
    return f"coalesce({text}, '') <> ''"


def strip(text: str) -> str:
    # The look-behind lets a run in mid-text fail at once instead of once per character.
    ends = rf"\A[{WHITESPACE}]+|(?<![{WHITESPACE}])[{WHITESPACE}]+\z"
    return f"regexp_replace({text}, {quote(ends)}, '')"


def word_count(text: str) -> str:
    """Whitespace-separated tokens; 0 for NULL, empty and blank text."""
    pieces = f"size(split({text}, {quote(f'[{WHITESPACE}]+')}))"
    leading = rf"int({text} RLIKE {quote(rf'\A[{WHITESPACE}]')})"
    trailing = rf"int({text} RLIKE {quote(rf'[{WHITESPACE}]\z')})"
    return f"CASE WHEN {has_text(text)} THEN {pieces} - {leading} - {trailing} ELSE 0 END"


def comment_length(text: str) -> str:
    """Code points of the unstripped text."""
    return f"coalesce(length({text}), 0)"


def fill_text(text: str) -> str:
    return f"coalesce({text}, '')"


def strip_hashtags(text: str) -> str:
    """Delete #words and strip the ends; inner blanks stay, and so does a lone #."""
    return strip(f"regexp_replace({fill_text(text)}, {quote(HASHTAG)}, '')")
