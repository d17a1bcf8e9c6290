"""Video metadata functions: durations, languages, topics, counts."""

from __future__ import annotations

from commentloom.functions import quote
from commentloom.functions.text import strip

# Seconds per duration part, in the order of the pattern's groups.
DURATION = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?"
DURATION_PARTS = (86400, 3600, 60, 1)

# Display names by language code.
LANGUAGE_NAMES = {
    "en": "English",
    "fr": "French",
    "pt": "Portuguese",
    "es": "Spanish",
    "de": "German",
    "it": "Italian",
    "zh": "Chinese",
    "ja": "Japanese",
    "ko": "Korean",
}
UNKNOWN_LANGUAGE = "Unknown"

QUOTED = r"""(?:'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+")"""
STRING_LIST = rf"(?s)\A[ \t]*+\[\s*+(?:{QUOTED}\s*+(?:,\s*+|(?=\])))*+\]\s*+\z"


def parse_duration(iso: str) -> str:
    """Seconds of the leading ISO-8601 part; NULL unless the text starts with P."""
    parts = []
    for group, unit in enumerate(DURATION_PARTS, start=1):
        digits = f"nullif(regexp_extract({iso}, {quote(DURATION)}, {group}), '')"
        parts.append(f"coalesce(try_cast({digits} AS BIGINT), 0L) * {unit}L")
    return f"CASE WHEN startswith({iso}, 'P') THEN {' + '.join(parts)} END"


def duration_in(seconds: str, unit: int) -> str:
    """Seconds in a larger unit, two decimals, halves to even on the scaled value."""
    return f"rint({seconds} / {unit}D * 100D) / 100D"


def normalise_lang(code: str) -> str:
    return f"CASE WHEN {code} <> '' THEN lower(split_part({code}, '-', 1)) END"


def resolve_lang(default: str, audio: str) -> str:
    return f"coalesce({normalise_lang(default)}, {normalise_lang(audio)})"


def language_name(code: str) -> str:
    pairs = ", ".join(f"{quote(c)}, {quote(n)}" for c, n in LANGUAGE_NAMES.items())
    return f"coalesce(element_at(map({pairs}), {code}), {code}, {quote(UNKNOWN_LANGUAGE)})"


def topic_names(literal: str) -> str:
    """Last URL segments of a list literal of strings, underscores as blanks.

    Anything that is not a list of quoted strings gives an empty list.
    """
    # A trailing comma is legal in the literal but not in JSON.
    tidy = rf"regexp_replace({literal}, {quote(r',\s*\]\s*\z')}, ']')"
    urls = (
        f"CASE WHEN {literal} RLIKE {quote(STRING_LIST)} "
        f"THEN from_json({strip(tidy)}, 'array<string>') END"
    )
    names = f"transform({urls}, u -> translate(substring_index(u, '/', -1), '_', ' '))"
    return f"coalesce({names}, cast(array() AS array<string>))"


def fill_count(count: str) -> str:
    """Missing counts and NaN as 0, fractions cut off."""
    return f"CASE WHEN isnan(double({count})) THEN 0L ELSE bigint(coalesce({count}, 0)) END"


def as_count(count: str) -> str:
    """A count as DOUBLE, with NaN read as missing."""
    return f"nullif(double({count}), double('NaN'))"
