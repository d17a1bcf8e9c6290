"""Edge cases per scalar function."""

import sys

import numpy as np
import pytest
from conftest import column

from commentloom.functions import text, triage, videos
from commentloom.functions.categories import (
    CATEGORY_RULES,
    FALLBACK_CATEGORY,
    confidence_of,
    keyword_category,
)
from commentloom.functions.sentiment import dominant_sentiment, score_for
from commentloom.schemas import SCORES


def check(spark, fn, cases, dtype="string"):
    got = column(spark, fn, [c[0] for c in cases], dtype)
    assert got == [c[1] for c in cases]


def test_parse_duration(spark):
    check(
        spark,
        videos.parse_duration,
        [
            (None, None), ("", None), ("P", 0), ("PT", 0), ("PT15S", 15), ("PT1H2M3S", 3723),
            ("P1DT2H", 93600), ("P1W", 0), ("P1Y2D", 0), ("PT1.5S", 0), ("pt1s", None),
            (" PT1S", None), ("PT5Mxyz", 300), ("abc", None), ("PT90M", 5400), ("PT1S2H", 1),
            ("P\nT1S", 0),
        ],
    )


def test_duration_units_round_half_even(spark):
    seconds = list(range(0, 40000, 7)) + [18, 54, 2070]
    for unit in (60, 3600):
        got = column(spark, lambda c: videos.duration_in(c, unit), seconds, "bigint")
        want = np.round(np.array(seconds) / unit, 2).tolist()
        assert got == want


def test_normalise_lang(spark):
    check(
        spark,
        videos.normalise_lang,
        [
            (None, None), ("", None), ("en-US", "en"), ("PT-br", "pt"), ("zh-Hant-TW", "zh"),
            ("en_US", "en_us"), ("-x", ""),
        ],
    )


def test_language_name(spark):
    check(
        spark, videos.language_name,
        [("en", "English"), ("ko", "Korean"), ("xx", "xx"), ("", ""), (None, "Unknown")],
    )


def test_topic_names(spark):
    check(
        spark,
        videos.topic_names,
        [
            (None, []), ("", []), (" ", []), ("[]", []), (" [ ] ", []), ("nan", []),
            ("['https://e/w/Physical_attractiveness', 'https://e/w/Fashion']",
             ["Physical attractiveness", "Fashion"]),
            ("['a/']", [""]),
            ("""["it's/x_y", 'b']""", ["x y", "b"]),
            ("['a', 'b',]", ["a", "b"]),
            ("['a'", []), ("['a'] x", []), ("['a' 'b']", []), ("[1, 2]", []), ("[None]", []),
            ("'a/b'", []),
        ],
    )


def test_topic_list_of_many_long_urls(spark):
    urls = ", ".join(f"'https://e.example/wiki/{'x' * 2000}_{i}'" for i in range(2000))
    assert len(column(spark, videos.topic_names, [f"[{urls}]"])[0]) == 2000


def test_strip_hashtags(spark):
    check(
        spark,
        text.strip_hashtags,
        [
            ("C# #été! #ad", "C# !"), ("a #b c", "a  c"), ("#", "#"), (None, ""),
            (" #a_1 x　", "x"),
        ],
    )


def test_word_count(spark):
    check(
        spark,
        text.word_count,
        [
            (" a b　c d ", 4), ("", 0), ("  ", 0), ("a​b", 1),
            ("\u001ca\u001db", 2), (None, 0), ("a", 1), ("\n\ta b\r\n", 2),
        ],
    )


def test_whitespace_matches_python(spark):
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c <= 0xDFFF]
    got = column(spark, lambda c: f"{text.strip(c)} = ''", [chr(c) for c in points])
    assert [p for p, g in zip(points, got) if g] == [p for p in points if chr(p).isspace()]


def test_strip_is_linear_on_inner_blanks(spark):
    body = "a" + " " * 200_000 + "b"
    assert column(spark, text.strip, [f" {body} "]) == [body]


def test_comment_length(spark):
    check(spark, text.comment_length, [("\U0001f600\U0001f600 a", 4), (None, 0), ("", 0), (" a ", 3)])


def test_is_spam(spark):
    check(
        spark,
        triage.is_spam,
        [
            (None, False), ("", False), (" ok ", True), ("HTTP://x y z w", False),
            ("see https://x", True), ("http://", True), ("   ", True), (" abc ", False),
            ("a\nb", False), ("\U0001f600\U0001f600", True),
            ("\U0001f600\U0001f600\U0001f600", False),
        ],
    )


def test_is_spam_matches_python_on_random_text(spark):
    rng = np.random.default_rng(1)
    alphabet = list("ab \t\n 　\U0001f600") + ["http://", "https:/"]
    values = ["".join(rng.choice(alphabet, size=rng.integers(1, 8))) for _ in range(500)]
    want = ["http://" in v or "https://" in v or len(v.strip()) < 3 for v in values]
    assert column(spark, triage.is_spam, values) == want


def test_keyword_category(spark):
    check(
        spark,
        keyword_category,
        [
            ("I LOVE this brand", "Brand Loyalty"), ("recommended", "Product Inquiry"),
            ("multiple", "Application Tip"), ("it broke out", "Negative Experience"),
            (None, FALLBACK_CATEGORY), ("", FALLBACK_CATEGORY), ("Obsessed", "Product Praise"),
            ("interesting", "Negative Experience"), ("plain", FALLBACK_CATEGORY),
        ],
    )


def test_every_keyword_gives_the_first_category_that_holds_part_of_it(spark):
    keywords = [k for v in CATEGORY_RULES.values() for k in v]
    assert len(keywords) == 64
    want = [next(n for n, ks in CATEGORY_RULES.items() if any(k in w for k in ks)) for w in keywords]
    assert column(spark, keyword_category, [w.upper() for w in keywords]) == want


def test_category_confidence(spark):
    got = column(spark, lambda c: confidence_of(keyword_category(c)), ["spf", "plain"])
    assert got == [0.9, 0.5]


def test_quality_score(spark):
    sizes = [0, 1, 19, 20, 49, 50, 500]
    texts = [" ".join(["w"] * n) for n in sizes]
    assert column(spark, triage.quality_score, texts) == [1, 1, 1, 2, 4, 5, 5]


def scores(*pairs):
    return [{"label": label, "score": score} for label, score in pairs]


@pytest.mark.parametrize(
    "value, want",
    [
        (scores(("positive", 0.0), ("negative", 0.0)), "Neutral"),
        (scores(("negative", 0.4), ("positive", 0.4), ("neutral", 0.2)), "Negative"),
        (scores(("neutral", 0.1), ("POSITIVE", 0.8)), "Positive"),
        ([], "Neutral"),
        (None, None),
    ],
)
def test_dominant_sentiment(spark, value, want):
    df = spark.createDataFrame([(value,)], f"s {SCORES.simpleString()}")
    assert df.selectExpr(f"{dominant_sentiment('s')} AS x").first()["x"] == want


def test_spread_scores(spark):
    value = scores(("Positive", 0.1), ("positive", 0.7), ("NEUTRAL", 0.2))
    df = spark.createDataFrame([(value,)], f"s {SCORES.simpleString()}")
    row = df.selectExpr(*[score_for("s", n) for n in ("positive", "negative", "neutral")]).first()
    assert tuple(row) == (0.7, 0.0, 0.2)


def test_fill_and_cast_counts(spark):
    assert column(spark, videos.fill_count, [None, 2.9, 3.0], "double") == [0, 2, 3]
    assert column(spark, videos.fill_count, [float("nan"), -1.5], "double") == [0, -1]
    assert column(spark, videos.as_count, [None, float("nan"), 3.0], "double") == [None, None, 3.0]
    assert sys.float_info.max in column(spark, videos.as_count, [sys.float_info.max], "double")
