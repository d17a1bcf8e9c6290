"""Joins, ranking, rules, scoring and profiling on small tables with skew and odd keys."""

import collections
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from conftest import column, plan_of
from pyspark.sql import functions as F

from commentloom.functions.categories import confidence_of, first_match, rules_table
from commentloom.operators import merging, profiling, ranking
from commentloom.operators.language import (
    LanguageProfile,
    _letters,
    _trigram_counts,
    _trigrams,
    detect_language,
    train_profile,
    words_only,
)
from commentloom.operators.rules import FIRST_CANDIDATES, _lengths, _offered, _ranked, _slots, match_rules
from commentloom.operators.scoring import (
    LexiconScorer,
    ModelScorer,
    parallel_map,
    score_sentiment,
)
from commentloom.plans.comments import enrich_comments, enrich_rows
from commentloom.schemas import ENRICHMENT

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def pending(spark):
    """600 comments; one video and the missing video hold a third each, with equal times."""
    rows = []
    for i in range(600):
        video = ["hot", None, f"v{i % 40}"][i % 3]
        rows.append((i, video, START + timedelta(minutes=i // 4)))
    return spark.createDataFrame(rows, "comment_id long, video_id string, published_at timestamp").cache()


def expected_ranks(pending):
    groups = {}
    for r in pending.collect():
        groups.setdefault(r["video_id"], []).append((r["published_at"], r["comment_id"]))
    return {
        key[1]: rank
        for rows in groups.values()
        for rank, key in enumerate(sorted(rows, reverse=True), start=1)
    }


def ranks(df):
    return {r["comment_id"]: r["rank"] for r in df.collect()}


def test_priority_sample(pending):
    want = {i: r for i, r in expected_ranks(pending).items() if r <= 7}
    sample = ranking.priority_sample(pending, 7)
    # Both rankings cut to k ahead of their shuffle and after it.
    assert plan_of(sample).count("WindowGroupLimit") == 4
    assert ranks(sample) == want


@pytest.mark.parametrize("slice_seconds", [60, 3600, 10**9])
def test_priority_rank(pending, slice_seconds):
    ranked = ranking.priority_rank(pending, slice_seconds)
    assert ranked.count() == pending.count()
    assert ranks(ranked) == expected_ranks(pending)


def test_rank_puts_missing_times_last(spark):
    rows = [(1, "v", START), (2, "v", None), (3, "v", START), (4, "v", None)]
    df = spark.createDataFrame(rows, "comment_id long, video_id string, published_at timestamp")
    assert ranks(ranking.priority_rank(df)) == {3: 1, 1: 2, 4: 3, 2: 4}


def test_equal_times_are_settled_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, START, "b"), (1, START, "a"), (1, START, "c")], "k int, t timestamp, v string")
    for parts in (1, 3):
        latest = ranking.dedupe_latest(df.repartition(parts), ["k"], [F.col("t").desc()])
        assert latest.first()["v"] == "a"


def test_enrichment_phase(pending):
    want = {i: 1 if r <= 7 else 2 for i, r in expected_ranks(pending).items()}
    phases = ranking.enrichment_phase(pending, 7)
    assert {r["comment_id"]: r["phase"] for r in phases.collect()} == want


def test_dedupe_latest(spark):
    rows = [(1, 5, "a"), (1, 9, "b"), (2, None, "c"), (None, 1, "d"), (None, 2, "e")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    latest = ranking.dedupe_latest(df, ["k"], [F.col("t").desc()])
    assert plan_of(latest).count("WindowGroupLimit") == 2
    assert {tuple(r) for r in latest.collect()} == {(1, 9, "b"), (2, None, "c"), (None, 2, "e")}


def test_ordered_batch_needs_an_order(pending):
    with pytest.raises(ValueError):
        ranking.ordered_batch(pending, [], 5)
    batch = ranking.ordered_batch(pending, ranking.newest_first(), 5)
    assert [r["comment_id"] for r in batch.collect()] == [599, 598, 597, 596, 595]


def test_upsert_replaces_whole_rows(spark):
    schema = "video_id string, title string, n double"
    target = spark.createDataFrame([("a", "old", 1.0), ("b", "kept", 2.0)], schema)
    source = spark.createDataFrame([("a", None, 5.0), ("c", "new", None)], schema)
    want = {("a", None, 5.0), ("b", "kept", 2.0), ("c", "new", None)}
    once = merging.upsert(target, source)
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in merging.upsert(once, source).collect()} == want


def test_drain_staging(spark):
    staging = spark.createDataFrame([("a", 1), ("b", 2)], "video_id string, n int")
    done = spark.createDataFrame([("a",), ("z",)], "video_id string")
    left = merging.drain_staging(staging, done)
    assert left.columns == ["video_id", "n"]
    assert [tuple(r) for r in left.collect()] == [("b", 2)]


def test_fetch_by_ids_returns_all_rows_of_an_id(spark):
    comments = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "comment_id long, t string")
    ids = spark.createDataFrame([(1,), (1,), (9,)], "comment_id long")
    assert {r["t"] for r in merging.fetch_by_ids(comments, ids).collect()} == {"x", "y"}


def test_apply_enrichment_replaces_matched_rows_only(spark):
    comments = spark.createDataFrame(
        [(1, "Positive", 3), (2, "Negative", 4), (3, None, None)],
        "comment_id long, sentiment string, quality_score int",
    )
    update = spark.createDataFrame([(1, None, True)], "comment_id long, sentiment string, is_spam boolean")
    merged = {r["comment_id"]: r for r in merging.apply_enrichment(comments, update).collect()}
    assert len(merged) == 3
    assert (merged[1]["sentiment"], merged[1]["quality_score"], merged[1]["is_spam"]) == ("N/A", 1, True)
    assert merged[1]["category"] == "Skipped" and merged[1]["language"] == "unknown"
    assert (merged[2]["sentiment"], merged[2]["quality_score"], merged[2]["is_spam"]) == ("Negative", 4, None)
    assert merged[3]["sentiment"] is None


def test_rules_agree_on_both_ways(spark):
    rows = [
        (0, "Where CAN i get it"), (1, None), (2, ""), (3, "ab"), (4, "xxcd"), (5, "cd ab"),
        (6, "SPF"), (7, "it will sting"), (8, "nothing"), (9, "sp"),
    ]
    df = spark.createDataFrame(rows, "comment_id long, text_original string")
    extra = spark.createDataFrame(
        [(0, "Z", "ab"), (9, "Late", "nothing"), (9, "Earlier name", "noth"), (7, "Z", "xxc")],
        "priority int, category string, keyword string",
    )
    rules = rules_table(spark).unionByName(extra)
    ordered = [(r["priority"], r["category"], r["keyword"]) for r in rules.collect()]
    compiled = [(name, [k]) for _, name, k in sorted(ordered)]
    lowered = df.selectExpr("comment_id", "lower(coalesce(text_original, '')) AS t")
    category = lowered.selectExpr("comment_id", f"{first_match('t', compiled)} AS category")
    a = category.selectExpr("*", f"{confidence_of('category')} AS category_confidence")
    b = match_rules(df, rules, ["comment_id"])
    first = {r["comment_id"]: (r["category"], r["category_confidence"]) for r in a.collect()}
    second = {r["comment_id"]: (r["category"], r["category_confidence"]) for r in b.collect()}
    assert first == second
    assert first[3] == ("Z", 0.9) and first[8] == ("Earlier name", 0.9)
    assert first[9] == ("General Feedback", 0.5) and first[0] == ("Product Inquiry", 0.9)
    assert "CartesianProduct" not in plan_of(b) and "BroadcastNestedLoop" not in plan_of(b)


def test_a_short_keyword_leaves_the_anchors_of_others_alone(spark):
    texts = spark.createDataFrame([(i, f"word{i} " * 50) for i in range(40)], "comment_id long, text_original string")
    many = spark.createDataFrame([(1, f"c{i}", f"word{i} ") for i in range(2000)], "priority int, category string, keyword string")
    extra = spark.createDataFrame([(0, "one", "7"), (0, "none", "")], "priority int, category string, keyword string")
    matched = match_rules(texts, many.union(extra), ["comment_id"])
    got = {r["comment_id"]: r["category"] for r in matched.collect()}
    assert got == {i: "one" if "7" in str(i) else f"c{i}" for i in range(40)}
    plan = plan_of(matched)
    # Anchors meet as hashes: no text in that shuffle.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_texts_offer_few_substrings_to_many_rules(spark):
    begun = "b" * 64
    texts = ["alpha beta " * 30, None, "", "ab", "é" + "zeta" * 9, f"{begun}x gamma", f"{begun}y0 gamma", "delta", "\u00c9TA w1999 w7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "beta")], "comment_id long, text_original string")
    # Ten keywords begin like two of the texts, and only one of them is in one.
    rules = [(0, f"long {i}", f"{begun}y{i}") for i in range(10)] + [(5, "five", "zeta"), (5, "Five", "gamma"), (3, "three", "eta"), (9, "nine", "a")]
    rules += [(None, "none", "delta"), (1, "none", ""), (4, "four", "éta")] + [(20 + i, f"w{i}", f"w{i} ") for i in range(2000)]
    table = spark.createDataFrame(rules, "priority int, category string, keyword string").repartition(3)
    got = {r["comment_id"]: r["category"] for r in match_rules(df, table, ["comment_id"]).collect()}

    def first(text):
        hits = [(p is not None, p or 0, c) for p, c, k in rules if k and k in (text or "").lower()]
        return min(hits)[2] if hits else "General Feedback"

    assert got == {None: "three"} | {i: first(t) for i, t in enumerate(texts)}
    assert got[5] == "Five" and got[6] == "long 0" and got[7] == "none"
    # Before, a text sent a row per distinct substring of up to four characters.
    ranked = _ranked(table)
    shared = spark.sparkContext.broadcast((_slots(ranked, ranked.count()), _lengths(ranked)))
    lowered = df.selectExpr("comment_id", "lower(coalesce(text_original, '')) AS _text")
    offered = _offered(lowered, ["comment_id"], shared, FIRST_CANDIDATES)
    assert offered.groupBy("comment_id").count().agg(F.max("count")).first()[0] <= FIRST_CANDIDATES


def test_the_driver_gets_ranks_packed_and_lets_go_of_them(spark, monkeypatch):
    sent = []
    context = type(spark.sparkContext)
    whole = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append((whole(self, value), value)) or sent[-1][0])
    monkeypatch.setattr("commentloom.operators.rules.BROADCAST_RULES", 100)
    rules = [(i % 7, f"c{i % 7}", f"word{i} ") for i in range(3000)] + [(1, "c1", f"twin{i} ") for i in range(3000)]
    table = spark.createDataFrame(rules, "priority int, category string, keyword string").repartition(3)
    df = spark.createDataFrame([(i, f"word{i} twin{i}") for i in range(0, 3000, 100)] + [(-1, None)], "comment_id long, text_original string")
    got = {r["comment_id"]: r["category"] for r in match_rules(df, table, ["comment_id"]).collect()}
    assert got == {-1: "General Feedback"} | {i: f"c{i % 7}" for i in range(0, 3000, 100)}
    # Once a number for each of three slots a keyword: 12 bytes each, and 2 for every slot.
    ((shared, ((size, parts), _)),) = sent
    assert size == 1 << 17 and sum(len(data) for _, data in parts) < size
    with pytest.raises(Exception, match="destroyed"):
        match_rules(df, table, ["comment_id"]).sparkSession.range(1).mapInArrow(lambda it: (shared.value and b for b in it), "id long").collect()


def test_a_mapping_compiles_and_joins_nothing(comments):
    plan = plan_of(match_rules(comments, {"X": ("boom",)}, ["comment_id"]))
    assert "Join" not in plan and "Exchange" not in plan


def test_lexicon_scores_sum_to_one(spark):
    df = spark.createDataFrame(
        [("Great, GREAT and bad",), ("plain",), ("",), (None,)], "text_original string"
    )
    got = [
        None if r["scores"] is None else [round(s["score"], 6) for s in r["scores"]]
        for r in score_sentiment(df, LexiconScorer()).collect()
    ]
    assert got == [[0.333333] * 3, [0.0, 0.0, 1.0], [0.0, 0.0, 1.0], None]


def loud_model():
    # Nested, so that it reaches the workers by value.
    def load():
        def score(texts):
            if any(t is None or "boom" in t for t in texts):
                raise RuntimeError("model failure")
            return [[{"label": "POSITIVE", "score": len(t) / 100}] for t in texts]

        return score

    return load


@pytest.fixture(scope="module")
def comments(spark):
    rows = [
        (1, START, "one two three four five"),
        (2, START, "see https://x.example one two three"),
        (3, START, "this goes boom right here"),
        (4, START, None),
        (5, START, "too short"),
        (6, START, "I love this brand so much"),
        (6, START + timedelta(days=1), "where can i get this one"),
    ]
    return spark.createDataFrame(
        rows, "comment_id long, published_at timestamp, text_original string"
    )


def test_model_scorer_skips_failing_batches(spark, comments):
    scorer = ModelScorer(loud_model(), batch_size=1, on_error="skip")
    got = {r["comment_id"]: r for r in enrich_comments(comments, scorer=scorer).collect()}
    assert got[1]["sentiment"] == "Positive" and got[1]["sentiment_score_positive"] == 0.23
    # Irrelevant and failed rows end alike: triage stays, the rest is defaults.
    for i in (2, 3, 4, 5):
        assert (got[i]["sentiment"], got[i]["category"], got[i]["quality_score"]) == ("N/A", "Skipped", 1)
    assert got[2]["is_spam"] and not got[3]["is_spam"]
    assert got[4]["comment_length"] == 0 and got[4]["language_confidence"] == 0.0


def test_model_scorer_fails_by_default(spark, comments):
    with pytest.raises(Exception, match="model failure"):
        enrich_comments(comments, scorer=ModelScorer(loud_model())).collect()
    with pytest.raises(ValueError):
        ModelScorer(loud_model(), on_error="ignore")


def test_too_few_results_are_an_error(comments):
    def load():
        return lambda texts: [[{"label": "POSITIVE", "score": 1.0}] for _ in texts[1:]]

    with pytest.raises(Exception, match="results for"):
        enrich_comments(comments, scorer=ModelScorer(load)).collect()
    skipped = enrich_comments(comments, scorer=ModelScorer(load, on_error="skip")).collect()
    assert {r["sentiment"] for r in skipped} == {"N/A"}


def test_enrichment_is_one_row_per_id_of_the_newest_comment(comments):
    enriched = enrich_comments(comments)
    assert enriched.columns == ["comment_id", "published_at", *ENRICHMENT.fieldNames()]
    got = {r["comment_id"]: r for r in enriched.collect()}
    assert len(got) == 6
    assert got[6]["category"] == "Product Inquiry"
    assert got[6]["published_at"] == START + timedelta(days=1)
    for r in got.values():
        total = sum(r[f"sentiment_score_{s}"] for s in ("positive", "negative", "neutral"))
        assert total == pytest.approx(0.0 if r["sentiment"] == "N/A" else 1.0)


def test_row_local_enrichment_is_narrow_and_native(comments):
    plan = plan_of(enrich_rows(comments))
    assert "Exchange" not in plan and "Python" not in plan


def test_parallel_map_keeps_rows(spark, pending):
    def double(batches):
        for batch in batches:
            yield batch.assign(comment_id=batch["comment_id"] * 2)[["comment_id"]]

    got = parallel_map(pending, double, "comment_id long", partitions=4, key=["comment_id"])
    assert sorted(r["comment_id"] for r in got.collect()) == [2 * i for i in range(600)]


def test_language_detection(spark, tmp_path):
    corpus = spark.createDataFrame(
        [
            ("the cat and the dog went to the house with them", "en"),
            ("this is what they said when we were there", "en"),
            ("der hund und die katze gehen in das haus mit ihnen", "de"),
            ("das ist was sie sagten als wir dort waren und nicht", "de"),
            ("no label here", None),
        ],
        "text string, lang string",
    )
    profile = train_profile(corpus)
    assert profile.languages == ("de", "en")
    with pytest.raises(ValueError):
        train_profile(corpus, top=0)
    assert train_profile(corpus, top=10**6).languages == ("de", "en")
    texts = spark.createDataFrame(
        [(1, "the house is there"), (2, "das haus und der hund"), (3, None), (4, ""),
         (5, "12 :-) 34"), (6, "日本"), (7, "the house is there")],
        "id int, text string",
    )
    path = str(tmp_path / "profile")
    profile.save(path)
    for p in (profile, LanguageProfile.load(spark, path)):
        got = {r["id"]: r["language"] for r in detect_language(texts, p, "text", ["id"]).collect()}
        assert got == {1: "en", 2: "de", 3: "unknown", 4: "unknown", 5: "unknown", 6: "unknown", 7: "en"}


def test_any_number_of_languages(spark):
    corpus = spark.createDataFrame([(chr(0x4E00 + i) * 9, f"l{i:03d}") for i in range(80)], "text string, lang string")
    profile = train_profile(corpus)
    assert len(profile.languages) == 80
    found = detect_language(corpus, profile, "text", ["lang"])
    assert all(r["lang"] == r["language"] for r in found.collect())


def test_detection_stays_within_the_row(spark, monkeypatch):
    corpus = spark.createDataFrame([(f"word{i} text " * 5, "en") for i in range(50)], "text string, lang string")
    profile = train_profile(corpus)
    plan = plan_of(detect_language(corpus, profile, "text", ["lang"]))
    assert not any(n in plan for n in ("Exchange", "Generate", "Join"))
    monkeypatch.setattr("commentloom.operators.language.SLICE_CHARS", 100)
    assert detect_language(corpus, profile, "text", ["lang"]).where("language = 'en'").count() == 50


def test_language_accuracy_on_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = detect_language(documents, train_profile(documents), "text", ["doc_id", "lang"])
    right = found.agg(F.avg((F.col("lang") == F.col("language")).cast("int")).alias("r")).first()["r"]
    assert right > 0.9


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "k int, v string")
    assert {tuple(r) for r in profiling.null_profile(df).collect()} == {("k", 0), ("v", 2)}
    assert {tuple(r) for r in profiling.column_profile(df).collect()} == {
        ("k", "int", 3), ("v", "string", 1)
    }
    assert tuple(profiling.key_profile(df, ["k"]).first()) == (3, 2, 1)
    observed, seen = profiling.observe_rows(df, "t")
    assert observed.count() == 3 and seen.get["rows_processed"] == 3


def test_grams_are_counted_by_table_and_by_sorting_alike():
    rng = random.Random(3)
    few = ["".join(rng.choice("abc é") for _ in range(400)).strip() for _ in range(30)]
    few = [" ".join(t.split()) for t in few]
    many = ["".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(30)) for _ in range(9)] + ["\U00010400x", "", "y"]
    for texts in (few, many, [""], ["a"]):
        expected = collections.Counter()
        for text in texts:
            for word in text.split():
                expected.update(f" {word} "[i : i + 3] for i in range(len(word)))
        grams, counts = _trigrams(texts)
        assert dict(zip(grams, counts.tolist())) == expected
        at, distinct, which, _ = _letters(texts)
        joined = " " + " ".join(texts) + " "
        assert ["".join(map(chr, distinct[w])) for w in which] == [joined[i - 1 : i + 2] for i in at]
    # A task gives a row for each distinct gram, not for each word of the texts.
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"] * 50), pa.array(["aa bb aa bb"] * 100)], names=["lang", "words"])
    assert sum(b.num_rows for b in _trigram_counts([batch])) == 8


def test_words_keep_lone_blanks_and_lose_other_runs(spark):
    values = ["a b", " a  b ", "a, b", "a ,b", "a,b", "a\tb", " ", "", None, "a b c.", "1a2", "\U00010400 x", "a \u00a0 b", "Ab-C  "]
    assert column(spark, words_only, values) == ["a b", "a b", "a b", "a b", "a b", "a b", "", "", "", "a b c", "a", "\U00010428 x", "a b", "ab c"]
