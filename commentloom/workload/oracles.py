"""The same results as plain SQL for the checking engine."""

from __future__ import annotations

from commentloom.functions.categories import CATEGORY_RULES, FALLBACK_CATEGORY
from commentloom.functions.videos import LANGUAGE_NAMES
from commentloom.operators.language import TOP_GRAMS
from commentloom.operators.scoring import NEGATIVE_TERMS, POSITIVE_TERMS
from commentloom.schemas import COMMENTS, ENRICHMENT, STAGING_VIDEOS
from commentloom.workload import views
from commentloom.workload.queries import SAMPLE

# Unicode whitespace as an RE2 class body.
WS = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

DOCS = views.duck_sql(views.DOCUMENT_COMMENTS)
TALKS = views.duck_sql(views.CONVERSATION_COMMENTS)
RAW = f"comments AS ({DOCS} UNION ALL BY NAME {TALKS})"
STAGING = f"staging AS ({views.duck_sql(views.STAGED_VIDEOS)})"
UPDATES = f"updates AS ({views.duck_sql(views.UPDATED_VIDEOS)})"
DONE = f"done AS ({views.duck_sql(views.ENRICHED_IDS)})"


def when(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


PUBLISHED = when("published_at")


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def words(text: str) -> str:
    return f"CAST(len(regexp_extract_all({text}, '[^{WS}]+')) AS INTEGER)"


def category(lowered: str) -> str:
    branches = []
    for name, keywords in CATEGORY_RULES.items():
        hits = " OR ".join(f"contains({lowered}, '{k}')" for k in keywords)
        branches.append(f"WHEN {hits} THEN '{name}'")
    return f"CASE {' '.join(branches)} ELSE '{FALLBACK_CATEGORY}' END"


def confidence(name: str) -> str:
    return f"CASE WHEN {name} = '{FALLBACK_CATEGORY}' THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END"


def term_count(lowered: str, terms) -> str:
    return " + ".join(f"CAST(contains({lowered}, '{t}') AS INTEGER)" for t in terms)


TRIAGE = f"""
triage AS (
  SELECT *,
    CASE WHEN coalesce(text_original, '') = '' THEN false
      ELSE contains(text_original, 'http://') OR contains(text_original, 'https://')
        OR length({strip('text_original')}) < 3 END AS is_spam,
    coalesce({words('text_original')}, 0)::INTEGER AS word_count,
    coalesce(length(text_original), 0)::INTEGER AS comment_length,
    CASE WHEN coalesce(text_original, '') = '' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END
      AS language_confidence
  FROM comments),
flagged AS (SELECT *, NOT is_spam AND word_count > 3 AS is_relevant FROM triage)
"""

COUNTED = f"""
counted AS (
  SELECT *, {term_count('lower(text_original)', POSITIVE_TERMS)} AS p,
    {term_count('lower(text_original)', NEGATIVE_TERMS)} AS n
  FROM {{source}}),
shares AS (
  SELECT *, p::DOUBLE / (p + n + 1) AS pos, n::DOUBLE / (p + n + 1) AS neg,
    1.0::DOUBLE / (p + n + 1) AS neu
  FROM counted),
labelled AS (
  SELECT *, CASE WHEN p IS NULL THEN NULL WHEN pos >= neg AND pos >= neu THEN 'Positive'
    WHEN neg >= neu THEN 'Negative' ELSE 'Neutral' END AS top_label
  FROM shares)
"""

# Enrichment of every comment row, before copies of an id are merged.
ROWS = f"""
{RAW}, {TRIAGE}, {COUNTED.format(source='flagged')},
categorised AS (SELECT *, {category('lower(text_original)')} AS cat FROM labelled),
enriched_rows AS (
  SELECT comment_id, published_at, channel_id, video_id, text_original,
    CASE WHEN is_relevant THEN top_label ELSE 'N/A' END AS sentiment,
    CASE WHEN is_relevant THEN pos ELSE 0.0::DOUBLE END AS sentiment_score_positive,
    CASE WHEN is_relevant THEN neg ELSE 0.0::DOUBLE END AS sentiment_score_negative,
    CASE WHEN is_relevant THEN neu ELSE 0.0::DOUBLE END AS sentiment_score_neutral,
    CASE WHEN is_relevant THEN cat ELSE 'Skipped' END AS category,
    CASE WHEN is_relevant THEN {confidence('cat')} ELSE 0.0::DOUBLE END AS category_confidence,
    CASE WHEN is_relevant THEN least(5, greatest(1, word_count // 10)) ELSE 1 END::INTEGER
      AS quality_score,
    is_spam, 'unknown' AS language, language_confidence, comment_length
  FROM categorised),
newest AS (
  SELECT * FROM enriched_rows
  QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY published_at DESC) = 1)
"""

NAMES = ENRICHMENT.fieldNames()


def shown(prefix: str = "", replaced: dict[str, str] | None = None) -> str:
    parts = []
    for name in NAMES:
        source = (replaced or {}).get(name, prefix + name)
        if name.startswith("sentiment_score"):
            source = f"round({source}, 6)"
        parts.append(f"{source} AS {name}")
    return ", ".join(parts)


def grams(relation: str, key: str, text: str, name: str) -> str:
    """Counts of the grams around each letter: alone, with its left, with both neighbours."""
    words = f"trim(regexp_replace(lower(coalesce({text}, '')), '[^\\p{{L}}]+', ' ', 'g'))"
    return f"""
{name}_chars AS (
  SELECT {key}, regexp_extract_all(' ' || {words} || ' ', '.') AS ch FROM {relation}),
{name}_places AS (
  SELECT {key},
    unnest([ch[i-1] || ch[i] || ch[i+1] for i in range(2, len(ch)) if ch[i] <> ' ']) AS g
  FROM {name}_chars),
{name}_longest AS (SELECT {key}, g, count(*) AS n FROM {name}_places GROUP BY ALL),
{name} AS (
  SELECT {key}, gram, sum(n) AS n FROM (
    SELECT {key}, unnest([g, g[1:2], g[2:2]]) AS gram, n FROM {name}_longest)
  GROUP BY ALL)
"""


PROFILE = f"""
{grams('documents', 'lang', 'text', 'lang_grams')},
vocabulary AS (
  SELECT DISTINCT gram FROM (
    SELECT gram FROM lang_grams
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) <= {TOP_GRAMS})),
langs AS (SELECT DISTINCT lang FROM lang_grams),
cells AS (
  SELECT l.lang, v.gram, coalesce(g.n, 0) AS n
  FROM vocabulary v CROSS JOIN langs l LEFT JOIN lang_grams g ON g.lang = l.lang AND g.gram = v.gram),
weights AS (
  SELECT lang, gram, CAST(floor(ln((n + 1)::DOUBLE / (sum(n) OVER (PARTITION BY lang)
    + count(*) OVER (PARTITION BY lang))::DOUBLE) * 1e6 + 0.5) AS BIGINT) AS w
  FROM cells)
"""


def detect(relation: str, key: str, text: str) -> str:
    return f"""
{PROFILE}, {grams(relation, key, text, 'text_grams')},
totals AS (
  SELECT {key}, lang, sum(t.n * w) AS total
  FROM text_grams t JOIN weights USING (gram) GROUP BY ALL),
detected AS (
  SELECT {key}, lang AS language FROM totals
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY total DESC, lang) = 1)
"""


ENRICHED = f"""
WITH {ROWS}, {detect('newest', 'comment_id', 'text_original')}
SELECT comment_id, {PUBLISHED}, {shown('', {'language': "coalesce(d.language, 'unknown')"})}
FROM newest LEFT JOIN detected d USING (comment_id)
"""

DURATION = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?"


def seconds(iso: str) -> str:
    parts = [
        f"coalesce(try_cast(nullif(regexp_extract({iso}, '{DURATION}', {i}), '') AS BIGINT), 0) * {u}"
        for i, u in enumerate((86400, 3600, 60, 1), start=1)
    ]
    return f"CASE WHEN starts_with({iso}, 'P') THEN {' + '.join(parts)} END"


def lang_code(column: str) -> str:
    return f"CASE WHEN {column} <> '' THEN lower(split_part({column}, '-', 1)) END"


CODE = f"coalesce({lang_code('default_language')}, {lang_code('default_audio_language')})"
LANGUAGE = (
    f"CASE {CODE} "
    + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in LANGUAGE_NAMES.items())
    + f" ELSE coalesce({CODE}, 'Unknown') END"
)
QUOTED = """'[^'']*''|"[^"]*"'"""
TOPIC_LIST = f"""CASE WHEN trim(topic_categories) LIKE '[%]'
  THEN [replace(split_part(trim(u, '''"'), '/', -1), '_', ' ')
        for u in regexp_extract_all(topic_categories, '''{QUOTED[1:]})]
  ELSE [] END"""
DESCRIPTION = strip(r"regexp_replace(coalesce(description, ''), '#[\p{L}\p{N}_]+', '', 'g')")


def clean(relation: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT video_id, published_at, channel_id, title, {DESCRIPTION} AS description, tags,
    {LANGUAGE} AS language_name, CAST({seconds('content_duration')} AS INTEGER) AS duration_seconds,
    view_count, like_count, favourite_count, comment_count,
    array_to_string({TOPIC_LIST}, '|') AS topic_categories
  FROM {relation})
"""


VIDEO = (
    f"video_id, {PUBLISHED}, channel_id, title, description, tags, language_name, "
    "duration_seconds, view_count, like_count, favourite_count, comment_count, topic_categories"
)
KEYS = f"comment_id, {PUBLISHED}"
PENDING = f"{RAW}, {DONE}, pending AS (SELECT * FROM comments ANTI JOIN done USING (comment_id))"


def sampled(relation: str, k: int) -> str:
    return f"""
ranked AS (
  SELECT comment_id, video_id, published_at, CAST(row_number() OVER (
    PARTITION BY video_id ORDER BY published_at DESC, comment_id DESC) AS INTEGER) AS rank
  FROM {relation}),
sample AS (SELECT * FROM ranked WHERE rank <= {k})
"""


UPSERTED = f"""
WITH {STAGING}, {UPDATES}, {clean('staging', 'target')}, {clean('updates', 'source')},
merged AS (SELECT * FROM target ANTI JOIN source USING (video_id) UNION ALL SELECT * FROM source)
SELECT {VIDEO} FROM merged
"""

RANKED = f"""WITH {RAW}, {sampled('comments', SAMPLE)}
SELECT {KEYS}, video_id, CAST(rank AS BIGINT) AS rank FROM ranked"""

MEANS = ", ".join(
    f"round(avg(sentiment_score_{s}), 6) AS mean_{s}" for s in ("positive", "negative", "neutral")
)
TREND = f"""
WITH {ROWS}, days AS (SELECT *, date_trunc('day', published_at)::TIMESTAMP AS bucket FROM enriched_rows)
SELECT {when('bucket')}, sentiment, count(*) AS comments, {MEANS},
  round(count(*) / sum(count(*)) OVER (PARTITION BY days.bucket), 6) AS share
FROM days GROUP BY days.bucket, sentiment
"""


def breakdown(dims: str) -> str:
    head = f"{dims}, " if dims else ""
    part = f"PARTITION BY {dims}" if dims else ""
    return f"""
WITH {ROWS}
SELECT {head}category, sentiment, count(*) AS comments,
  round(avg(category_confidence), 6) AS mean_confidence, round(avg(quality_score), 6) AS mean_quality,
  round(count(*) / sum(count(*)) OVER ({part}), 6) AS share
FROM enriched_rows GROUP BY {head}category, sentiment
"""


MIX = """count(*) AS comments, count(*) FILTER (sentiment = 'Positive') AS positive,
  count(*) FILTER (sentiment = 'Negative') AS negative,
  count(*) FILTER (sentiment = 'Neutral') AS neutral,
  round(avg(sentiment_score_positive - sentiment_score_negative), 6) AS net_score"""


def profile(relation: str, columns, count: str, name: str, extra=lambda c: "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name{extra(c)}, {count.format(c)} AS {name} FROM {relation}"
        for c in columns
    )


CLEAN_TYPES = {
    "video_id": "string", "published_at": "timestamp", "channel_id": "string", "title": "string",
    "description": "string", "tags": "string", "language_name": "string",
    "duration_seconds": "int", "view_count": "double", "like_count": "double",
    "favourite_count": "double", "comment_count": "double", "topic_categories": "array<string>",
}

RAW_VIDEO = ", ".join(
    PUBLISHED if c == "published_at" else c for c in STAGING_VIDEOS.fieldNames()
)
NULLS = "count(*) - count({})"
ABSENT = [c for c in COMMENTS.fieldNames() if c in NAMES]

SCORED = f"WITH {RAW}, {COUNTED.format(source='comments')}"
CATEGORY = f"""
WITH {RAW}, c AS (
  SELECT *, {category("lower(coalesce(text_original, ''))")} AS category FROM comments)
SELECT {KEYS}, category, {confidence('category')} AS category_confidence FROM c
"""
ORPHANS = f"""
WITH {RAW}, {STAGING}, {clean('staging', 'videos')}
"""

LOADED = f"""WITH {RAW} SELECT kind, {KEYS}, channel_id, video_id, author_id,
        text_original, parent_comment_id, like_count, CAST(NULL AS VARCHAR) AS sentiment,
        CAST(NULL AS INTEGER) AS comment_length FROM comments"""

ORACLES: dict[str, str] = {
    "comment_triage": f"""WITH {RAW}, {TRIAGE}
        SELECT {KEYS}, is_spam, is_relevant, word_count, comment_length, language_confidence
        FROM flagged""",
    "comment_category": CATEGORY,
    "rules_compiled": CATEGORY,
    "rules_join": CATEGORY,
    # A text has a rule of n letters exactly if one of the documents' words is inside it; each run of letters
    # is cut into its substrings and looked up.
    "rules_join_many": f"""WITH {RAW},
        rules AS (SELECT DISTINCT w, length(w) AS n FROM (
          SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{5,}}')) AS w FROM documents)),
        runs AS (SELECT DISTINCT run FROM (
          SELECT unnest(regexp_extract_all(lower(coalesce(text_original, '')), '[a-z]{{5,}}')) AS run FROM comments)),
        parts AS (SELECT run, unnest(flatten([[run[i:i + n - 1] for i in range(1, length(run) - n + 2)]
          for n in range(5, length(run) + 1)])) AS part FROM runs),
        best AS (SELECT run, min(n) AS n FROM parts JOIN rules ON part = w GROUP BY run),
        met AS (SELECT comment_id, published_at, min(n) AS n FROM (
            SELECT comment_id, published_at,
              unnest(regexp_extract_all(lower(coalesce(text_original, '')), '[a-z]{{5,}}')) AS run FROM comments)
          JOIN best USING (run) GROUP BY ALL),
        named AS (SELECT c.comment_id, c.published_at, CASE WHEN n IS NOT NULL THEN 'length ' || n
            WHEN contains(lower(coalesce(text_original, '')), 'e') THEN 'one letter'
            ELSE '{FALLBACK_CATEGORY}' END AS category
          FROM comments c LEFT JOIN met m ON c.comment_id = m.comment_id AND c.published_at = m.published_at)
        SELECT comment_id, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, category,
          {confidence('category')} AS category_confidence FROM named""",
    "sentiment_scores": f"""{SCORED} SELECT {KEYS},
        coalesce(round(pos, 6)) AS sentiment_score_positive,
        round(neg, 6) AS sentiment_score_negative, round(neu, 6) AS sentiment_score_neutral
        FROM labelled""",
    "dominant_sentiments": f"{SCORED} SELECT {KEYS}, top_label AS sentiment FROM labelled",
    "model_scores": f"""WITH {ROWS} SELECT {KEYS},
        nullif(sentiment, 'N/A') AS sentiment,
        CASE WHEN sentiment <> 'N/A' THEN round(sentiment_score_positive, 6) END
          AS sentiment_score_positive,
        CASE WHEN sentiment <> 'N/A' THEN round(sentiment_score_negative, 6) END
          AS sentiment_score_negative,
        CASE WHEN sentiment <> 'N/A' THEN round(sentiment_score_neutral, 6) END
          AS sentiment_score_neutral
        FROM enriched_rows""",
    "parallel_lengths": f"""WITH {RAW} SELECT {KEYS},
        coalesce(length(text_original), 0)::INTEGER AS code_points,
        coalesce(length(nfc_normalize(text_original)), 0)::INTEGER AS composed_code_points
        FROM comments""",
    "scorer_failures": f"""WITH {ROWS}, f AS (
          SELECT *, sentiment <> 'N/A' AND NOT contains(text_original, 'blend') AS ok FROM enriched_rows)
        SELECT {KEYS}, CASE WHEN ok THEN sentiment ELSE 'N/A' END AS sentiment,
          CASE WHEN ok THEN round(sentiment_score_positive, 6) ELSE 0 END AS sentiment_score_positive,
          CASE WHEN ok THEN round(sentiment_score_negative, 6) ELSE 0 END AS sentiment_score_negative,
          CASE WHEN ok THEN round(sentiment_score_neutral, 6) ELSE 0 END AS sentiment_score_neutral,
          CASE WHEN ok THEN category ELSE 'Skipped' END AS category,
          CASE WHEN ok THEN quality_score ELSE 1 END AS quality_score
        FROM f""",
    "comments_enriched": ENRICHED,
    "triage_score_merge": f"WITH {ROWS} SELECT {KEYS}, {shown()} FROM newest",
    "language_id": f"""WITH {detect('documents', 'doc_id', 'text')}
        SELECT doc_id, coalesce(language, 'unknown') AS language
        FROM documents LEFT JOIN detected USING (doc_id)""",
    "pending_comments": f"WITH {PENDING} SELECT {KEYS}, video_id FROM pending",
    "still_pending": f"WITH {PENDING} SELECT {KEYS}, video_id FROM pending",
    "priority_sample": f"""WITH {PENDING}, {sampled('pending', SAMPLE)}
        SELECT {KEYS}, video_id, rank FROM sample""",
    "priority_rank": RANKED,
    "priority_rank_ranges": RANKED,
    "enrichment_phase": f"""WITH {RAW}, {sampled('comments', SAMPLE)}
        SELECT {KEYS}, video_id, CAST(CASE WHEN rank <= {SAMPLE} THEN 1 ELSE 2 END AS INTEGER)
          AS phase FROM ranked""",
    "fetch_by_ids": f"""WITH {RAW}, {sampled('comments', SAMPLE)}
        SELECT {KEYS}, video_id, author_id, text_original
        FROM comments SEMI JOIN sample USING (comment_id)""",
    "newest_batch": f"""WITH {RAW} SELECT {KEYS}, video_id FROM comments
        ORDER BY comments.published_at DESC, comment_id DESC LIMIT 1000""",
    "latest_per_id": f"""WITH {RAW} SELECT {KEYS}, video_id, author_id FROM comments
        QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY comments.published_at DESC) = 1""",
    "videos_clean": f"WITH {STAGING}, {clean('staging', 'videos')} SELECT {VIDEO} FROM videos",
    "videos_clean_script": f"""WITH {STAGING}, {clean('staging', 'videos')}
        SELECT video_id, strftime(v.published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
          v.channel_id, v.title, coalesce(s.description, '') AS description,
          coalesce(s.tags, '') AS tags, language_name, duration_seconds,
          trunc(coalesce(v.view_count, 0))::BIGINT AS view_count,
          trunc(coalesce(v.like_count, 0))::BIGINT AS like_count,
          trunc(coalesce(v.favourite_count, 0))::BIGINT AS favourite_count,
          trunc(coalesce(v.comment_count, 0))::BIGINT AS comment_count, v.topic_categories,
          round_even(duration_seconds / 60, 2)::DOUBLE AS duration_minutes,
          round_even(duration_seconds / 3600, 2)::DOUBLE AS duration_hours
        FROM videos v JOIN staging s USING (video_id)""",
    "video_durations": f"""WITH {STAGING}, d AS (
          SELECT video_id, CAST({seconds('content_duration')} AS BIGINT) AS duration_seconds
          FROM staging)
        SELECT *, round_even(duration_seconds / 60, 2)::DOUBLE AS duration_minutes,
          round_even(duration_seconds / 3600, 2)::DOUBLE AS duration_hours FROM d""",
    "video_languages": f"""WITH {STAGING}
        SELECT video_id, {CODE} AS language_code, {LANGUAGE} AS language_name FROM staging""",
    "video_topics": f"""WITH {STAGING}, t AS (SELECT video_id, {TOPIC_LIST} AS topics FROM staging)
        SELECT video_id, len(topics)::INTEGER AS n_topics, array_to_string(topics, '|') AS topics
        FROM t""",
    "filled_counts": f"""WITH {STAGING} SELECT video_id,
        trunc(coalesce(view_count, 0))::BIGINT AS view_count,
        CASE WHEN like_count % 7 = 0 THEN 0 ELSE trunc(coalesce(like_count, 0)) END::BIGINT AS like_count,
        trunc(coalesce(favourite_count, 0))::BIGINT AS favourite_count,
        trunc(coalesce(comment_count, 0))::BIGINT AS comment_count FROM staging""",
    "apply_enrichment": f"""WITH {ROWS}
        SELECT c.comment_id, strftime(c.published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
          c.video_id, {shown('n.')}
        FROM comments c JOIN newest n USING (comment_id)""",
    "upsert_videos": UPSERTED,
    "drain_staging": f"""WITH {STAGING}, {UPDATES}
        SELECT video_id, title, content_duration FROM staging ANTI JOIN updates USING (video_id)""",
    "null_profile": f"WITH {STAGING} "
    + profile("staging", STAGING_VIDEOS.fieldNames(), NULLS, "null_count"),
    "key_profile": f"""WITH {RAW}, k AS (SELECT comment_id, count(*) AS n FROM comments GROUP BY ALL)
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,
          count(*) FILTER (n > 1) AS duplicated_keys FROM k""",
    "column_profile": f"WITH {STAGING}, {clean('staging', 'videos')} "
    + profile(
        "videos", CLEAN_TYPES, "count({})", "non_null_count",
        lambda c: f", '{CLEAN_TYPES[c]}' AS data_type",
    ),
    "run_metrics": f"WITH {STAGING} SELECT count(*) AS rows_processed FROM staging",
    "category_breakdown_mart": breakdown(""),
    "category_by_channel": breakdown("channel_id"),
    "sentiment_trend_mart": TREND,
    "published_trend": TREND,
    "incremental_trend": TREND,
    "key_sketches": f"""WITH {RAW} SELECT count(*) AS total_rows, count(DISTINCT comment_id) AS distinct_keys,
        true AS within_error FROM comments""",
    "channel_comparison": f"WITH {ROWS} SELECT channel_id, {MIX} FROM enriched_rows GROUP BY channel_id",
    "comments_with_videos_mart": f"""{ORPHANS}
        SELECT comment_id, strftime(c.published_at, '%Y-%m-%d %H:%M:%S') AS published_at, video_id,
          c.like_count, v.channel_id AS video_channel_id, language_name AS video_language_name,
          v.topic_categories AS video_topic_categories
        FROM comments c LEFT JOIN videos v USING (video_id)""",
    "video_language_comparison": f"""WITH {ROWS}, {STAGING}, {clean('staging', 'videos')}
        SELECT language_name AS video_language_name, {MIX}
        FROM enriched_rows LEFT JOIN videos USING (video_id) GROUP BY language_name""",
    "csv_videos": f"WITH {STAGING} SELECT {RAW_VIDEO} FROM staging",
    "csv_videos_camel": f"""WITH {STAGING}
        SELECT {RAW_VIDEO.removeprefix('kind, ')} FROM staging""",
    "csv_comments": LOADED,
    "csv_comments_split": LOADED,
    "csv_flat_export": f"""SELECT * REPLACE (translate(text_original, chr(13) || chr(10), '  ') AS text_original)
        FROM ({LOADED})""",
    "time_partitioned_scan": f"""WITH {RAW} SELECT {KEYS}, video_id, text_original FROM comments
        WHERE comments.published_at >= TIMESTAMP '2024-01-08'
          AND comments.published_at < TIMESTAMP '2024-01-15'""",
    "schema_evolution": f"WITH {RAW} "
    + profile("comments", [c for c in COMMENTS.fieldNames() if c not in NAMES], NULLS, "null_count")
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS null_count FROM comments" for c in ABSENT
    ),
    "stream_enrich": ENRICHED,
    "stream_upsert": UPSERTED,
    "stream_sample": f"WITH {RAW}, {sampled('comments', SAMPLE)} SELECT {KEYS}, video_id, rank FROM sample",
    "cleaning_run": UPSERTED,
    "compacted_videos": UPSERTED,
    "compacted_comments": f"WITH {ROWS} SELECT {KEYS}, {shown()} FROM newest",
    "stream_metrics": f"""WITH {RAW}, sizes AS (SELECT (SELECT count(*) FROM conversations) AS turns)
        SELECT 0 AS delivery, count(*) - (SELECT turns FROM sizes) AS rows_processed FROM comments
        UNION ALL SELECT 1, turns FROM sizes""",
    "declared_tables": f"WITH {STAGING}, {clean('staging', 'videos')} SELECT {VIDEO} FROM videos",
    "enrichment_run": f"""WITH {ROWS}
        SELECT c.comment_id, strftime(c.published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
          c.video_id, {shown('n.')}
        FROM comments c JOIN newest n USING (comment_id)""",
    "stream_two_deliveries": f"WITH {ROWS} SELECT {KEYS}, {shown()} FROM newest",
    # A day is emitted once the newest comment is two days past its end.
    "stream_trend_append": f"""WITH {ROWS}, days AS (
          SELECT *, date_trunc('day', published_at)::TIMESTAMP AS bucket FROM enriched_rows)
        SELECT {when('bucket')}, sentiment, count(*) AS comments, {MEANS}
        FROM days WHERE days.bucket + INTERVAL 3 DAY <= (SELECT max(published_at) FROM days)
        GROUP BY days.bucket, sentiment""",
    "stream_trend": f"""WITH {ROWS}, days AS (
          SELECT *, date_trunc('day', published_at)::TIMESTAMP AS bucket FROM enriched_rows)
        SELECT {when('bucket')}, sentiment, count(*) AS comments, {MEANS}
        FROM days GROUP BY days.bucket, sentiment""",
}
