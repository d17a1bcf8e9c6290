"""The queries that the driver runs: one or more per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.functions.categories import (
    CATEGORY_RULES,
    confidence_of,
    keyword_category,
    rules_table,
)
from commentloom.functions.sentiment import SCORE_COLUMNS, dominant_sentiment, spread_scores
from commentloom.functions.videos import (
    duration_in,
    fill_count,
    language_name,
    parse_duration,
    resolve_lang,
    topic_names,
)
from commentloom.operators import merging, profiling, ranking
from commentloom.operators.language import detect_language, train_profile
from commentloom.operators.rules import match_rules
from commentloom.operators.scoring import (
    NEGATIVE_TERMS,
    POSITIVE_TERMS,
    LexiconScorer,
    ModelScorer,
    parallel_map,
    score_sentiment,
)
from commentloom.plans.comments import KEY, enrich_comments, enrich_rows, triage_comments
from commentloom.plans.marts import (
    TREND_PARTS,
    add_to_trend,
    category_breakdown,
    comments_with_videos,
    group_comparison,
    sentiment_trend,
    trend_of_parts,
)
from commentloom.plans.runs import run_cleaning, run_enrichment
from commentloom.plans.videos import COUNTS, clean_videos
from commentloom.schemas import CAMEL_VIDEO_COLUMNS, COMMENTS, ENRICHMENT, STAGING_VIDEOS
from commentloom.session import scratch_path
from commentloom.sources import csv as csv_source
from commentloom.sources import tables
from commentloom.streaming import drains
from commentloom.workload.views import Views

SAMPLE = 5

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, folder: fn(Views(spark, folder))
    return fn


def stamp(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that no client time zone enters the comparison."""
    shown = columns or ("published_at",)
    return df.withColumns({c: F.expr(f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')") for c in shown})


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.expr(f"round({c}, 6)") for c in columns})


def show_videos(df: DataFrame) -> DataFrame:
    """Topics as one text; arrays are not comparable across clients."""
    return stamp(df.withColumn("topic_categories", F.array_join("topic_categories", "|")))


def show_enriched(df: DataFrame) -> DataFrame:
    return rounded(stamp(df), *SCORE_COLUMNS)


# --- comments ---------------------------------------------------------------------------------


@query
def comment_triage(v: Views) -> DataFrame:
    return stamp(triage_comments(v.comments()).drop("text_original"))


@query
def comment_category(v: Views) -> DataFrame:
    picked = v.comments().selectExpr(*KEY, f"{keyword_category('text_original')} AS category")
    return stamp(picked.selectExpr("*", f"{confidence_of('category')} AS category_confidence"))


@query
def rules_compiled(v: Views) -> DataFrame:
    return stamp(match_rules(v.comments(), CATEGORY_RULES, list(KEY)))


@query
def rules_join(v: Views) -> DataFrame:
    """Rules as a table."""
    return stamp(match_rules(v.comments(), rules_table(v.spark), list(KEY)))


@query
def rules_join_many(v: Views) -> DataFrame:
    """Every distinct word of the documents as a rule, the fewest letters first, and one letter as the last.

    Each rule is a category of its own by its length.
    """
    words = v.documents().select(F.explode(F.expr("regexp_extract_all(lower(text), '[a-z]{5,}', 0)")).alias("keyword"))
    rules = words.distinct().selectExpr(
        "length(keyword) AS priority", "concat('length ', length(keyword)) AS category", "keyword"
    )
    one = v.spark.sql("SELECT 1000 AS priority, 'one letter' AS category, 'e' AS keyword")
    return stamp(match_rules(v.comments(), rules.union(one), list(KEY)))


@query
def sentiment_scores(v: Views) -> DataFrame:
    scored = score_sentiment(v.comments(), LexiconScorer()).select(*KEY, "scores")
    return rounded(stamp(scored.selectExpr(*KEY, *spread_scores("scores"))), *SCORE_COLUMNS)


@query
def dominant_sentiments(v: Views) -> DataFrame:
    scored = score_sentiment(v.comments(), LexiconScorer()).select(*KEY, "scores")
    return stamp(scored.selectExpr(*KEY, f"{dominant_sentiment('scores')} AS sentiment"))


def _lexicon_model():
    """A stand-in for a caller's model: the same lexicon as a plain Python function.

    Nested functions travel to the workers by value, so these need no import of this package.
    """
    positive, negative = POSITIVE_TERMS, NEGATIVE_TERMS

    def load():
        def score(texts):
            results = []
            for text in texts:
                lowered = text.lower()
                p = sum(term in lowered for term in positive)
                n = sum(term in lowered for term in negative)
                shares = {"POSITIVE": p, "negative": n, "Neutral": 1}
                results.append(
                    [{"label": k, "score": v / (p + n + 1)} for k, v in shares.items()]
                )
            return results

        return score

    return load


@query
def model_scores(v: Views) -> DataFrame:
    """A Python model through Arrow; relevant comments only, like the enrichment."""
    rows = enrich_rows(v.comments(), ModelScorer(_lexicon_model()))
    return show_enriched(rows.select(*KEY, "sentiment", *SCORE_COLUMNS))


def _failing_model():
    """The stand-in model, which breaks down on texts that speak of blending."""
    load_lexicon = _lexicon_model()

    def load():
        score = load_lexicon()

        def fragile(texts):
            if any("blend" in t for t in texts):
                raise RuntimeError("cannot score this batch")
            return score(texts)

        return fragile

    return load


@query
def scorer_failures(v: Views) -> DataFrame:
    """Rows of failing batches get the defaults; a batch is one text here, so which rows is known."""
    scorer = ModelScorer(_failing_model(), batch_size=1, on_error="skip")
    rows = merging.with_skip_defaults(enrich_rows(v.comments(), scorer).drop("text_original"))
    return show_enriched(rows.select(*KEY, "sentiment", *SCORE_COLUMNS, "category", "quality_score"))


@query
def parallel_lengths(v: Views) -> DataFrame:
    """A Python function over Arrow batches, each row with its own id: lengths in composed form."""

    def measure(batches):
        for batch in batches:
            out = batch[["comment_id", "published_at"]].copy()
            texts = batch["text_original"].fillna("")
            out["code_points"] = texts.str.len().astype("int32")
            out["composed_code_points"] = texts.str.normalize("NFC").str.len().astype("int32")
            yield out

    schema = "comment_id long, published_at timestamp, code_points int, composed_code_points int"
    texts = v.comments().select(*KEY, "text_original")
    return stamp(parallel_map(texts, measure, schema))


@query
def comments_enriched(v: Views) -> DataFrame:
    profile = train_profile(v.documents())
    return show_enriched(enrich_comments(v.comments(), profile))


@query
def triage_score_merge(v: Views) -> DataFrame:
    """Triage and scores as two tables, merged per id with the defaults filled in."""
    # Both tables come from one pass over the texts.
    newest = tables.stored(merging.with_skip_defaults(_newest_rows(v)), "newest")
    triage = newest.select(
        *KEY, "is_spam", "comment_length", "language_confidence"
    )
    scored = newest.where(F.col("sentiment") != "N/A").select(
        "comment_id",
        *[c for c in ENRICHMENT.fieldNames() if c.startswith(("sentiment", "category", "quality"))],
    )
    merged = merging.merge_triage_and_scores(triage, scored)
    return show_enriched(merged.select(*KEY, *ENRICHMENT.fieldNames()))


def _newest_rows(v: Views) -> DataFrame:
    rows = enrich_rows(v.comments()).drop("text_original")
    return ranking.dedupe_latest(rows, ["comment_id"], [F.col("published_at").desc()])


@query
def language_id(v: Views) -> DataFrame:
    documents = v.documents()
    return detect_language(documents, train_profile(documents), "text", ["doc_id"])


# --- which comments next ----------------------------------------------------------------------


@query
def pending_comments(v: Views) -> DataFrame:
    pending = merging.pending_comments(v.comment_keys(), v.enriched_ids())
    return stamp(pending.select(*KEY, "video_id"))


@query
def still_pending(v: Views) -> DataFrame:
    """The same on the merged table, by NULL sentiment."""
    done = v.enriched_ids().withColumn("sentiment", F.lit("N/A"))
    merged = merging.apply_enrichment(v.comment_keys(), done)
    return stamp(merging.still_pending(merged).select(*KEY, "video_id"))


@query
def priority_sample(v: Views) -> DataFrame:
    pending = merging.pending_comments(v.comment_keys(), v.enriched_ids())
    return stamp(ranking.priority_sample(pending, SAMPLE))


@query
def priority_rank(v: Views) -> DataFrame:
    return stamp(ranking.priority_rank(v.comment_keys()))


@query
def priority_rank_ranges(v: Views) -> DataFrame:
    """The same from narrow time slices."""
    return stamp(ranking.priority_rank(v.comment_keys(), slice_seconds=60))


@query
def enrichment_phase(v: Views) -> DataFrame:
    return stamp(ranking.enrichment_phase(v.comment_keys(), SAMPLE))


@query
def fetch_by_ids(v: Views) -> DataFrame:
    """Whole comments for the sampled ids, with all rows of a shared id."""
    sample = ranking.priority_sample(v.comment_keys(), SAMPLE)
    fetched = merging.fetch_by_ids(v.comment_keys(), sample)
    return stamp(fetched.select(*KEY, "video_id", "author_id", "text_original"))


@query
def newest_batch(v: Views) -> DataFrame:
    batch = ranking.ordered_batch(v.comment_keys(), ranking.newest_first(), 1000)
    return stamp(batch.select(*KEY, "video_id"))


@query
def latest_per_id(v: Views) -> DataFrame:
    latest = ranking.dedupe_latest(
        v.comment_keys(), ["comment_id"], [F.col("published_at").desc()]
    )
    return stamp(latest.select(*KEY, "video_id", "author_id"))


# --- videos -----------------------------------------------------------------------------------


@query
def videos_clean(v: Views) -> DataFrame:
    return show_videos(clean_videos(tables.scan_staging(v.staging())))


@query
def videos_clean_script(v: Views) -> DataFrame:
    """The variant of the standalone script: filled texts and counts, longer time units."""
    cleaned = clean_videos(
        v.staging(), strip_tags=False, fill_tags=True, whole_counts=True, longer_units=True
    )
    return show_videos(cleaned)


@query
def video_durations(v: Views) -> DataFrame:
    seconds = v.staging().selectExpr(
        "video_id", f"{parse_duration('content_duration')} AS duration_seconds"
    )
    return seconds.selectExpr(
        "*",
        f"{duration_in('duration_seconds', 60)} AS duration_minutes",
        f"{duration_in('duration_seconds', 3600)} AS duration_hours",
    )


@query
def video_languages(v: Views) -> DataFrame:
    code = resolve_lang("default_language", "default_audio_language")
    resolved = v.staging().selectExpr("video_id", f"{code} AS language_code")
    return resolved.selectExpr("*", f"{language_name('language_code')} AS language_name")


@query
def video_topics(v: Views) -> DataFrame:
    topics = v.staging().selectExpr("video_id", f"{topic_names('topic_categories')} AS topics")
    return topics.selectExpr(
        "video_id", "size(topics) AS n_topics", "array_join(topics, '|') AS topics"
    )


@query
def filled_counts(v: Views) -> DataFrame:
    """Counts with NULL and NaN among them."""
    counts = v.staging().withColumn(
        "like_count", F.expr("if(like_count % 7 = 0, double('NaN'), like_count)")
    )
    return counts.selectExpr("video_id", *[f"{fill_count(c)} AS {c}" for c in COUNTS])


# --- updates ----------------------------------------------------------------------------------


@query
def apply_enrichment(v: Views) -> DataFrame:
    """All comment rows, those of an enriched id with its 11 columns."""
    enriched = enrich_comments(v.comments())
    merged = merging.apply_enrichment(v.comment_keys(), enriched)
    return show_enriched(merged.select(*KEY, "video_id", *ENRICHMENT.fieldNames()))


@query
def upsert_videos(v: Views) -> DataFrame:
    return show_videos(merging.upsert(clean_videos(v.staging()), clean_videos(v.updates())))


def _database(v: Views, label: str) -> str:
    """A fresh database below the shared folder, with the declared tables."""
    root = scratch_path(v.spark, label)
    database = "loom_" + root.rsplit("-", 1)[1]
    v.spark.sql(f"CREATE DATABASE {database} LOCATION '{root}'")
    tables.declare_tables(v.spark, database, root)
    return database


@query
def enrichment_run(v: Views) -> DataFrame:
    """A declared comments table after a run in two phases: sample first, then the rest."""
    comments = f"{_database(v, 'enrichment')}.comments"
    tables.insert_into(tables.evolve_schema(v.comment_keys(), COMMENTS), comments)
    run_enrichment(v.spark, comments, SAMPLE)
    return show_enriched(v.spark.table(comments).select(*KEY, "video_id", *ENRICHMENT.fieldNames()))


@query
def cleaning_run(v: Views) -> DataFrame:
    """The declared videos after a later delivery was staged, cleaned and upserted by bucket."""
    database = _database(v, "cleaning")
    staging, videos = f"{database}.videos_staging", f"{database}.videos"
    tables.insert_into(clean_videos(v.staging()), videos)
    tables.insert_into(_as_staging(v.updates()), staging)
    run_cleaning(v.spark, staging, videos)
    left = v.spark.table(staging).select("video_id")
    return show_videos(v.spark.table(videos).drop(tables.BUCKET).join(left, "video_id", "left_anti"))


@query
def compacted_videos(v: Views) -> DataFrame:
    """The drained log folded into the declared table; read from there alone."""
    database = _database(v, "compact-videos")
    log, checkpoint = (scratch_path(v.spark, n) for n in ("log", "checkpoint"))
    tables.insert_into(clean_videos(v.staging()), f"{database}.videos")
    drains.drain_videos(v.update_stream(), log, checkpoint).awaitTermination()
    drains.compact_videos(v.spark, log, f"{database}.videos")
    return show_videos(v.spark.table(f"{database}.videos").drop(tables.BUCKET))


@query
def compacted_comments(v: Views) -> DataFrame:
    """The first delivery folded into the declared table, the second still in the log, both read as one."""
    table = f"{_database(v, 'compact-comments')}.enriched"
    log = scratch_path(v.spark, "log")
    for number, delivery in enumerate(v.comment_deliveries()):
        checkpoint = scratch_path(v.spark, "checkpoint")
        drains.drain_comments(delivery, log, checkpoint, partitions=_tasks(v)).awaitTermination()
        if number == 0:
            drains.compact_comments(v.spark, log, table)
    return show_enriched(drains.current_enrichment(v.spark, log, v.spark.table(table)))


@query
def declared_tables(v: Views) -> DataFrame:
    """Staged videos written into the declared staging table and cleaned from it into the declared videos."""
    database = _database(v, "declared")
    tables.insert_into(_as_staging(v.staging()), f"{database}.videos_staging")
    cleaned = clean_videos(tables.scan_staging(v.spark.table(f"{database}.videos_staging")))
    tables.insert_into(cleaned, f"{database}.videos")
    return show_videos(v.spark.table(f"{database}.videos").drop(tables.BUCKET))


@query
def drain_staging(v: Views) -> DataFrame:
    left = merging.drain_staging(v.staging(), v.updates())
    return left.select("video_id", "title", "content_duration")


# --- checks -----------------------------------------------------------------------------------


@query
def null_profile(v: Views) -> DataFrame:
    return profiling.null_profile(v.staging())


@query
def key_profile(v: Views) -> DataFrame:
    return profiling.key_profile(v.comment_keys(), ["comment_id"])


@query
def key_sketches(v: Views) -> DataFrame:
    """Distinct comment ids from merged sketches of each week, held against the exact number."""
    rows = v.comment_keys().withColumn("week", tables.week_of(F.col("published_at")))
    weekly = tables.stored(profiling.key_sketch(rows, ["comment_id"], ["week"]), "sketches")
    estimate = profiling.sketch_profile(profiling.merged_sketches(weekly))
    exact = profiling.key_profile(v.comment_keys(), ["comment_id"]).first()["distinct_keys"]
    off = F.abs(F.col("distinct_keys") / exact - 1)
    return estimate.select(
        "total_rows", F.lit(exact).alias("distinct_keys"), (off <= profiling.SKETCH_ERROR).alias("within_error")
    )


@query
def column_profile(v: Views) -> DataFrame:
    return profiling.column_profile(clean_videos(v.staging()))


@query
def run_metrics(v: Views) -> DataFrame:
    """Rows that a cleaning run writes, counted on the way."""
    cleaned, seen = profiling.observe_rows(clean_videos(v.staging()), "cleaned")
    cleaned.write.format("noop").mode("overwrite").save()
    return v.spark.createDataFrame([(seen.get["rows_processed"],)], "rows_processed long")


# --- dashboards -------------------------------------------------------------------------------


def _scored(v: Views) -> DataFrame:
    """Row-local enrichment: dashboards over comments need no language."""
    rows = enrich_rows(v.comments(), keep=[*KEY, "channel_id", "video_id"])
    return merging.with_skip_defaults(rows.drop("text_original"))


@query
def category_breakdown_mart(v: Views) -> DataFrame:
    return rounded(
        category_breakdown(_scored(v)), "mean_confidence", "mean_quality", "share"
    )


@query
def category_by_channel(v: Views) -> DataFrame:
    mart = category_breakdown(_scored(v), ["channel_id"])
    return rounded(mart, "mean_confidence", "mean_quality", "share")


@query
def sentiment_trend_mart(v: Views) -> DataFrame:
    trend = rounded(
        sentiment_trend(_scored(v)), "mean_positive", "mean_negative", "mean_neutral", "share"
    )
    return stamp(trend, "bucket")


@query
def channel_comparison(v: Views) -> DataFrame:
    return rounded(group_comparison(_scored(v), "channel_id"), "net_score")


@query
def comments_with_videos_mart(v: Views) -> DataFrame:
    joined = comments_with_videos(
        v.comment_keys().select(*KEY, "video_id", "like_count"),
        clean_videos(v.staging()),
        ["channel_id", "language_name", "topic_categories"],
    )
    return stamp(
        joined.withColumn("video_topic_categories", F.array_join("video_topic_categories", "|"))
    )


@query
def video_language_comparison(v: Views) -> DataFrame:
    """Sentiment mix by language of the commented video."""
    joined = comments_with_videos(_scored(v), clean_videos(v.staging()), ["language_name"])
    return rounded(group_comparison(joined, "video_language_name"), "net_score")


@query
def published_trend(v: Views) -> DataFrame:
    """The trend, written as a weekly table and read back."""
    root = scratch_path(v.spark, "marts")
    paths = tables.publish_marts({"trend": sentiment_trend(_scored(v))}, root)
    trend = v.spark.read.parquet(paths["trend"]).drop(tables.WEEK)
    return stamp(
        rounded(trend, "mean_positive", "mean_negative", "mean_neutral", "share"), "bucket"
    )


@query
def incremental_trend(v: Views) -> DataFrame:
    """The trend kept up to date by two deliveries, the second of which arrives twice."""
    table = f"{_database(v, 'trend')}.trend"
    tables.declare_table(v.spark, table, TREND_PARTS, tables.WEEK)
    for name in ("documents", "conversations", "conversations"):
        part = v.comments().where(F.col("parent_comment_id").isNull() == (name == "documents"))
        scored = merging.with_skip_defaults(enrich_rows(part).drop("text_original"))
        add_to_trend(scored, table, name)
    trend = trend_of_parts(v.spark.table(table))
    return stamp(
        rounded(trend, "mean_positive", "mean_negative", "mean_neutral", "share"), "bucket"
    )


# --- sources and sinks ------------------------------------------------------------------------


def _as_staging(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in STAGING_VIDEOS.fields])


def _show_staging(df: DataFrame) -> DataFrame:
    return stamp(df.withColumns({c: F.col(c).cast("double") for c in COUNTS}))


@query
def csv_videos(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "videos-csv")
    csv_source.write_csv(_as_staging(v.staging()), path)
    return _show_staging(csv_source.load_videos_csv(v.spark, path))


@query
def csv_videos_camel(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "videos-camel-csv")
    camel = {snake: name for name, snake in CAMEL_VIDEO_COLUMNS.items()}
    staged = _as_staging(v.staging())
    # Two exports whose columns come in different order.
    odd = F.xxhash64("video_id") % 2 == 0
    for part, columns in ((staged.where(odd), staged.columns), (staged.where(~odd), staged.columns[::-1])):
        csv_source.write_csv(part.select(*columns).withColumnsRenamed(camel), f"{path}-{columns[0]}")
    loaded = csv_source.load_videos_camel(v.spark, [f"{path}-{c}" for c in (staged.columns[0], staged.columns[-1])])
    return _show_staging(loaded.drop("kind"))


def _show_comments(loaded: DataFrame) -> DataFrame:
    return stamp(
        loaded.select(
            "kind", *KEY, "channel_id", "video_id", "author_id", "text_original",
            "parent_comment_id", F.col("like_count").cast("double").alias("like_count"),
            "sentiment", "comment_length",
        )
    )


def _loaded_comments(v: Views) -> DataFrame:
    paths = []
    for part in v.comment_exports():
        path = scratch_path(v.spark, "comments-csv")
        csv_source.write_csv(part, path)
        paths.append(path)
    return _show_comments(csv_source.load_comments_csv(v.spark, paths))


@query
def csv_comments(v: Views) -> DataFrame:
    """Two exports loaded as one table."""
    return _loaded_comments(v)


def _in_small_splits(v: Views, load) -> DataFrame:
    setting = "spark.sql.files.maxPartitionBytes"
    before = v.spark.conf.get(setting)
    v.spark.conf.set(setting, "64k")
    try:
        # The splits are cut when the plan is made; it is kept with the session's setting put back.
        return tables.stored(load(), "comments-loaded")
    finally:
        v.spark.conf.set(setting, before)


@query
def csv_comments_split(v: Views) -> DataFrame:
    """The same where splits are far smaller than the files: records with line breaks stay whole."""
    return _in_small_splits(v, lambda: _loaded_comments(v))


@query
def csv_flat_export(v: Views) -> DataFrame:
    """Exports without line breaks inside quotes, each read in many splits."""
    paths = []
    for part in v.comment_exports():
        path = scratch_path(v.spark, "comments-csv")
        flat = F.translate("text_original", "\r\n", "  ")
        csv_source.write_csv(part.withColumn("text_original", flat), path)
        paths.append(path)

    def load() -> DataFrame:
        return _show_comments(csv_source.load_comments_csv(v.spark, paths, multi_line=False))

    return _in_small_splits(v, load)


@query
def time_partitioned_scan(v: Views) -> DataFrame:
    """Comments laid out by week; the second week of January read back."""
    from datetime import datetime

    path = scratch_path(v.spark, "comments-by-week")
    tables.write_time_partitioned(v.comment_keys(), path)
    week = tables.between_published(
        v.spark.read.parquet(path), datetime(2024, 1, 8), datetime(2024, 1, 15)
    )
    return stamp(week.select(*KEY, "video_id", "text_original"))


@query
def schema_evolution(v: Views) -> DataFrame:
    evolved = tables.evolve_schema(v.comment_keys(), COMMENTS)
    return profiling.null_profile(evolved)


# --- incremental runs -------------------------------------------------------------------------


def _tasks(v: Views) -> int:
    """A delivery of these tables is one file; a batch of it is dealt out to all cores."""
    return int(v.spark.conf.get("spark.sql.shuffle.partitions"))


@query
def stream_enrich(v: Views) -> DataFrame:
    """Comments enriched batch by batch, read back as one row per id."""
    root = scratch_path(v.spark, "drain-comments")
    profile = train_profile(v.documents())
    drains.drain_comments(
        v.comment_stream(), f"{root}/log", f"{root}/checkpoint", profile, partitions=_tasks(v)
    ).awaitTermination()
    return show_enriched(drains.current_enrichment(v.spark, f"{root}/log"))


@query
def stream_two_deliveries(v: Views) -> DataFrame:
    """Documents and conversations arrive apart, each drained with a checkpoint of its own into one log."""
    root = scratch_path(v.spark, "drain-deliveries")
    for name, delivery in zip(("first", "second"), v.comment_deliveries()):
        drains.drain_comments(delivery, f"{root}/log", f"{root}/{name}", partitions=_tasks(v)).awaitTermination()
    return show_enriched(drains.current_enrichment(v.spark, f"{root}/log"))


@query
def stream_sample(v: Views) -> DataFrame:
    """The priority sample kept as state over two deliveries of one stream."""
    source, log, checkpoint = (scratch_path(v.spark, n) for n in ("deliveries", "log", "checkpoint"))
    for export in v.comment_exports():
        narrow = export.select("comment_id", "video_id", "published_at")
        narrow.write.mode("append").parquet(source)
        drains.drain_sample(drains.read_stream(v.spark, source, narrow.schema), log, checkpoint, SAMPLE).awaitTermination()
    return stamp(drains.current_sample(v.spark, log, SAMPLE))


@query
def stream_metrics(v: Views) -> DataFrame:
    """Comments of each delivery as the drain's listener saw them, beside the rows that the log holds."""
    log = scratch_path(v.spark, "log")
    seen = drains.DrainCounts()
    v.spark.streams.addListener(seen)
    try:
        runs = []
        for delivery in v.comment_deliveries():
            run = drains.drain_comments(delivery, log, scratch_path(v.spark, "checkpoint"), partitions=_tasks(v))
            run.awaitTermination()
            runs.append(str(run.runId))
        seen.wait(runs)
    finally:
        v.spark.streams.removeListener(seen)
    rows = [(number, seen.rows(run)) for number, run in enumerate(runs)]
    return v.spark.createDataFrame(rows, "delivery int, rows_processed long")


@query
def stream_upsert(v: Views) -> DataFrame:
    """A later delivery of videos drained over the clean table."""
    root = scratch_path(v.spark, "drain-videos")
    drains.drain_videos(
        v.update_stream(), f"{root}/log", f"{root}/checkpoint"
    ).awaitTermination()
    base = clean_videos(v.staging())
    return show_videos(drains.current_videos(v.spark, f"{root}/log", base))


@query
def stream_trend(v: Views) -> DataFrame:
    """The live trend in complete mode, each update replacing the one before."""
    root = scratch_path(v.spark, "live-trend")
    rows = enrich_rows(v.comment_stream()).drop("text_original")
    live = drains.live_sentiment_trend(merging.with_skip_defaults(rows))
    run = (
        live.writeStream.outputMode("complete")
        .foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(f"{root}/trend"))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    trend = v.spark.read.parquet(f"{root}/trend")
    return stamp(rounded(trend, "mean_positive", "mean_negative", "mean_neutral"), "bucket")


@query
def stream_trend_append(v: Views) -> DataFrame:
    """The live trend in append mode: windows that the watermark has passed, each emitted once."""
    root = scratch_path(v.spark, "live-trend")
    rows = enrich_rows(v.comment_stream()).drop("text_original")
    live = drains.live_sentiment_trend(merging.with_skip_defaults(rows))
    run = (
        live.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{root}/trend")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    trend = v.spark.read.schema(live.schema).parquet(f"{root}/trend")
    return stamp(rounded(trend, "mean_positive", "mean_negative", "mean_neutral"), "bucket")
