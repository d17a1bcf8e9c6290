"""Sources, sinks, video cleaning, dashboards and streams."""

import csv
import random
from datetime import datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.operators import profiling
from commentloom.operators.ranking import priority_sample
from commentloom.plans.comments import enrich_comments, enrich_rows
from commentloom.plans.marts import (
    TREND_PARTS,
    add_to_trend,
    category_breakdown,
    comments_with_videos,
    sentiment_trend,
    trend_of_parts,
)
from commentloom.plans.runs import run_cleaning, run_enrichment
from commentloom.plans.videos import clean_videos
from commentloom.schemas import CLEAN_VIDEOS, COMMENTS, ENRICHED, STAGING_VIDEOS
from commentloom.session import shared_dir
from commentloom.sources import tables
from commentloom.sources.csv import (
    load_comments_csv,
    load_videos_camel,
    load_videos_csv,
    read_csv,
)
from commentloom.streaming import drains
from commentloom.workload.views import Views

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)
VIDEO_HEADER = ",".join(STAGING_VIDEOS.fieldNames())
VIDEO_ROW = 'k,v1,2024-01-02T03:04:05Z,c,"a ""b"", c\nd","",,en,,PT1S,1,,3.5,4,[]'


def test_videos_csv(spark, tmp_path):
    path = tmp_path / "videos.csv"
    path.write_text(f"{VIDEO_HEADER}\n{VIDEO_ROW}\n")
    row = load_videos_csv(spark, str(path)).first()
    assert row["title"] == 'a "b", c\nd'
    assert row["description"] == "" and row["tags"] is None
    assert row["published_at"] == datetime(2024, 1, 2, 3, 4, 5)
    assert float(row["favourite_count"]) == 3.5 and row["like_count"] is None


def test_bad_rows_fail(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    for i, body in enumerate(("1,a\nx,b\n", "1,a\n2\n", "1,a\n2,b,c\n")):
        path = tmp_path / f"bad{i}.csv"
        path.write_text("id,t\n" + body)
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
            read_csv(spark, str(path), schema).collect()


def test_quotes_and_empty_fields(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    path = tmp_path / "quotes.csv"
    path.write_text('id,t\n1,5" pipe\n2,"a ""b"" c"\n3,""\n4,\n5," x "\n')
    got = {r["id"]: r["t"] for r in read_csv(spark, str(path), schema).collect()}
    # A quote inside an unquoted field is a character of it.
    assert got == {1: '5" pipe', 2: 'a "b" c', 3: "", 4: None, 5: " x "}


def test_comment_files_load_as_one_table(spark, tmp_path):
    header = "kind,comment_id,channel_id,video_id,author_id,text_original,parent_comment_id,like_count,published_at,updated_at"
    paths = []
    for i in range(5):
        path = tmp_path / f"comments{i}.csv"
        path.write_text(f'{header}\nk,{i},7,v{i},8,"line\n{i}",,2,2024-01-01 00:00:0{i}+00:00,\n')
        paths.append(str(path))
    loaded = load_comments_csv(spark, paths)
    assert loaded.columns == COMMENTS.fieldNames()
    rows = {r["comment_id"]: r for r in loaded.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4]
    assert rows[3]["text_original"] == "line\n3" and rows[3]["sentiment"] is None


def test_camel_headers_bind_by_name(spark, tmp_path):
    path = tmp_path / "videos.csv"
    path.write_text("videoId,kind,title,viewCount,contentDuration\nv1,k,t,12,PT2S\n")
    row = load_videos_camel(spark, str(path)).first()
    assert (row["video_id"], float(row["view_count"]), row["content_duration"]) == ("v1", 12.0, "PT2S")
    other = tmp_path / "more.csv"
    other.write_text("title,extra,viewCount,videoId\nt2,e,13,v2\n")
    rows = load_videos_camel(spark, [str(path), str(other)]).collect()
    assert {(r["video_id"], r["title"], float(r["view_count"]), r["extra"]) for r in rows} == {
        ("v1", "t", 12.0, None), ("v2", "t2", 13.0, "e")
    }


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["134217728", "300"])
def test_any_text_survives_any_split_size(spark, tmp_path, newline, size):
    rng = random.Random(5)
    pieces = ["a", '"', ",", "\n", "\r\n", "é", " ", "\U0001f600", "\n\n", "\r", "some longer text "]
    rows = {i: "".join(rng.choice(pieces) for _ in range(rng.randint(1, 50))) for i in range(120)}
    path = tmp_path / "x.csv"
    with open(path, "w", newline="", encoding="utf8") as f:
        writer = csv.writer(f, lineterminator=newline)
        writer.writerow(["id", "t"])
        writer.writerows(rows.items())
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], "1")
        got = read_csv(spark, str(path), schema).collect()
        flat = read_csv(spark, str(path), schema, multi_line=False)
        assert size != "300" or flat.rdd.getNumPartitions() > 9
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
    assert len(got) == len(rows)
    # Line ends of the file's own kind come out as line feeds.
    assert {r["id"]: r["t"] for r in got} == {i: t.replace(newline, "\n") for i, t in rows.items()}


def test_declared_tables_and_evolution(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS loom_test")
    try:
        for _ in range(2):
            tables.declare_tables(spark, "loom_test", str(tmp_path))
        assert spark.table("loom_test.videos").columns == [*CLEAN_VIDEOS.fieldNames(), "bucket"]
        assert "week" in spark.table("loom_test.comments").columns
    finally:
        spark.sql("DROP DATABASE loom_test CASCADE")
    old = spark.createDataFrame([(1, "Positive")], "comment_id long, sentiment string")
    once = tables.evolve_schema(old, COMMENTS)
    assert set(once.columns) == set(COMMENTS.fieldNames())
    assert tables.evolve_schema(once, COMMENTS).columns == once.columns
    assert once.first()["sentiment"] == "Positive" and once.first()["comment_length"] is None


def test_weekly_layout_prunes_folders(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(i, f"v{i % 3}", start + timedelta(hours=i)) for i in range(24 * 28)]
    df = spark.createDataFrame(rows, "comment_id long, video_id string, published_at timestamp")
    path = str(tmp_path / "weeks")
    tables.write_time_partitioned(df, path)
    stored = spark.read.parquet(path)
    assert stored.count() == len(rows)
    low, high = start + timedelta(days=8), start + timedelta(days=10)
    some = tables.between_published(stored, low, high)
    assert some.count() == 48
    plan = plan_of(some)
    assert "week" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(published_at" in plan.split("PushedFilters: [")[1]


def test_clean_videos_is_one_native_stage(spark, tmp_path):
    Views(spark, SF).staging().write.parquet(str(tmp_path / "staging"))
    staged = spark.read.parquet(str(tmp_path / "staging"))
    cleaned = clean_videos(tables.scan_staging(staged))
    assert [(f.name, f.dataType) for f in cleaned.schema.fields] == [
        (f.name, f.dataType) for f in CLEAN_VIDEOS.fields
    ]
    plan = plan_of(cleaned)
    assert "Python" not in plan and "Exchange" not in plan
    assert "kind" not in plan.split("ReadSchema:")[1]


def test_duration_beyond_int_is_null(spark):
    df = Views(spark, SF).staging().withColumn("content_duration", F.lit("P99999999D"))
    assert clean_videos(df).select("duration_seconds").distinct().collect()[0][0] is None


def test_orphans_are_kept(spark):
    comments = spark.createDataFrame(
        [(1, None), (2, "gone"), (3, "v1"), (4, "v1")], "comment_id long, video_id string"
    ).withColumn("published_at", F.lit(datetime(2024, 1, 1)))
    videos = spark.createDataFrame([("v1", "c9"), (None, "never")], "video_id string, channel_id string")
    joined = comments_with_videos(comments, videos, ["channel_id"])
    got = {r["comment_id"]: (r["video_id"], r["video_channel_id"]) for r in joined.collect()}
    assert got == {1: (None, None), 2: ("gone", None), 3: ("v1", "c9"), 4: ("v1", "c9")}


def test_shares_sum_to_one(spark):
    rows = enrich_comments(Views(spark, SF).comments())
    assert category_breakdown(rows).agg(F.sum("share")).first()[0] == pytest.approx(1.0)
    per_day = sentiment_trend(rows).groupBy("bucket").agg(F.sum("share").alias("s")).collect()
    assert per_day and all(r["s"] == pytest.approx(1.0) for r in per_day)
    by_week = sentiment_trend(rows, "week")
    assert by_week.agg(F.sum("comments")).first()[0] == rows.count()


def test_comment_drain_equals_batch_and_resumes(spark, tmp_path):
    views = Views(spark, SF)
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "checkpoint"))
    everything = views.comment_keys()
    older, newer = [everything.where(c) for c in ("like_count >= 4", "like_count < 4")]
    older.write.mode("append").parquet(source)
    schema = everything.schema
    stream = drains.read_stream(spark, source, schema, files_per_batch=1)
    drains.drain_comments(stream, log, checkpoint).awaitTermination()
    newer.write.mode("append").parquet(source)
    for _ in range(2):
        stream = drains.read_stream(spark, source, schema, files_per_batch=1)
        drains.drain_comments(stream, log, checkpoint).awaitTermination()
    got = drains.current_enrichment(spark, log)
    want = enrich_comments(everything)
    assert got.count() == want.count()
    assert got.select(want.columns).exceptAll(want).count() == 0


def test_two_runs_keep_both_and_a_replay_leaves_no_duplicates(spark, tmp_path):
    views = Views(spark, SF)
    log = str(tmp_path / "log")
    for attempt in ("a", "b", "a"):
        drains.drain_videos(
            views.update_stream(), log, str(tmp_path / attempt)
        ).awaitTermination()
    updates = clean_videos(views.updates())
    counts = [(r["batch_id"], r["rows_processed"]) for r in drains.batch_counts(spark, log).collect()]
    assert counts == [(0, updates.count())] * 2
    base = clean_videos(views.staging())
    merged = drains.current_videos(spark, log, base)
    ids = merged.select("video_id")
    assert ids.count() == ids.distinct().count()
    assert ids.count() == base.select("video_id").union(updates.select("video_id")).distinct().count()


def test_runs_over_different_input_lose_nothing(spark, tmp_path):
    log = str(tmp_path / "log")
    assert drains.current_enrichment(spark, log).count() == 0
    assert drains.current_videos(spark, log).columns == CLEAN_VIDEOS.fieldNames()
    everything = Views(spark, SF).comment_keys()
    for name, part in (("a", "comment_id % 2 = 0"), ("b", "comment_id % 2 <> 0")):
        everything.where(part).write.parquet(str(tmp_path / f"in-{name}"))
        stream = drains.read_stream(spark, str(tmp_path / f"in-{name}"), everything.schema)
        drains.drain_comments(stream, log, str(tmp_path / name)).awaitTermination()
    assert drains.current_enrichment(spark, log).count() == everything.select("comment_id").distinct().count()


@pytest.fixture
def database(spark, tmp_path):
    name = f"loom_{tmp_path.name}".replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'db'}'")
    tables.declare_tables(spark, name, str(tmp_path / "db"), buckets=8)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def part_files(folder):
    """Data files by part of a table."""
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in folder.iterdir() if "=" in p.name}


def test_an_upsert_writes_the_buckets_it_touches(spark, database, tmp_path):
    base = spark.range(200).select(F.concat(F.lit("v"), "id").alias("video_id"), F.lit("old").alias("title"))
    base = tables.evolve_schema(base, CLEAN_VIDEOS)
    videos = f"{database}.videos"
    tables.upsert_into(base, videos)
    before = part_files(tmp_path / "db" / "videos")
    assert len(before) == 8
    changes = base.where("video_id IN ('v7', 'v8')").union(base.limit(1).withColumn("video_id", F.lit("new")))
    tables.upsert_into(changes.withColumn("title", F.lit("changed")), videos)
    after = part_files(tmp_path / "db" / "videos")
    touched = {r["bucket"] for r in spark.table(videos).where("title = 'changed'").collect()}
    assert {p for p in after if after[p] != before.get(p)} == {f"bucket={b}" for b in touched} and len(touched) <= 3
    got = {r["video_id"]: r["title"] for r in spark.table(videos).collect()}
    assert len(got) == 201 == spark.table(videos).count()
    assert {v for v, t in got.items() if t == "changed"} == {"v7", "v8", "new"}
    again = spark.table(videos).drop("bucket")
    tables.upsert_into(again.where("false"), videos)
    assert part_files(tmp_path / "db" / "videos") == after


def test_a_run_reads_and_writes_the_weeks_of_what_is_pending(spark, database, tmp_path):
    rows = [(i, START + timedelta(days=7 * (i % 4)), "one two three four five") for i in range(40)] + [(99, None, "a b c d e")]
    comments = tables.evolve_schema(
        spark.createDataFrame(rows, "comment_id long, published_at timestamp, text_original string"), COMMENTS
    )
    done = F.when(F.col("published_at") < START + timedelta(days=14), F.lit("Neutral"))
    name = f"{database}.comments"
    tables.insert_into(comments.withColumn("sentiment", done), name)
    before = part_files(tmp_path / "db" / "comments")
    run_enrichment(spark, name, k=3)
    after = part_files(tmp_path / "db" / "comments")
    changed = {p for p in after if after[p] != before[p]}
    assert changed == {"week=2024-01-15", "week=2024-01-22", "week=0001-01-01"} and len(after) == 5
    got = spark.table(name)
    assert got.count() == 41 and got.where("sentiment IS NULL").count() == 0
    assert got.where("published_at IS NULL").select("comment_length").first()[0] == len("a b c d e")
    weeks = spark.createDataFrame([(START.date(), 1)], "week date, n long")
    assert "dynamicpruning" in plan_of(tables.rows_of_parts(got, tables.stored(weeks, "weeks"), "week")).lower()


def test_cleaning_run_empties_the_staging_table(spark, database):
    views = Views(spark, SF)
    staging, videos = f"{database}.videos_staging", f"{database}.videos"
    staged = views.staging().select(*[F.col(f.name).cast(f.dataType) for f in STAGING_VIDEOS.fields])
    tables.insert_into(staged, staging)
    for _ in range(2):
        run_cleaning(spark, staging, videos)
        assert spark.table(staging).count() == 0
        assert spark.table(videos).count() == staged.select("video_id").distinct().count()


def test_the_comment_log_folds_into_weeks(spark, database, tmp_path):
    schema = "comment_id long, published_at timestamp, text_original string"
    first = [(i, START + timedelta(days=7 * (i % 3)), "one two three four") for i in range(30)] + [(77, START - timedelta(days=70), "x")]
    # A newer, an older and an equal comment of known ids, one that leaves its week empty, and a new one without time.
    second = [(1, START + timedelta(days=40), "newer one two three"), (2, START - timedelta(days=40), "older one two three"),
              (3, START, "equal one two three four"), (77, START, "moved one two three"), (500, None, "no time at all here")]
    log, table = str(tmp_path / "log"), f"{database}.enriched"
    whole = spark.createDataFrame(first + second, schema)

    def deliver(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
        stream = drains.read_stream(spark, str(tmp_path / name), whole.schema)
        drains.drain_comments(stream, log, str(tmp_path / f"{name}-checkpoint")).awaitTermination()

    deliver("first", first)
    drains.compact_comments(spark, log, table)
    assert drains.read_log(spark, log, ENRICHED).count() == 0 and spark.table(table).count() == 31
    deliver("second", second)
    before = part_files(tmp_path / "db" / "enriched")
    beside = drains.current_enrichment(spark, log, spark.table(table)).collect()
    drains.compact_comments(spark, log, table)
    after = part_files(tmp_path / "db" / "enriched")
    folded = drains.current_enrichment(spark, log, spark.table(table)).collect()
    got = {r["comment_id"]: (r["published_at"], r["comment_length"]) for r in folded}
    assert sorted(map(tuple, folded)) == sorted(map(tuple, beside)) and len(folded) == 32
    assert got[1][1] == len("newer one two three") and got[2][1] == len("one two three four")
    assert got[3][1] == len("equal one two three four") and got[500][0] is None
    assert set(before) - set(after) == {"week=2023-10-23"}
    assert after["week=2024-01-15"] == before["week=2024-01-15"]  # no new comment, no change
    assert spark.table(table).drop("week").count() == 32


def test_a_delivery_of_the_trend_replaces_itself(spark, database, tmp_path):
    rows = enrich_comments(Views(spark, SF).comments())
    early, late = rows.where("published_at < '2024-01-10'"), rows.where("published_at >= '2024-01-10'")
    table = f"{database}.trend"
    tables.declare_table(spark, table, TREND_PARTS, "week", str(tmp_path / "db" / "trend"))
    add_to_trend(early, table, "a")
    before = part_files(tmp_path / "db" / "trend")
    for _ in range(2):
        add_to_trend(late, table, "b")
    after = part_files(tmp_path / "db" / "trend")
    untouched = [w for w in before if w < "week=2024-01-08"]
    assert untouched and all(after[w] == before[w] for w in untouched)
    key = lambda r: (r["bucket"], r["sentiment"], r["comments"])
    assert sorted(map(key, trend_of_parts(spark.table(table)).collect())) == sorted(map(key, sentiment_trend(rows).collect()))


def test_a_live_sample_keeps_the_newest_of_all_deliveries(spark, tmp_path):
    rows = [(i, None if i % 3 == 0 else f"v{i % 3}", START + timedelta(minutes=i * 7919 % 600)) for i in range(300)] + [(900, "v1", None)]
    schema = "comment_id long, video_id string, published_at timestamp"
    whole = spark.createDataFrame(rows, schema)
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "checkpoint"))
    for part in ("comment_id < 100", "comment_id >= 100", "comment_id < 50"):  # the last comes again
        whole.where(part).write.mode("append").parquet(source)
        stream = drains.read_stream(spark, source, whole.schema)
        drains.drain_sample(stream, log, checkpoint, k=4, buckets=3).awaitTermination()
    key = lambda r: (r["video_id"] or "", r["rank"], r["comment_id"], r["published_at"])
    got, want = drains.current_sample(spark, log, 4).collect(), priority_sample(whole, 4).collect()
    assert sorted(map(key, got)) == sorted(map(key, want)) and len(got) == 12
    # What a part emits is bounded, however many comments it has seen.
    assert drains.read_log(spark, log, drains.SAMPLED).groupBy("video_id", "part", "run", "batch_id").count().agg(F.max("count")).first()[0] == 4


def test_merged_sketches_keep_their_error(spark):
    rows = spark.range(60_000).selectExpr("id % 40000 AS id", "id % 7 AS part")
    parts = profiling.key_sketch(rows, ["id"], ["part"])
    found = profiling.sketch_profile(profiling.merged_sketches(parts)).first()
    assert found["total_rows"] == 60_000 and abs(found["distinct_keys"] / 40_000 - 1) <= profiling.SKETCH_ERROR
    assert profiling.sketch_profile(profiling.merged_sketches(parts.where("false"))).first()["distinct_keys"] in (0, None)


def test_views_read_whole_texts(spark):
    views = Views(spark, SF)
    docs = views.table("documents")
    chars = docs.agg(F.sum(F.length("text"))).first()[0]
    ours = views.comments().where("comment_id >= 0").join(docs.withColumnRenamed("doc_id", "comment_id"), "comment_id")
    whole = ours.where("endswith(text_original, text)").select("comment_id", "text").distinct()
    assert whole.agg(F.sum(F.length("text"))).first()[0] == chars
    pages = views.table("pages")
    staged = views.staging().join(pages.selectExpr("concat('v', page_id) AS video_id", "html"), "video_id")
    assert staged.where("endswith(description, html)").count() == pages.count()


def test_live_trend_in_append_mode_emits_closed_windows_once(spark, tmp_path):
    rows = enrich_rows(Views(spark, SF).comment_stream()).drop("text_original")
    rows = rows.withColumn("sentiment", F.coalesce("sentiment", F.lit("N/A")))
    live = drains.live_sentiment_trend(rows, delay="1 hour")
    out = str(tmp_path / "out")
    run = (
        live.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    run.awaitTermination()
    emitted = spark.read.parquet(out)
    assert emitted.count() > 0
    assert emitted.count() == emitted.select("bucket", "sentiment").distinct().count()


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    else:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
        assert shared_dir(spark).removeprefix("file:").startswith(warehouse)
