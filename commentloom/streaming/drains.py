"""Incremental runs: drain what is new, then stop. The checkpoint remembers what is done."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from commentloom.operators.language import LanguageProfile
from commentloom.operators.merging import upsert
from commentloom.operators.ranking import (
    SALT_BUCKETS,
    SAMPLE_PER_VIDEO,
    dedupe_latest,
    newest_first,
    salt,
)
from commentloom.operators.scoring import Scorer
from commentloom.plans.comments import enrich_comments
from commentloom.plans.videos import clean_videos
from commentloom.schemas import CLEAN_VIDEOS, ENRICHED
from commentloom.sources.tables import (
    WEEK,
    drop_weeks,
    overwrite_parts,
    part_week,
    rows_of_parts,
    stored,
    upsert_into,
)

BATCH = "batch_id"
RUN = "run"


def read_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None):
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """Name of the run that a checkpoint belongs to: start time and a random part.

    It is kept in the checkpoint, so a restart goes on with the same run and a new checkpoint, also at an old
    place, begins another. Names sort by start time.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{RUN}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        return spark.read.text(path.toString()).first()[0]
    name = f"{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex}"
    out = files.create(path, False)
    out.write(bytearray(name.encode()))
    out.close()
    return name


class DrainCounts(StreamingQueryListener):
    """Rows of each micro-batch of the drains, counted by ``observe`` on their way, so nothing is read again.

    Add it to ``spark.streams`` before a drain starts. ``counts`` holds (run id of the query, batch): rows.
    """

    NAME = "drained"

    def __init__(self):
        self.counts: dict[tuple[str, int], int] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def rows(self, run: str) -> int:
        return sum(n for (at, _), n in self.counts.items() if at == run)

    def wait(self, runs: Sequence[str], seconds: float = 60) -> None:
        """Until the ends of these runs are reported: events arrive a little after a run is over."""
        with self._changed:
            if not self._changed.wait_for(lambda: self._ended.issuperset(runs), seconds):
                raise TimeoutError("the end of a drain was not reported")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.NAME)
        if seen is not None:
            self.counts[(str(event.progress.runId), event.progress.batchId)] = seen["rows"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()


def _drain(
    stream: DataFrame, step, log: str, checkpoint: str, partitions: int | None, mode: str = "append"
) -> StreamingQuery:
    """Append each micro-batch's result to a log, one folder per run and batch.

    A replayed batch overwrites its own folder, so a restart leaves no duplicates, and another
    run has other folders. ``partitions`` deals out a batch whose files are fewer than the cores.
    """
    run = run_name(stream.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        dealt = batch.repartition(partitions) if partitions else batch
        step(dealt).write.mode("overwrite").parquet(f"{log}/{RUN}={run}/{BATCH}={batch_id}")

    return (
        stream.observe(DrainCounts.NAME, F.count(F.lit(1)).alias("rows")).writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_comments(
    stream: DataFrame,
    log: str,
    checkpoint: str,
    profile: LanguageProfile | None = None,
    scorer: Scorer | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Enrich comments as they arrive."""
    return _drain(stream, lambda batch: enrich_comments(batch, profile, scorer), log, checkpoint, partitions)


def read_log(spark: SparkSession, log: str, schema: T.StructType) -> DataFrame:
    """Everything drained so far, with run and batch; an empty table if there was no batch yet."""
    whole = T.StructType(
        [*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
    )
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(log)


def newest_written() -> list[Column]:
    return [F.col(RUN).desc(), F.col(BATCH).desc()]


def batch_counts(spark: SparkSession, log: str) -> DataFrame:
    """Rows written by each batch; the counts come from the file footers."""
    return read_log(spark, log, T.StructType()).groupBy(RUN, BATCH).agg(F.expr("count(1) AS rows_processed"))


def current_enrichment(spark: SparkSession, log: str, base: DataFrame | None = None) -> DataFrame:
    """One row per comment id: the newest comment, last written if equal, over what ``base`` holds.

    With a base the log is what came since the last ``compact_comments``. Rows of the base meet the log by their id
    and time alone.
    """
    order = [F.col("published_at").desc(), *newest_written()]
    latest = dedupe_latest(read_log(spark, log, ENRICHED), ["comment_id"], order).drop(RUN, BATCH)
    if base is None:
        return latest
    latest = stored(latest, "latest")
    newer = _newer(latest, base)
    kept = base.join(newer.select("comment_id"), "comment_id", "left_anti")
    return kept.select(*latest.columns).union(newer)


def _newer(latest: DataFrame, base: DataFrame) -> DataFrame:
    """The drained rows that no newer comment of the same id in the base stands against."""
    held = base.select("comment_id", F.col("published_at").alias("_held"), F.lit(True).alias("_known"))
    outdated = F.col("_known") & F.col("_held").isNotNull() & (
        F.col("published_at").isNull() | (F.col("published_at") < F.col("_held"))
    )
    met = latest.join(held, "comment_id", "left")
    return met.where(~F.coalesce(outdated, F.lit(False))).select(*latest.columns)


def compact_comments(spark: SparkSession, log: str, table: str = "enriched") -> None:
    """Fold the log into the declared table, by weeks, and delete the batches folded in.

    Only the weeks that change are read whole and written: those of the new rows, and those that hold an older comment
    of their ids. Reading afterwards costs the table and what has come since. A crash before the batches are deleted leaves
    batches that are folded in once more to the same end. One run at a time.
    """
    folded = _batches(spark, log, ENRICHED)
    if not folded:
        return
    base = spark.table(table)
    order = [F.col("published_at").desc(), *newest_written()]
    latest = stored(dedupe_latest(read_log(spark, log, ENRICHED), ["comment_id"], order).drop(RUN, BATCH), "latest")
    newer = stored(_newer(latest, base).withColumn(WEEK, part_week(F.col("published_at"))), "newer")
    replaced = base.select("comment_id", WEEK).join(newer.select("comment_id"), "comment_id", "left_semi")
    one = F.lit(1)
    rows = newer.select(WEEK, one.alias("n"), F.lit(0).alias("_out")).union(replaced.select(WEEK, one, one))
    weeks = stored(rows.groupBy(WEEK).agg(F.sum("n").alias("n"), F.sum("_out").alias("_out")), "weeks")
    touched = rows_of_parts(base, weeks, WEEK)
    # A week whose last row moves to another is not written below, so it has to go by itself.
    emptied = weeks.where("n = _out").join(touched.groupBy(WEEK).agg(F.count(one).alias("_held")), WEEK)
    gone = [r[WEEK] for r in emptied.where("_held = _out").collect()]
    kept = touched.join(newer.select("comment_id"), "comment_id", "left_anti")
    overwrite_parts(kept.select(*newer.columns).union(newer), table)
    drop_weeks(spark, table, gone)
    _delete(spark, log, folded)


def _batches(spark: SparkSession, log: str, schema: T.StructType) -> list[tuple]:
    return [tuple(r) for r in read_log(spark, log, schema).select(RUN, BATCH).distinct().collect()]


def _delete(spark: SparkSession, log: str, batches: list[tuple]) -> None:
    for run, batch in batches:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{log}/{RUN}={run}/{BATCH}={batch}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drain_videos(
    stream: DataFrame, log: str, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Clean staged videos as they arrive.

    The log holds replaced rows; ``current_videos`` reads it as an upsert. A batch thus costs
    what it brings, however large the table is.
    """

    def step(batch: DataFrame) -> DataFrame:
        return dedupe_latest(clean_videos(batch), ["video_id"], [F.col("published_at").desc()])

    return _drain(stream, step, log, checkpoint, partitions)


def current_videos(
    spark: SparkSession, log: str, base: DataFrame | None = None
) -> DataFrame:
    """The table after all batches: per video the row of the latest batch, over an older base."""
    latest = dedupe_latest(read_log(spark, log, CLEAN_VIDEOS), ["video_id"], newest_written()).drop(RUN, BATCH)
    return latest if base is None else upsert(base, latest)


def compact_videos(spark: SparkSession, log: str, table: str = "videos") -> None:
    """Fold the log into the declared table and delete the batches folded in.

    Only the buckets of the drained videos are read and written. Reading afterwards costs the table and what has come
    since, not the history. A crash before the batches are deleted leaves batches that are folded in once more to the same end.
    """
    folded = _batches(spark, log, CLEAN_VIDEOS)
    if folded:
        upsert_into(current_videos(spark, log), table)
        _delete(spark, log, folded)


SAMPLED = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("comment_id", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)
_NO_TIME = -(1 << 63)


def live_sample(stream: DataFrame, k: int = SAMPLE_PER_VIDEO, buckets: int = SALT_BUCKETS) -> DataFrame:
    """The newest k comments of each part of each video, emitted whenever one of them changes.

    A video is dealt over ``buckets`` parts by its comments' keys, and the state of a part is its newest k keys and no more, however many
    comments went by. A comment that is delivered again changes nothing.
    """

    def keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = set(zip(*state.get)) if state.exists else set()
        before = set(held)
        for frame in frames:
            # Microseconds, as NULL ids would turn longs into floats.
            held.update(zip(frame["_time"].tolist(), frame["comment_id"].tolist()))
            held = set(sorted(held, reverse=True)[:k])
        if held == before:
            return
        newest = sorted(held, reverse=True)
        state.update(([t for t, _ in newest], [i for _, i in newest]))
        times = pd.Series([pd.NaT if t == _NO_TIME else pd.Timestamp(t, unit="us") for t, _ in newest], dtype="datetime64[us]")
        yield pd.DataFrame({"video_id": key[0], "part": key[1], "comment_id": [i for _, i in newest], "published_at": times})

    keyed = stream.where(F.col("comment_id").isNotNull()).select(
        "video_id", salt(["comment_id", "published_at"], buckets).alias("part"), "comment_id",
        F.coalesce(F.unix_micros(F.col("published_at").cast("timestamp")), F.lit(_NO_TIME)).alias("_time"),
    )
    return keyed.groupBy("video_id", "part").applyInPandasWithState(
        keep, SAMPLED, "times array<bigint>, ids array<bigint>", "update", GroupStateTimeout.NoTimeout
    )


def drain_sample(
    stream: DataFrame, log: str, checkpoint: str, k: int = SAMPLE_PER_VIDEO, buckets: int = SALT_BUCKETS
) -> StreamingQuery:
    """Keep the priority sample up to date with what arrives; the checkpoint holds the state."""
    return _drain(live_sample(stream, k, buckets), lambda batch: batch, log, checkpoint, None, "update")


def current_sample(spark: SparkSession, log: str, k: int = SAMPLE_PER_VIDEO) -> DataFrame:
    """The newest k comments of each video with their rank, as ``priority_sample`` gives them over all deliveries."""
    rows = read_log(spark, log, SAMPLED)
    last = rows.groupBy("video_id", "part").agg(F.max(F.struct(RUN, BATCH)).alias("_last"))
    names = last.select(F.col("video_id").alias("_video"), F.col("part").alias("_part"), "_last")
    same = F.col("video_id").eqNullSafe(F.col("_video")) & (F.col("part") == F.col("_part"))
    current = rows.join(names, same).where(F.struct(RUN, BATCH) == F.col("_last"))
    place = W.partitionBy("video_id").orderBy(*newest_first())
    ranked = current.select("comment_id", "video_id", "published_at").withColumn("rank", F.row_number().over(place))
    return ranked.where(F.col("rank") <= k)


def live_sentiment_trend(
    stream: DataFrame, bucket: str = "1 day", delay: str = "2 days", by: Sequence[str] = ()
) -> DataFrame:
    """Comments and mean scores per event-time window and sentiment.

    Append mode emits a window once the watermark has passed it and drops later rows; complete
    mode keeps every window.
    """
    scores = ("positive", "negative", "neutral")
    return (
        stream.withColumn("published_at", F.col("published_at").cast("timestamp"))
        .withWatermark("published_at", delay)
        .groupBy(F.window("published_at", bucket).alias("window"), "sentiment", *by)
        .agg(
            F.count(F.lit(1)).alias("comments"),
            *[F.avg(f"sentiment_score_{s}").alias(f"mean_{s}") for s in scores],
        )
        .select(F.col("window.start").alias("bucket"), "sentiment", *by, "comments",
                *[f"mean_{s}" for s in scores])
    )
