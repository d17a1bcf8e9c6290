"""Parquet tables: declaration, schema evolution, layout by week and by key, stored changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.operators.merging import upsert
from commentloom.schemas import CLEAN_VIDEOS, COMMENTS, ENRICHED, STAGING_VIDEOS
from commentloom.session import configure, scratch_path

# The tables by name.
TABLES = {"videos_staging": STAGING_VIDEOS, "videos": CLEAN_VIDEOS, "comments": COMMENTS}
WEEK = "week"
BUCKET = "bucket"
# The week of rows without a time, so that every row lies in a week that a join can name.
NO_WEEK = "0001-01-01"
BUCKETS = 64
_BUCKETS_KEY = "buckets"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the session's shared folder and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def declare_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    by: str | None = None,
    location: str | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Create a table where absent, laid out ``by`` the week of published_at, the bucket of a key, or not at all."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = ""
    if by:
        columns += f", `{by}` {'date' if by == WEEK else 'int'}"
        layout = f" PARTITIONED BY ({by})"
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}{where}"
        f" TBLPROPERTIES ('{_BUCKETS_KEY}' = '{buckets}')"
    )


def declare_tables(
    spark: SparkSession, database: str = "default", location: str | None = None, buckets: int = BUCKETS
) -> None:
    """Create the tables where absent: comments and their enrichment by week, videos by hashed key."""
    layouts = {"videos": BUCKET, "comments": WEEK, "enriched": WEEK}
    for name, schema in {**TABLES, "enriched": ENRICHED}.items():
        folder = f"{location}/{name}" if location else None
        declare_table(spark, f"`{database}`.`{name}`", schema, layouts.get(name), folder, buckets)


def _placed(df: DataFrame, table: str, key: str = "video_id") -> DataFrame:
    """The columns of the table, its week or bucket worked out where that is missing."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    if WEEK in columns and WEEK not in df.columns:
        df = df.withColumn(WEEK, part_week(F.col("published_at")))
    if BUCKET in columns and BUCKET not in df.columns:
        count = spark.sql(f"SHOW TBLPROPERTIES {table} ('{_BUCKETS_KEY}')").first()["value"]
        df = df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(int(count))).cast("int"))
    return df.select(*columns)


def insert_into(df: DataFrame, table: str) -> None:
    """Add rows to a declared table, columns by name."""
    _placed(df, table).write.insertInto(table)


def overwrite_parts(df: DataFrame, table: str) -> None:
    """Replace the weeks or buckets that the rows fall in, and nothing else; a table without parts is replaced whole.

    The rows may be worked out from the table itself if it has parts. REBALANCE sizes the files at run time.
    """
    spark = configure(df.sparkSession)
    placed = _placed(df, table)
    part = next((c for c in (WEEK, BUCKET) if c in placed.columns), None)
    if part:
        placed = placed.hint("rebalance", part)
    placed.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def rows_of_parts(table: DataFrame, parts: DataFrame, part: str) -> DataFrame:
    """The rows of the weeks or buckets that ``parts`` (part, n) names; other folders are not read.

    The list is broadcast: it has a row per week or bucket, of which a table has a bounded number whatever its size.
    """
    wanted = F.broadcast(parts.where("n > 0").select(part))
    return table.join(wanted, part, "left_semi").select(*table.columns)


def upsert_into(df: DataFrame, table: str, key: str = "video_id") -> None:
    """Insert or replace rows of a table laid out by bucket; only the buckets of the given rows are read and written.

    The rows have one row per key.
    """
    rows = stored(_placed(df, table, key), "delivery")
    touched = stored(rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")), "touched")
    overwrite_parts(upsert(rows_of_parts(df.sparkSession.table(table), touched, BUCKET), rows, key), table)


def drop_weeks(spark: SparkSession, table: str, weeks: Sequence) -> None:
    """Empty weeks of a declared table and take them off its list; a table with a location of its own keeps files otherwise."""
    schema = spark.table(table).schema
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in schema if f.name != WEEK)
    for week in weeks:
        part = f"PARTITION ({WEEK} = DATE'{week}')"
        spark.sql(f"INSERT OVERWRITE TABLE {table} {part} SELECT {nothing} WHERE false")
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part}")


def evolve_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns that are missing, as NULL; those present stay, so doing it twice is safe."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def union_all(*parts: DataFrame) -> DataFrame:
    """Tables of different age as one: columns by name, absent ones NULL."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def scan_staging(staging: DataFrame) -> DataFrame:
    """The staging columns that cleaning uses; the reader skips the rest."""
    return staging.select(*[n for n in STAGING_VIDEOS.fieldNames() if n != "kind"])


def week_of(timestamp: Column) -> Column:
    return F.to_date(F.date_trunc("week", timestamp))


def part_week(timestamp: Column) -> Column:
    """The week that a declared table files a row under."""
    return F.coalesce(week_of(timestamp), F.lit(NO_WEEK).cast("date"))


def write_time_partitioned(
    df: DataFrame, path: str, column: str = "published_at", mode: str = "overwrite"
) -> None:
    """One folder per week of a timestamp.

    REBALANCE sizes the files at run time: a week with a third of all rows is split over many
    tasks and a quiet one takes a single file. Rows are sorted by video and time inside a file, so that
    row groups can be skipped.
    """
    laid_out = df.withColumn(WEEK, week_of(F.col(column))).hint("rebalance", WEEK)
    by = [WEEK, *[c for c in ("video_id",) if c in df.columns], column]
    writer = laid_out.sortWithinPartitions(*by).write.mode(mode).partitionBy(WEEK)
    writer.option("partitionOverwriteMode", "static").parquet(path)


def between_published(
    df: DataFrame, start: datetime, end: datetime, column: str = "published_at"
) -> DataFrame:
    """Rows of [start, end). The bound on the week column prunes folders before any is read."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    stamp = F.col(column)
    week = F.col(WEEK)
    return df.where(
        (week >= week_of(low)) & (week <= week_of(high)) & (stamp >= low) & (stamp < high)
    )


def publish_marts(marts: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Write dashboard tables, by week where they have a time bucket."""
    paths = {}
    for name, mart in marts.items():
        path = paths[name] = f"{root}/{name}"
        if "bucket" in mart.columns:
            write_time_partitioned(mart, path, "bucket")
        else:
            mart.write.mode("overwrite").parquet(path)
    return paths
