"""Data checks: missing values, key uniqueness, columns, and counts of a running job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _counts_by_column(df: DataFrame, count, name: str) -> DataFrame:
    # One pass over the data, then one row turned into a row per column.
    totals = df.agg(*[count(F.col(c)).alias(c) for c in df.columns])
    return totals.unpivot([], df.columns, "column_name", name)


def null_profile(df: DataFrame) -> DataFrame:
    return _counts_by_column(df, lambda c: F.count_if(c.isNull()), "null_count")


def column_profile(df: DataFrame) -> DataFrame:
    """Column names, types and non-null counts."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = _counts_by_column(df, F.count, "non_null_count")
    return counts.select(
        "column_name", types[F.col("column_name")].alias("data_type"), "non_null_count"
    )


def key_profile(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and keys held by more than one row."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicated_keys"),
    )


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, plus a counter that fills in when a job runs over them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows_processed")), seen


# Precision of the sketches of distinct keys, and the relative error that their estimates keep but for one time in a thousand.
SKETCH_BITS = 14
SKETCH_ERROR = 0.03


def key_sketch(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and a sketch of the distinct keys of each group: a few kilobytes however many keys there are.

    Sketches of parts, such as weeks or deliveries, are kept and merged by ``merged_sketches`` without reading the parts again.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"), F.hll_sketch_agg(F.xxhash64(*key), SKETCH_BITS).alias("keys")
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return sketches.groupBy(*by).agg(F.sum("total_rows").alias("total_rows"), F.hll_union_agg("keys").alias("keys"))


def sketch_profile(sketches: DataFrame) -> DataFrame:
    """Like ``key_profile``, with the number of distinct keys to within ``SKETCH_ERROR`` of the exact one."""
    return sketches.withColumn("distinct_keys", F.hll_sketch_estimate("keys")).drop("keys")
