"""Ranks and running sums within groups of any size, in two levels.

A group is cut into chunks of bounded size. Chunks are summed first, the sums are added up along
the chunks of a group, and each chunk is then ranked by itself: no task holds a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str | Column],
    amount: Column,
    into: str,
) -> DataFrame:
    """Sum of ``amount`` over the rows of the group ahead of each row.

    ``chunk`` is a column that rises with ``order`` and is never NULL; keys may be NULL.
    """
    sized = df.withColumn("_amount", amount.cast("long"))
    earlier = W.partitionBy(*keys).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    before = (
        sized.groupBy(*keys, chunk)
        .agg(F.sum("_amount").alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                F.col(chunk).alias("_same_chunk"), "_before")
    )
    same = F.col(chunk) == F.col("_same_chunk")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = W.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        sized.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
        .join(before, same)
        .withColumn(into, F.col("_before") + F.col("_inside"))
        .select(*df.columns, into)
    )
