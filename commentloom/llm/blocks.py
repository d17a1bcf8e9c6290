"""Comparing the members of groups in pairs of blocks, so that no task ever holds a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.scratch import stored

SMALL = -1


def block_pairs(
    members: DataFrame, max_rows: int, max_weight: int, part: bool = False
) -> DataFrame:
    """Copies of the rows of ``members``, one per pair of blocks that the row belongs to.

    ``members`` has ``group`` and ``id`` (longs) and ``weight``; rows of one group meet. With
    ``part``, a column ``part`` (a long of 0 or more) names rows that need not meet each other:
    a part larger than half a block has blocks of its own, which meet the other blocks only.
    A block has about ``max_rows`` rows and ``max_weight`` of weight. Added are ``pair`` and
    ``side`` (0 or 1; a block that meets itself is on side 0 alone).
    """
    keyed = members if part else members.withColumn("part", F.lit(SMALL).cast("bigint"))
    sizes = keyed.groupBy("group", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("weight").cast("bigint")).alias("w")
    )
    large = (F.col("n") * 2 > max_rows) | (F.col("w") * 2 > max_weight)
    sizes = stored(sizes.withColumn("own", F.when(large, F.col("part")).otherwise(F.lit(SMALL))), "sizes")
    blocks = (
        sizes.groupBy("group", "own")
        .agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
        .withColumn("buckets", F.greatest(F.ceil(F.col("n") / max_rows), F.ceil(F.col("w") / max_weight), F.lit(1)))
    )
    single = blocks.select("group", "own", F.explode(F.expr("sequence(0L, buckets - 1)")).alias("bucket"))
    left = single.toDF("group", "own1", "b1")
    right = single.toDF("group", "own2", "b2")
    ordered = F.struct("own1", "b1") <= F.struct("own2", "b2")
    apart = (F.col("own1") != F.col("own2")) | (F.col("own1") == SMALL)
    pairs = stored(
        left.join(right, "group").where(ordered & apart).withColumn("pair", F.monotonically_increasing_id()),
        "pairs",
    )
    own_block = (F.col("own1") == F.col("own2")) & (F.col("b1") == F.col("b2"))
    sides = pairs.selectExpr("group", "own1 AS own", "b1 AS bucket", "pair", "0 AS side").union(
        pairs.where(~own_block).selectExpr("group", "own2 AS own", "b2 AS bucket", "pair", "1 AS side")
    )
    placed = (
        keyed.join(sizes.select("group", "part", "own"), ["group", "part"])
        .join(blocks.select("group", "own", "buckets"), ["group", "own"])
        .withColumn("bucket", F.pmod(F.xxhash64("id"), F.col("buckets")))
    )
    return placed.join(sides, ["group", "own", "bucket"]).select(*keyed.columns, "pair", "side")


def map_runs(
    df: DataFrame, key: str, run: Callable[[pa.Table], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply a function to the rows of each key, which have to be few enough for a task's memory.

    The rows are dealt out by key and sorted in Spark; a task reads run after run.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)]):
                if current is not None and keys[start] != current:
                    found = run(pa.Table.from_batches(held))
                    if found is not None:
                        yield found
                    held = []
                current = keys[start]
                held.append(batch.slice(start, end - start))
        if held:
            found = run(pa.Table.from_batches(held))
            if found is not None:
                yield found

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(work, schema)
