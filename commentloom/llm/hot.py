"""Joining many rows to one row per class where a class may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A class is hot when it holds more than this part of all rows, so at most that many classes are hot.
HOT_PART = 1000
SALTS = 64


def join_classes(rows: DataFrame, classes: DataFrame, key: str, copies: str) -> DataFrame:
    """Inner join of ``rows`` with ``classes``, one row per ``key`` with its number of rows, ``copies``.

    The rows of a hot class are dealt over many tasks and its class row is copied to each of them.
    The list of hot keys is broadcast: it has fewer than ``HOT_PART`` rows, whatever the input is.
    """
    total = classes.agg(F.coalesce(F.sum(copies), F.lit(0))).first()[0]
    is_hot = F.col(copies) * HOT_PART > F.lit(int(total))
    hot = classes.where(is_hot).select(key, F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.monotonically_increasing_id() % SALTS).otherwise(0).cast("int")
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_hot")
    spread = classes.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, F.lit(SALTS - 1)).otherwise(F.lit(0))))
    )
    return dealt.join(spread, [key, "_salt"]).drop("_salt")
