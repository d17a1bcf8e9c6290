"""Exact dedup by naming blocks.

A text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted and numbered, and
a block's number is its name. Then adjacent names are paired and distinct pairs are numbered in
turn, until one name is left per text. Two texts of as many blocks have the same last name exactly
when they are equal, byte by byte.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.llm.hot import join_classes
from commentloom.llm.scratch import forget, numbered, stored

BLOCK_BYTES = 1024
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; NULL becomes the empty text."""
    whole = F.coalesce(text, F.lit(""))
    ascii_only = F.length(whole) == F.octet_length(whole)
    return F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, UPPER.lower()))


def exact_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row, and the columns to ``carry``.

    Texts are equal when they are identical after lower-casing A-Z. Of equal texts the row with
    the largest doc_id stays; a NULL doc_id is the smallest, and of rows that share text and
    doc_id one stays. NULL and empty texts are one and the same text. An empty table gives an
    empty result; other columns of the table are not looked at.
    """
    texts = docs.select(*carry, F.col(doc_id).alias("doc_id"), lower_ascii(F.col(text)).alias("_text"))
    rows = stored(
        numbered(
            texts.select(
                *carry,
                "doc_id",
                F.sha2("_text", 256).alias("text_sha256"),
                F.transform(_starts(block_bytes), lambda i: F.xxhash64(_block(i, block_bytes))).alias("_hashes"),
            )
        ),
        "rows",
    )
    identities = _identities(rows, _name_blocks(texts, rows, block_bytes))
    marked = rows.select(*carry, "row_id", "doc_id", "text_sha256").join(identities, "row_id").withColumn(
        "_identity", F.struct("_level", "_name")
    )
    groups = stored(
        marked.groupBy("_identity").agg(
            F.max(F.struct("doc_id", (-F.col("row_id")).alias("_first"))).alias("_keep"),
            F.count(F.lit(1)).alias("group_size"),
        ),
        "groups",
    )
    return join_classes(marked, groups, "_identity", "group_size").select(
        *carry,
        "doc_id",
        F.col("_keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == -F.col("_keep._first")).alias("kept"),
        "text_sha256",
        "row_id",
    )


def _starts(size: int) -> Column:
    last = F.floor(F.greatest(F.octet_length("_text") - 1, F.lit(0)) / size)
    return F.sequence(F.lit(0).cast("int"), last.cast("int"))


def _block(number: Column, size: int) -> Column:
    # Cutting bytes costs the length of the block; cutting characters would restart at the front.
    return F.substring(F.col("_text").cast("binary"), number * size + 1, F.lit(size))


def _name_blocks(texts: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(row_id, pos, last, name) of every block.

    Distinct blocks meet once, combined ahead of the shuffle, and are numbered in sorted order.
    Names travel back to the texts by the block's hash, which moves no text. A hash that stands
    for several blocks is told by counting, and its blocks are then named by their bytes.
    """
    blocks = texts.select(F.explode(F.transform(_starts(size), lambda i: _block(i, size))).alias("_block"))
    distinct = blocks.select(F.xxhash64("_block").alias("_hash"), "_block").distinct()
    names = stored(
        numbered(distinct.sortWithinPartitions("_block"), "name").select("_hash", "name"), "names"
    )
    places = rows.select(
        "row_id", (F.size("_hashes") - 1).alias("last"), F.posexplode("_hashes").alias("pos", "_hash")
    )
    shared = names.groupBy("_hash").count().where("count > 1").select("_hash")
    if shared.isEmpty():
        return places.join(names, "_hash").select("row_id", "pos", "last", "name")
    return _named_by_bytes(texts, rows, places, names, shared, size)


def _named_by_bytes(texts, rows, places, names, shared, size) -> DataFrame:
    """The same where some hash stands for several blocks: those texts are matched by content."""
    plain = places.join(shared, "_hash", "left_anti").join(names, "_hash")
    met = (
        texts.select("doc_id", F.sha2("_text", 256).alias("text_sha256"),
                     F.posexplode(F.transform(_starts(size), lambda i: _block(i, size))).alias("pos", "_block"))
        .withColumn("_hash", F.xxhash64("_block"))
        .join(shared, "_hash")
    )
    # Ahead of all other names, so that the two kinds cannot be confused.
    again = stored(
        numbered(met.select("_block").distinct().sortWithinPartitions("_block"), "_n")
        .select("_block", (-1 - F.col("_n")).alias("name")),
        "names",
    )
    found = met.join(again, "_block").select("doc_id", "text_sha256", "pos", "name").distinct()
    keyed = places.join(shared, "_hash").join(rows.select("row_id", "doc_id", "text_sha256"), "row_id")
    same = (
        keyed["doc_id"].eqNullSafe(found["doc_id"])
        & (keyed["text_sha256"] == found["text_sha256"])
        & (keyed["pos"] == found["pos"])
    )
    by_bytes = keyed.join(found, same).select(
        keyed["row_id"], keyed["pos"], keyed["last"], found["name"]
    )
    return plain.select("row_id", "pos", "last", "name").union(by_bytes)


def _identities(rows: DataFrame, level: DataFrame) -> DataFrame:
    """(row_id, _level, _name): the last name of each text and how many rounds led to it."""
    longest = rows.agg(F.coalesce(F.max(F.size("_hashes")), F.lit(1)).alias("n")).first()["n"]
    level = stored(level, "level")
    done = [_finished(level, 0)]
    for number in range(1, (longest - 1).bit_length() + 1):
        even = F.col("pos") % 2 == 0
        pairs = (
            level.where("last > 0")
            .groupBy("row_id", "last", F.floor(F.col("pos") / 2).alias("pos"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("_left"),
                # The last block of an odd number stands alone.
                F.max(F.when(~even, F.col("name"))).alias("_right"),
            )
        )
        pairs = stored(pairs, "pairs")
        names = stored(
            numbered(
                pairs.select("_left", "_right").distinct().sortWithinPartitions("_left", "_right"),
                "name",
            ),
            "names",
        ).withColumnsRenamed({"_left": "_l", "_right": "_r"})
        same = (F.col("_left") == F.col("_l")) & F.col("_right").eqNullSafe(F.col("_r"))
        level = stored(
            pairs.join(names, same).select(
                "row_id", F.col("pos").cast("int"), F.floor(F.col("last") / 2).cast("int").alias("last"), "name"
            ),
            "level",
        )
        forget(pairs)
        done.append(_finished(level, number))
    return reduce(DataFrame.union, done)


def _finished(level: DataFrame, number: int) -> DataFrame:
    return level.where("last = 0").select(
        "row_id", F.lit(number).alias("_level"), F.col("name").alias("_name")
    )
