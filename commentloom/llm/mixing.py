"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Each source's documents are shuffled, laid end to end and cut into blocks of equally many words; a
source that has to give more words than it holds is read again from the front, up to three times.
The van der Corput sequence visits the blocks of all sources: point i falls into one source's
share of the cumulative weights, and the r-th point of a source takes its r-th block. Any stretch
of the schedule thus holds the sources in nearly their target shares, and each source ends up with
exactly its target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.llm.hot import join_classes
from commentloom.llm.scratch import numbered, stored
from commentloom.operators.running import running_total

WORD = "[^\\x20\\x09-\\x0D]+"
BETWEEN = "[\\x20\\x09-\\x0D]*"
BLOCK_WORDS = 256
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
# Rows that are ordered by one task, about.
CHUNK_ROWS = 4096
SEED = "mix:"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size, weight and target of each source from (source, source_size).

    Sources in code point order, NULL last, weigh ``weights`` in turn and share the sum of all
    sizes. A target stops at ``most`` times the source's size and what is left over is shared again
    by weight. In the order of cap per weight the capped sources come first, so running sums find
    the final share. There is one row per source here, never per document.
    """
    all_rows = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("source_rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(turn, F.col("source_rank") % len(weights) + 1)
    )
    capped_first = W.orderBy("_ratio", "source_rank")
    shares = (
        ranked.withColumn("_cap", most * F.col("source_size"))
        .withColumn("_ratio", F.col("_cap").cast("double") / F.col("weight"))
        .withColumn("_before", F.coalesce(F.sum("_cap").over(capped_first.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_rest", F.sum("weight").over(capped_first.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_share", (F.sum("source_size").over(all_rows) - F.col("_before")).cast("double") / F.col("_rest"))
    )
    share = F.max(F.when(F.col("_ratio") > F.col("_share"), F.col("_share"))).over(all_rows)
    target = F.least(F.col("_cap").cast("double"), F.coalesce(share, F.lit(0.0)) * F.col("weight"))
    return shares.withColumn("target", target).select("source", "source_rank", "source_size", "weight", "target")


def word_count(text: Column) -> Column:
    """Words of a text, 0 for NULL.

    Each word, with the white space behind it, becomes one character and these are counted. ``regexp_count`` would
    list all words of a text first, which takes many times the memory of the text.
    """
    one_each = F.regexp_replace(F.ltrim(text, F.lit(" \t\n\x0b\f\r")), WORD + BETWEEN, ".")
    return F.coalesce(F.length(one_each), F.lit(0)).cast("long")


def _laid(
    docs: DataFrame, doc_id: str, text: str, source: str, block_words: int, weights: tuple[int, ...], most: int, carry: tuple[str, ...]
) -> tuple[DataFrame, int]:
    """Rows with their source's targets, their place among its words (_at) and its blocks; and the bits of a slot."""
    size = word_count(F.col(text))
    shuffled = F.md5(
        F.concat(
            F.lit(SEED), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"),
            F.md5(F.coalesce(F.col(text), F.lit(""))),
        )
    )
    rows = stored(
        numbered(
            docs.select(*carry, F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), shuffled.alias("_order"))
        ),
        "rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    # A source takes its target, to the word, in whole blocks but for the last.
    words = F.least(most * F.col("source_size"), F.floor(F.col("target") + 0.5))
    before = W.orderBy("source_rank").rowsBetween(W.unboundedPreceding, -1)
    shares = source_targets(sizes.select("source", "source_size"), weights, most)
    counted = sizes.select(F.col("source").alias("_counted"), "_rows")
    sources = stored(
        shares.join(counted, F.col("source").eqNullSafe(F.col("_counted")))
        .drop("_counted")
        .withColumn("_words", words)
        .withColumn("_blocks", F.ceil(F.col("_words") / block_words))
        .withColumn("_low", F.coalesce(F.sum("_blocks").over(before), F.lit(0))),
        "sources",
    )
    total = sources.agg(F.coalesce(F.sum("_blocks"), F.lit(0)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    named = sources.withColumnRenamed("source", "_name").drop("_rows")
    placed = rows.join(named, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    placed = placed.withColumn("_key", F.concat_ws(":", "source_rank", "_order"))
    # Equal rows lie next to one another; a run of them is one row of the first sum, however many they are.
    digits = max(3, math.ceil(math.log(max(total[1], 1) / CHUNK_ROWS, 16)) if total[1] > CHUNK_ROWS else 0)
    runs = placed.groupBy("_key", "source_rank", "_order", "size").agg(F.count(F.lit(1)).alias("_copies"))
    chunk = F.conv(F.substring("_order", 1, digits), 16, 10).cast("long")
    ahead = running_total(
        runs.withColumn("_chunk", chunk), ["source_rank"], "_chunk", ["_order"], F.col("_copies") * F.col("size"), "_ahead"
    )
    part = F.expr(f"row_id div {CHUNK_ROWS}")
    nth = running_total(placed.withColumn("_part", part), ["_key"], "_part", ["row_id"], F.lit(1), "_nth").drop("_part")
    laid = join_classes(nth, ahead.select("_key", "_ahead", "_copies"), "_key", "_copies")
    at = F.col("_ahead") + F.col("_nth") * F.col("size")
    return laid.withColumn("_at", at), max(1, (max(int(total[0]), 1) - 1).bit_length())


def mix_schedule(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The schedule: one row per slot and document in it.

    Columns: those to carry, row_id, doc_id, slot, source_rank, block, start and length in words, repeat. A slot without documents
    does not occur. NULL text has size 0; a document of size 0 is never scheduled. NULL is a source of its own. Repeated
    rows are documents of their own. The order within a source hangs on the doc_id and the text alone, so a rerun gives
    the same schedule. An empty table gives an empty schedule.
    """
    laid, bits = _laid(docs, doc_id, text, source, block_words, weights, most, carry)
    first = F.col("repeat") * F.col("source_size") + F.col("_at")
    return (
        laid.withColumn("repeat", F.explode(F.array(*[F.lit(r) for r in range(most)])))
        .withColumn("_from", first)
        .withColumn("_to", F.least(first + F.col("size"), F.col("_words")))
        .where("_from < _to")
        .withColumn("block", F.explode(F.expr(f"sequence(_from div {block_words}, (_to - 1) div {block_words})")))
        .withColumn("_start", F.greatest("_from", F.col("block") * block_words))
        .withColumn("_end", F.least("_to", (F.col("block") + 1) * block_words))
        .select(
            *carry, "row_id", "doc_id", F.expr(_slot("block", bits)).alias("slot"), "source_rank", "block", "repeat",
            (F.col("_start") - F.col("_from")).alias("start"),
            (F.col("_end") - F.col("_start")).alias("length"),
        )
    )


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The schedule by row: what it takes of each document, and where.

    Columns: those to carry, row_id, doc_id, source, size, source_size, target, taken (words, repeats counted), n_slots
    (slots that hold a part of the document, repeats counted) and slots (the first slot of each time it is taken, in
    order). Cases as in ``mix_schedule``; a document that is not taken has no slots.
    """
    laid, bits = _laid(docs, doc_id, text, source, block_words, weights, most, carry)
    for r in range(most):
        laid = laid.withColumn(f"_from{r}", F.col("_at") + r * F.col("source_size")).withColumn(
            f"_to{r}", F.greatest(F.col(f"_from{r}"), F.least(F.col(f"_from{r}") + F.col("size"), F.col("_words")))
        )
    times = range(most)
    taken = " + ".join(f"(_to{r} - _from{r})" for r in times)
    held = " + ".join(f"if(_to{r} > _from{r}, (_to{r} - 1) div {block_words} - _from{r} div {block_words} + 1, 0L)" for r in times)
    slots = ", ".join(f"if(_to{r} > _from{r}, {_slot(f'_from{r} div {block_words}', bits)}, NULL)" for r in times)
    return laid.select(
        *carry, "row_id", "doc_id", "source", "size", "source_size", "target",
        F.expr(taken).alias("taken"), F.expr(held).alias("n_slots"), F.expr(f"array_compact(array({slots}))").alias("slots"),
    )


def _slot(block: str, bits: int) -> str:
    """The slot of the source's block, as SQL: its place among the points of the sequence that fall into its share.

    Point i lies at i's bits back to front, and the source owns the stretch [_low, _low + _blocks). The slot's bits are found from
    the highest on: of the points that have the bits so far, those with a zero next come first, and how many of them lie in the stretch
    follows from the remainders of its ends.
    """
    ahead = "shiftright(_low + _blocks - 1 - s.low, k) - shiftright(_low - 1 - s.low, k)"
    return f"""aggregate(sequence(1, {bits}), named_struct('left', {block}, 'low', 0L, 'slot', 0L), (s, k) ->
        if(s.left < {ahead}, s, named_struct('left', s.left - ({ahead}), 'low', s.low + shiftleft(1L, k - 1),
          'slot', s.slot + shiftleft(1L, {bits} - k)))).slot"""
