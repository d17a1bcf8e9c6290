"""Packing token sequences by their length histogram, shortest pack first.

Documents are cut into pieces of at most one sequence. The histogram of piece lengths has at most
``sequence`` entries however many documents there are; lengths are placed longest first, each into
the least filled packing patterns that have room, and only counts of patterns are updated. The
patterns are joined back to the pieces by rank: the r-th piece of a length takes the r-th place
for that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.llm.scratch import numbered, stored
from commentloom.llm.tokens import tokenizer, vocabulary_path
from commentloom.operators.running import running_total

SEQUENCE = 1024
# Stated bound of the table of places that is sent to every task: about 10 MB.
BROADCAST_PLACES = 200_000


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(count, [(length, copies), ...]) of each packing pattern."""
    open_packs: dict[int, list[tuple[int, tuple]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in open_packs if r >= length), default=None)
            if room is None:
                # As many copies side by side as go into a new pack, then one pack with the rest.
                copies = capacity // length
                count, rest = divmod(left, copies)
                if count:
                    open_packs.setdefault(capacity - copies * length, []).append((count, ((length, copies),)))
                if rest:
                    open_packs.setdefault(capacity - rest * length, []).append((1, ((length, rest),)))
                break
            count, pattern = open_packs[room].pop()
            if not open_packs[room]:
                del open_packs[room]
            # Widest packs first, and as many copies as go in: the tail of short lengths is long.
            copies = min(room // length, -(-left // count))
            used = min(count, left // copies)
            left -= used * copies
            open_packs.setdefault(room - copies * length, []).append((used, pattern + ((length, copies),)))
            if used < count:
                open_packs.setdefault(room, []).append((count - used, pattern))
    patterns = [(count, list(p)) for packs in open_packs.values() for count, p in packs]
    return sorted(patterns, key=lambda x: x[1], reverse=True)


def token_pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
    vocabulary: str | None = None,
    end_id: int = 0,
    keep_ids: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of each piece, with its ids if wanted.

    A document is its ids and then ``end_id``. It is cut at every full sequence, so only its last
    piece is shorter. A NULL or empty text is the end id alone.
    """
    path = vocabulary or vocabulary_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        for batch in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for at, one in enumerate(batch.column("_text").to_pylist()):
                whole = encoder.encode(one or "") + end
                for first in range(0, len(whole), 4 * sequence):
                    piece = whole[first : first + 4 * sequence]
                    rows.append(at)
                    start.append(first // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(whole) // 4)
                    if keep_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype(np.int64))
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    return chosen.mapInArrow(cut, schema + (", ids array<bigint>" if keep_ids else ""))


def pack_pieces(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """The pieces with sequence_id and offset: where each one goes.

    Sequence ids run from 0 without gaps, and so do the places in a sequence. Pieces of one length
    are interchangeable. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    rows = stored(numbered(pieces, "_row"), "pieces").withColumn("_chunk", F.shiftright("_row", 16))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranked = running_total(rows, ["length"], "_chunk", ["_row"], F.lit(1), "_rank")
    places, count = _places(spark, shortest_pack_first(histogram, sequence))
    place = F.col("_rank") - F.col("_low")
    return (
        ranked.join(F.broadcast(places) if count <= BROADCAST_PLACES else places, "length")
        .where("_rank >= _low AND _rank < _high")
        .withColumn("sequence_id", F.col("_sequence") + place % F.col("_count"))
        .withColumn("offset", F.col("_offset") + F.floor(place / F.col("_count")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def _places(spark: SparkSession, patterns: list) -> tuple[DataFrame, int]:
    """Per pattern and length: which ranks of that length go where."""
    rows, used, base = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            low = used.get(length, 0)
            used[length] = low + count * copies
            rows.append((length, low, used[length], base, count, offset))
            offset += length * copies
        base += count
    columns = list(zip(*rows)) or [()] * 6
    names = ["length", "_low", "_high", "_sequence", "_count", "_offset"]
    table = pa.table([pa.array(c, pa.int64()) for c in columns], names=names)
    return spark.createDataFrame(table), len(rows)


def pack_documents(docs: DataFrame, sequence: int = SEQUENCE, **options) -> DataFrame:
    """The pieces of all documents with their places, as ``token_pieces`` and ``pack_pieces`` give them.

    NULL and empty texts are one token, texts of any length are encoded whole and cut into pieces, repeated rows and
    rows of one or no doc_id are documents of their own, other columns are not looked at. An empty table gives an empty result.
    """
    return pack_pieces(token_pieces(docs, sequence=sequence, **options), sequence)
