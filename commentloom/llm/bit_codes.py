"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is rotated into a longer space by a fixed random matrix, and the signs there are its
code: packed bits, its length and the product of its direction with its code. From these the inner product with
a query is estimated without bias, and the part of the direction that the code leaves out bounds
the error. A task holds one block of codes and lets all queries pass: where the upper bound reaches the
best lower bounds so far, the vector is measured exactly in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.llm.hot import SALTS, join_classes
from commentloom.llm.scratch import numbered, stored
from commentloom.llm.whitening import usable

NEAREST = 20
# Length of a code; longer vectors get one bit per entry, in whole words of 64.
LEAST_BITS = 512
# Width of the error bounds in standard deviations of the rotated rest: a true neighbour right at the
# border is passed over with a probability of 0.0014 at most.
SIGMAS = 3.0
# Bound of the vectors and codes that a task holds, and the least rows of a block when more tasks are free.
BLOCK_BYTES = 128 << 20
LEAST_BLOCK = 2048
# Estimates worked out at once: codes by queries; and pairs measured at once.
CODES_AT_ONCE, QUERIES_AT_ONCE, PAIRS_AT_ONCE = 4096, 512, 1 << 16


def code_bits(width: int) -> int:
    return max(LEAST_BITS, -(-width // 64) * 64)


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    """Orthonormal rows that turn a vector of this length into ``code_bits`` numbers, the same everywhere."""
    square = np.random.default_rng(width).standard_normal((code_bits(width), width))
    return np.linalg.qr(square)[0].T.astype(np.float32)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, length, product of direction and code) of the rows of a matrix without zero rows."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    lengths = np.linalg.norm(scaled, axis=1)
    turned = (scaled / lengths[:, None]).astype(np.float32) @ rotation(vectors.shape[1])
    products = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1), lengths * largest[:, 0], products.astype(np.float64)


def estimate(
    codes: np.ndarray, lengths: np.ndarray, products: np.ndarray, queries: np.ndarray, sigmas: float = SIGMAS
) -> tuple[np.ndarray, np.ndarray]:
    """(estimated inner products, codes by queries; bound of their errors by code), both for queries brought to unit length."""
    bits = codes.shape[1] * 8
    sizes = np.linalg.norm(queries, axis=1, keepdims=True)
    turned = (queries / sizes).astype(np.float32) @ rotation(queries.shape[1])
    # Twice the sum over the set bits less the sum over all.
    found = np.unpackbits(codes, axis=1).astype(np.float32) @ (2 * turned.T)
    found -= turned.sum(axis=1)
    found *= (lengths / products / np.sqrt(bits))[:, None].astype(np.float32)
    error = np.sqrt(np.maximum(1 - products**2, 0)) / products * sigmas / np.sqrt(bits - 1) + 1e-5
    return found, error * lengths


class Block:
    """Vectors of one length with their codes; ``best`` finds the nearest of a batch of queries."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, vectors: np.ndarray):
        self.ids, self.least, self.vectors = ids, least, vectors
        self.codes, self.lengths, self.products = encode(vectors)

    def best(
        self, queries: np.ndarray, nearest: int, sigmas: float = SIGMAS
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the nearest rows of each query, ties to the smaller id."""
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        sizes = np.linalg.norm(queries, axis=1)
        for start in range(0, len(self.ids), CODES_AT_ONCE):
            part = slice(start, start + CODES_AT_ONCE)
            found, error = estimate(self.codes[part], self.lengths[part], self.products[part], queries, sigmas)
            if start == 0:
                # The best by estimate are measured first: their scores make the first border.
                first = np.partition(found, max(len(found) - nearest, 0), axis=0)[max(len(found) - nearest, 0)]
                row, query = np.nonzero(found >= first)
                held = self._nearest(held, query, row, queries, nearest)
                found[row, query] = -np.inf
            # A full list's last is the border, in units of the query's length.
            border = np.full(len(queries), np.inf)
            np.minimum.at(border, held[0], held[2])
            border[np.bincount(held[0], minlength=len(queries)) < nearest] = -np.inf
            found += error[:, None].astype(np.float32)
            row, query = np.nonzero((found >= (border / sizes).astype(np.float32)) & (found > -np.inf))
            held = self._nearest(held, query, row + start, queries, nearest)
        return held

    def _nearest(self, held, query, row, queries, nearest):
        scores = np.empty(len(row))
        for start in range(0, len(row), PAIRS_AT_ONCE):
            part = slice(start, start + PAIRS_AT_ONCE)
            # From the first entry to the last, so that a pair's score does not hang on the rows around it.
            scores[part] = np.cumsum(self.vectors[row[part]] * queries[query[part]], axis=1)[:, -1]
        query, row, scores = (np.concatenate(p) for p in zip(held, (query, row, scores)))
        order = np.lexsort((self.least[row], -scores, query))
        query, row, scores = query[order], row[order], scores[order]
        first = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        keep = place < nearest
        return query[keep], row[keep], scores[keep]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def nearest_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    every: int = 20,
    nearest: int = NEAREST,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows of each query by inner product.

    Queries are the rows whose id is divisible by ``every``; the candidates of a query are all other rows of its
    vector's length. Nearest first, ties to the smaller id. Rows with a NULL id, or with a vector that is NULL, empty, zero or has a
    NULL or non-finite entry, take no part. Rows that are equal in id and vector are one row; rows that share an
    id but not the vector are rows of their own. With fewer candidates all are returned. Scores beyond the range of a double are infinite. Other
    columns are ignored. An empty table gives an empty result.
    """
    id_type = vectors.schema[vec_id].dataType.simpleString()
    some = F.exists("embedding", lambda x: x != 0)
    rows = stored(
        vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
        .where(F.col("vec_id").isNotNull() & usable("embedding") & F.coalesce(some, F.lit(False)))
        # Equal vectors meet by a digest of their entries' shortest exact decimals.
        .withColumn("key", F.unhex(F.sha2(F.concat_ws(",", F.col("embedding").cast("array<string>")), 256))),
        "vectors",
    )
    is_query = F.col("vec_id") % every == 0
    classes = stored(
        numbered(
            rows.groupBy("key").agg(
                F.first("embedding").alias("embedding"), F.min("vec_id").alias("least"),
                F.count(F.lit(1)).alias("copies"), F.count_if(is_query).alias("queries"),
            ),
            "cls",
        ),
        "classes",
    )
    found = _found(classes, id_type, nearest + 1, sigmas)
    # Of equal vectors only those with the smallest ids can be among the nearest.
    narrow = join_classes(rows.select("vec_id", "key"), classes.select("key", "cls", "copies"), "key", "copies")
    narrow = stored(narrow.select("cls", "vec_id").distinct(), "members")
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    members = narrow.withColumn("_salt", salt)
    for by in (["cls", "_salt"], ["cls"]):
        place = F.row_number().over(W.partitionBy(*by).orderBy("vec_id"))
        members = members.withColumn("_place", place).where(F.col("_place") <= nearest + 1).drop("_place")
    by_score = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (
        found.join(members.select("cls", "vec_id"), "cls")
        .withColumn("_place", F.row_number().over(by_score))
        .where(F.col("_place") <= nearest + 1)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("_place", "vec_id", "cls", "score"))).alias("near"))
        .join(classes.where("queries > 0").select(F.col("cls").alias("query"), "queries"), "query")
    )
    asked = narrow.where(is_query).select(F.col("cls").alias("query"), F.col("vec_id").alias("query_id"))
    # The query itself stands in its list at one place at most.
    others = F.filter("near", lambda n: (n["vec_id"] != F.col("query_id")) | (n["cls"] != F.col("query")))
    return (
        join_classes(asked, lists, "query", "queries")
        .select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("_at", "_row"))
        .select("query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_row.vec_id"), F.col("_row.score"))
    )


def _found(classes: DataFrame, id_type: str, nearest: int, sigmas: float) -> DataFrame:
    """(query, cls, score): per query class the nearest classes of each block."""
    spark = classes.sparkSession
    width = F.size("embedding")
    sizes = classes.groupBy(width.alias("width")).agg(F.count(F.lit(1)).alias("n"))
    tasks = spark.sparkContext.defaultParallelism
    per_block = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (F.col("width") * 8 + F.greatest(F.lit(LEAST_BITS), F.col("width")) / 8)))
    even = F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.col("n") / tasks))
    blocks = sizes.withColumn("blocks", F.ceil(F.col("n") / F.least(per_block, even)).cast("long"))
    wide = classes.withColumn("width", width).join(blocks, "width")
    sides = wide.select(
        "width", F.pmod(F.xxhash64("cls"), "blocks").alias("block"), F.lit(0).alias("side"), "cls", "least", "embedding"
    ).union(
        wide.where("queries > 0").select(
            "width", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), F.lit(1), "cls", "least", "embedding"
        )
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by width, block and side: the block's vectors, then the queries.
        current, block, parts = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("width", "block", "side")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                run = batch.slice(start, end - start)
                wide, where, side = keys[:, start].tolist()
                if (wide, where) != current:
                    current, block, parts = (wide, where), None, []
                ids = run.column("cls").to_numpy()
                matrix = _matrix(run.column("embedding"), wide)
                if side == 0:
                    parts.append((ids, run.column("least").to_numpy(), matrix))
                    continue
                if block is None:
                    if not parts:
                        continue
                    block, parts = Block(*(np.concatenate(p) for p in zip(*parts))), []
                for at in range(0, len(ids), QUERIES_AT_ONCE):
                    few = slice(at, at + QUERIES_AT_ONCE)
                    query, row, score = block.best(matrix[few], nearest, sigmas)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[few][query]), pa.array(block.ids[row]), pa.array(block.least[row]), pa.array(score)],
                        names=["query", "cls", "least", "score"],
                    )

    near = (
        sides.repartition("width", "block")
        .sortWithinPartitions("width", "block", "side")
        .mapInArrow(search, f"query bigint, cls bigint, least {id_type}, score double")
    )
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "least"))
    return stored(near.withColumn("_place", place).where(F.col("_place") <= nearest).select("query", "cls", "score"), "near")
