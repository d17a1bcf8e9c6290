"""Near-duplicate documents by an inverted join over signature coordinates.

A document's signature holds the least hash of its shingle set under many hash functions. Groups of
three such values make one coordinate, and a document is posted under each (coordinate, value).
Two similar sets share at least ``least_matches`` coordinates, so it is enough to post a document
under its rarest ones (prefix), and documents with too few shared values are skipped. Pairs that
meet are counted over the base values, those above the match threshold are confirmed on the full
shingle sets, and confirmed links are joined into components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.llm.blocks import block_pairs, map_runs
from commentloom.llm.components import connected_components
from commentloom.llm.scratch import forget, numbered, stored
from commentloom.llm.shingles import mixed, shingle_hashes

COORDINATES = 32
ROWS = 3
MISS = 1e-5
# Rows of (number, number, digest) that are sent to every task at most: about 40 MB.
BROADCAST_ROWS = 400_000
# Documents with this share of equal base values are neighbours, linked or not.
NEAR_SHARE = 0.4
# Lists longer than this are cut by a second coordinate before their members are paired.
LONG_LIST = 128
# Of a block of documents that are compared with one another.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 200_000
MATRIX_COLUMNS = 4096


def least_matches(n: int, p: float, miss: float) -> int:
    """Largest t with P(fewer than t of n coordinates match) <= miss, at match rate p; 1 at least."""
    below, t = 0.0, 0
    while t < n:
        below += math.comb(n, t) * p**t * (1 - p) ** (n - t)
        if below > miss:
            break
        t += 1
    return max(1, t)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    percent: int = 85,
    coordinates: int = COORDINATES,
    miss: float = MISS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """row_id, doc_id, n_shingles, component_id, kept and shown of every row, and columns to ``carry``.

    Two documents are linked when 100 * |A and B| >= percent * |A or B| on their shingle sets. A
    signature misses a pair right at the threshold with probability ``miss`` at most, at either of
    its two thresholds; every link is confirmed on the full sets. component_id is the smallest doc_id among the documents reachable by
    links. Documents without words are linked with nothing, so each is its own component. NULL
    text counts as empty. A NULL doc_id is never the smallest unless the component has no other.
    ``kept`` marks doc_id = component_id (false for NULL); with repeated doc_ids it marks each of
    these rows; ``shown`` marks exactly one row of each component. An empty table gives an empty result, other columns are not looked at.
    """
    texts = docs.select(
        *carry, F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    ).withColumn("_md5", F.unhex(F.md5("_text")))
    rows = stored(numbered(_signed(texts, width, coordinates * ROWS, carry)), "signatures")
    classes = stored(_classes(rows), "classes")
    links = _links(texts, rows, classes, width, percent, coordinates, miss)
    return _result(rows, classes, links, carry)


def _signed(texts: DataFrame, width: int, n_hashes: int, carry: tuple[str, ...]) -> DataFrame:
    """Per row: size and digest of its shingle set, and its base signature (32 bits each)."""
    factors = mixed(np.arange(1, n_hashes + 1, dtype=np.uint64)) | np.uint64(1)
    shifts = mixed(np.arange(1, n_hashes + 1, dtype=np.uint64) + np.uint64(1 << 32))

    def signature(found: np.ndarray) -> bytes:
        least = np.full(n_hashes, np.iinfo(np.uint64).max, dtype=np.uint64)
        # Blocks bound the memory of very long texts.
        for start in range(0, len(found), 4096):
            block = found[start : start + 4096]
            np.minimum(least, (factors[:, None] * block + shifts[:, None]).min(axis=1), out=least)
        return (least >> np.uint64(32)).astype("<u4").tobytes()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, signatures = [], [], [], []
            for one in batch.column("_text"):
                found = shingle_hashes(one.as_buffer().to_pybytes(), width)
                sizes.append(len(found))
                # Two order-free sums of spread values tell sets apart.
                first.append(int(mixed(found).sum(dtype=np.uint64).astype(np.int64)))
                second.append(int(mixed(found ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).astype(np.int64)))
                signatures.append(signature(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], batch.column("doc_id"), batch.column("_md5"), pa.array(sizes, pa.int64()),
                 pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(signatures, pa.binary())],
                names=[*carry, "doc_id", "_md5", "n_shingles", "_d1", "_d2", "_signature"],
            )

    kinds = "".join(f"`{c}` {texts.schema[c].dataType.simpleString()}, " for c in (*carry, "doc_id"))
    return texts.mapInArrow(
        sign, f"{kinds}_md5 binary, n_shingles bigint, _d1 bigint, _d2 bigint, _signature binary"
    )


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct non-empty shingle set: its smallest doc_id and one row that shows it."""
    sets = (
        rows.where("n_shingles > 0")
        .groupBy("n_shingles", "_d1", "_d2")
        .agg(
            F.min("row_id").alias("cls"),
            # NULL ids come last.
            F.min(F.struct(F.isnull("doc_id").alias("_none"), "doc_id", "row_id")).alias("_least"),
        )
    )
    shown = rows.select(
        F.col("row_id").alias("cls"), F.col("doc_id").alias("_shown"), "_md5", "_signature"
    )
    return sets.join(shown, "cls")


def _links(texts, rows, classes, width, percent, coordinates, miss) -> DataFrame:
    rate = percent / 100
    least = least_matches(coordinates, rate**ROWS, miss)
    least_base = least_matches(coordinates * ROWS, rate, miss)
    prefix = stored(_prefix(classes, coordinates, least), "postings")

    # Texts that any pair may need are fetched once, whatever the number of rounds.
    fetched = _fetched(prefix.select("cls").distinct(), texts, classes)

    # First the components of a list meet through one member each: as many pairs as components.
    tried = links = None
    while True:
        found = None if links is None else stored(connected_components(links), "components")
        pairs = _counted(_stars(prefix, found), classes, least_base, percent, near=True)
        fresh = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        more = stored(_confirmed(fresh.where("enough").drop("enough"), fetched, width, percent), "links")
        # Stored as one, so that plans do not grow with the rounds.
        tried = fresh if tried is None else stored(tried.union(fresh), "tried")
        links = more if links is None else stored(links.union(more), "links")
        if more.isEmpty():
            break
    # Documents that were near one another, linked or not, form a neighbourhood. Inside one, all
    # members of different components are compared, in blocks; between two, the pairs of lists.
    if found is None:
        found = connected_components(links)
    near = stored(connected_components(tried.select("a", "b")), "components")
    inside = stored(_within(near, found, fetched, classes, width, percent), "links")
    rest = stored(_counted(_apart(prefix, near, least, percent), classes, least_base, percent), "pairs")
    across = stored(_confirmed(rest, fetched, width, percent), "links")
    forget(prefix)
    forget(fetched)
    return links.union(inside).union(across)


def _stars(prefix: DataFrame, components: DataFrame | None) -> DataFrame:
    """Pairs of each list's most central document with the most central one of each other component.

    The document that shares most values with others is close to what a group of near copies
    was made from, so it links to more of them than any other.
    """
    placed = prefix.select("key", "_central", "cls")
    if components is None:
        members = placed
    else:
        members = (
            placed.join(components.withColumnRenamed("node", "cls"), "cls", "left")
            .groupBy("key", F.coalesce("component", "cls").alias("comp"))
            .agg(F.max(F.struct("_central", "cls")).alias("_m"))
            .select("key", "_m._central", "_m.cls")
        )
    heads = members.groupBy("key").agg(F.max(F.struct("_central", "cls")).alias("_head"))
    return (
        members.join(heads.select("key", F.col("_head.cls").alias("_head")), "key")
        .where("cls <> _head")
        .select(F.greatest("cls", "_head").alias("a"), F.least("cls", "_head").alias("b"))
        .distinct()
    )


def _prefix(classes: DataFrame, coordinates: int, least: int) -> DataFrame:
    """(key, cls, n_shingles, values) of the postings that can bring similar documents together.

    Of the coordinates ordered by list length a document needs the first K - t + 1: two documents
    that share t of K values share one of those. Values that no other document has come first
    in that order, so of the c shared values of a document the c - t + 1 rarest remain, and one
    with fewer than t is dropped.
    """
    words = ROWS * 4
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(coordinates - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("_signature"), i * words + 1, F.lit(words))),
    )
    postings = classes.select("cls", "n_shingles", F.explode(keys).alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("_length")).where("_length > 1")
    mine = W.partitionBy("cls")
    return (
        postings.join(shared, "key")
        .withColumn("_rank", F.row_number().over(mine.orderBy("_length", "key")))
        .withColumn("_shared", F.count(F.lit(1)).over(mine))
        .withColumn("_central", F.sum("_length").over(mine))
        .withColumn("_all", F.collect_list("key").over(mine))
        .where(F.col("_rank") <= F.col("_shared") - (least - 1))
        .select("key", "cls", "n_shingles", "_central", F.array_sort("_all").alias("_all"))
    )


def _similar_sizes(small: Column, large: Column, percent: int) -> Column:
    return (100 * small >= percent * large) & (100 * large >= percent * small)


def _counted(
    pairs: DataFrame, classes: DataFrame, least_base: int, percent: int, near: bool = False
) -> DataFrame:
    """Pairs whose base signatures agree in enough places and whose sizes allow the similarity.

    With ``near``, also those that come close to it, and whether they are ``enough``.
    """
    side = classes.select("cls", "n_shingles", "_signature")
    met = pairs.join(side.toDF("a", "_na", "_sa"), "a").join(side.toDF("b", "_nb", "_sb"), "b")
    allowed = _similar_sizes(F.col("_na"), F.col("_nb"), percent)
    if not near:
        met = met.where(allowed)
    met = met.select("a", "b", "_sa", "_sb", allowed.alias("_allowed"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u4").reshape(batch.num_rows, -1)
                    for c in ("_sa", "_sb")
                )
                same = (left == right).sum(axis=1)
                enough = pa.array((same >= least_base) & batch.column("_allowed").to_numpy(zero_copy_only=False))
                if near:
                    close = pa.array(same >= NEAR_SHARE * left.shape[1])
                    whole = pa.RecordBatch.from_arrays(
                        [batch.column("a"), batch.column("b"), enough], names=["a", "b", "enough"]
                    )
                    yield whole.filter(close)
                else:
                    yield batch.select(["a", "b"]).filter(enough)

    return met.mapInArrow(count, "a bigint, b bigint" + (", enough boolean" if near else ""))


def _fetched(wanted: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, _text) of the wanted classes."""
    named = stored(
        wanted.join(classes.select("cls", "_shown", F.col("_md5").alias("_want")), "cls"), "wanted"
    )
    same = F.col("doc_id").eqNullSafe(F.col("_shown")) & (F.col("_md5") == F.col("_want"))
    few = named.count() <= BROADCAST_ROWS
    return stored(
        texts.join(F.broadcast(named) if few else named, same).select("cls", "_text").dropDuplicates(["cls"]),
        "texts",
    )


def _set_of(text: pa.StringScalar, width: int) -> np.ndarray:
    return shingle_hashes(text.as_buffer().to_pybytes(), width)


def _confirmed(pairs: DataFrame, fetched: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    both = pairs.join(fetched.toDF("a", "_ta"), "a").join(fetched.toDF("b", "_tb"), "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_set = None, None
        for batch in batches:
            kept = []
            heads = batch.column("b").to_pylist()
            for at in range(batch.num_rows):
                if heads[at] != head:
                    head, head_set = heads[at], _set_of(batch.column("_tb")[at], width)
                one = _set_of(batch.column("_ta")[at], width)
                common = len(np.intersect1d(one, head_set, assume_unique=True))
                kept.append(100 * common >= percent * (len(one) + len(head_set) - common))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return both.mapInArrow(confirm, "a bigint, b bigint")


def _within(near: DataFrame, components: DataFrame, fetched, classes, width: int, percent: int) -> DataFrame:
    """Links between different components of one neighbourhood, one per two components and block.

    The neighbourhoods that are one component are done. The others are compared in pairs of
    blocks on the full sets; a large component's blocks meet only the blocks of others, and no pair
    leaves a task unless it links two components.
    """
    placed = (
        near.select(F.col("node").alias("cls"), F.col("component").alias("group"))
        .join(components.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("part", F.coalesce("component", "cls"))
    )
    split = placed.groupBy("group").agg(F.min("part").alias("_p1"), F.max("part").alias("_p2")).where("_p1 <> _p2")
    members = stored(
        placed.join(split.select("group"), "group")
        .join(classes.select("cls", F.col("n_shingles").alias("weight")), "cls")
        .select("group", "part", F.col("cls").alias("id"), "weight"),
        "members",
    )
    if members.isEmpty():
        return members.select(F.col("id").alias("a"), F.col("id").alias("b"))
    met = block_pairs(members, BLOCK_ROWS, BLOCK_SHINGLES, part=True)
    met = met.join(fetched.withColumnRenamed("cls", "id"), "id").select("pair", "side", "id", "part", "_text")

    def compare(rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.combine_chunks()
        sets = [_set_of(t, width) for t in rows.column("_text")]
        side = rows.column("side").to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left):
            return None
        if not len(right):
            right = left
        part, ids = rows.column("part").to_numpy(), rows.column("id").to_numpy()
        sizes = np.array([len(s) for s in sets])
        common = _common(sets, left, right)
        linked = 100 * common >= percent * (sizes[left][:, None] + sizes[right][None, :] - common)
        linked &= part[left][:, None] != part[right][None, :]
        i, j = np.nonzero(linked)
        if not len(i):
            return None
        # One link joins two components as well as many.
        two = np.stack([part[left[i]], part[right[j]]])
        _, first = np.unique(two, axis=1, return_index=True)
        a, b = ids[left[i[first]]], ids[right[j[first]]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"]
        )

    return map_runs(met, "pair", compare, "a bigint, b bigint").distinct()


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of all intersections of the left with the right sets, by products of 0/1 matrices."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # only these can be in two sets
    column = np.cumsum(shared) - 1
    used = shared[place]
    owner, column = owner[used], column[place[used]]
    common = np.zeros((len(left), len(right)), dtype=np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(shared.sum()), MATRIX_COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + MATRIX_COLUMNS])
        table = np.zeros((len(sets), MATRIX_COLUMNS), dtype=np.float32)
        table[owner[lo:hi], column[lo:hi] - start] = 1
        common += (table[left] @ table[right].T).astype(np.int64)
    return common


def _apart(prefix: DataFrame, near: DataFrame, least: int, percent: int) -> DataFrame:
    """Pairs of one list that lie in different neighbourhoods.

    Members of a long list are posted again under pairs of values: sharing t values, two of them
    share t - 1 besides this one, so of m shared values the m - t + 2 first others are enough. That
    holds for every list; it is only needed for long ones.
    """
    placed = (
        prefix.join(near.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("comp", F.coalesce("component", "cls"))
        .select("key", "cls", "comp", "n_shingles", "_all")
    )
    lists = (
        placed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("_length"), F.min("comp").alias("_c1"), F.max("comp").alias("_c2"))
        .where("_c1 <> _c2")
        .select("key", "_length")
    )
    open_lists = stored(placed.join(lists, "key"), "lists")
    others = F.filter("_all", lambda k: k != F.col("key"))
    enough = F.greatest(F.size(others) - least + 2, F.lit(0))
    second = F.slice(others, 1, enough) if least > 1 else F.array(F.lit(0).cast("bigint"))
    cut = (
        open_lists.where(F.col("_length") > LONG_LIST)
        .withColumn("_second", F.explode(second))
        .select(F.xxhash64(F.least("key", "_second"), F.greatest("key", "_second")).alias("key"), "cls", "comp", "n_shingles")
        .distinct()
    )
    members = (
        open_lists.where(F.col("_length") <= LONG_LIST)
        .select("key", "cls", "comp", "n_shingles")
        .union(cut)
    )
    left = members.toDF("key", "a", "_ca", "_na")
    right = members.toDF("key", "b", "_cb", "_nb")
    sizes = _similar_sizes(F.col("_na"), F.col("_nb"), percent)
    return left.join(right, "key").where(sizes & F.expr("a > b AND _ca <> _cb")).select("a", "b").distinct()


def _result(rows: DataFrame, classes: DataFrame, links: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    components = connected_components(links)
    placed = classes.select("cls", "n_shingles", "_d1", "_d2", "_least").join(
        components.withColumnRenamed("node", "cls"), "cls", "left"
    ).withColumn("_comp", F.coalesce("component", "cls"))
    named = placed.groupBy("_comp").agg(F.min("_least").alias("_first"))
    sets = placed.join(named, "_comp").select("n_shingles", "_d1", "_d2", "_first")
    alone = F.isnull("_first")
    return (
        rows.join(sets, ["n_shingles", "_d1", "_d2"], "left")
        .select(
            *carry,
            "row_id",
            "doc_id",
            "n_shingles",
            F.when(alone, F.col("doc_id")).otherwise(F.col("_first.doc_id")).alias("component_id"),
            (alone | (F.col("row_id") == F.col("_first.row_id"))).alias("shown"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )
