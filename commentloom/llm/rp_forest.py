"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors of a label again and again by random projections. A border lies where it saves most
comparisons, so beside a dense group and not through it, and vectors close to
a border go to both sides. A node that no border would make cheaper is a leaf, and so is a small one. Trees are fitted
in rounds: borders come from a sample of a node's own rows, and what is still large below them is sampled anew,
so leaves stay small however many vectors there are. Vectors
are compared within the leaves only, in double precision, so each
reported link is a true one, and a pair is lost only if all trees part it. Leaves of any size are
compared in pairs of blocks; what a large leaf of the first tree has compared, the other trees leave out. Pairs never leave a task: a leaf gives each vector's number of links
and a tree of links, and a pair that meets in several leaves is counted in the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.blocks import SMALL, block_pairs, map_runs
from commentloom.llm.components import connected_components
from commentloom.llm.hot import join_classes
from commentloom.llm.scratch import numbered, stored
from commentloom.llm.shingles import BASE, mixed

TREES = 4
# Width of the overlap at a border, in standard deviations of a projected pair at the threshold.
SPILL = 1.6
LEAF_ROWS = 32
# Directions that a node chooses from, and the share of its comparisons that a split may leave at most.
DIRECTIONS = 8
WORTH = 0.8
# Sample of one node that places the borders below it, in rows and bytes, and the rows of a sample that can carry a border.
FIT_ROWS = 8192
FIT_BYTES = 16 << 20
LEAST_SAMPLE = 16
MOST_LEVELS = 60
# Rows that one task sends down a node's borders.
ROUTE_ROWS = 1 << 16
BLOCK_ROWS = 512
BLOCK_NUMBERS = 512 * 1024

Borders = dict[int, tuple[int, float]]


def directions(seed: int, level: int, width: int) -> np.ndarray:
    """Unit vectors in the columns, the same wherever they are asked for."""
    found = np.random.default_rng([11, seed, level, width]).standard_normal((width, DIRECTIONS))
    return found / np.linalg.norm(found, axis=0)


def best_border(places: np.ndarray, margin: float) -> tuple[float, int, float] | None:
    """(comparisons left, direction, border) of the split that leaves least; None if none makes both sides smaller."""
    best = None
    for way, column in enumerate(places.T):
        ordered = np.sort(column)
        tried = ordered[np.unique(np.linspace(0, len(ordered) - 1, 256).astype(int))]
        left = np.searchsorted(ordered, tried + margin)
        right = len(ordered) - np.searchsorted(ordered, tried - margin)
        cost = np.where((left < len(ordered)) & (right < len(ordered)), left.astype(float) ** 2 + right.astype(float) ** 2, np.inf)
        at = cost.argmin()
        if np.isfinite(cost[at]) and (best is None or cost[at] < best[0]):
            best = (cost[at], way, float(tried[at]))
    return best


def fit_borders(sample: np.ndarray, rows: int, seed: int, margin: float, leaf_rows: int) -> tuple[Borders, set[int]]:
    """Borders by node (1 is the root, 2i and 2i + 1 lie below i), and the leaves that want a sample of their own.

    ``sample`` are unit vectors of a node of ``rows`` vectors.
    """
    borders: Borders = {}
    again: set[int] = set()
    share = len(sample) / max(rows, 1)
    held = {1: np.arange(len(sample))}
    while held:
        below = {}
        for node, own in held.items():
            level = node.bit_length() - 1
            if len(own) <= leaf_rows * share or level >= MOST_LEVELS:
                continue
            if len(own) < LEAST_SAMPLE:
                # A whole node is never sampled again, and so its rows are compared as they are.
                if share < 1:
                    again.add(node)
                continue
            places = sample[own] @ directions(seed, level, sample.shape[1])
            found = best_border(places, margin)
            if found is None or found[0] > WORTH * len(own) ** 2:
                continue
            _, way, border = found
            borders[node] = (way, border)
            below[2 * node] = own[places[:, way] < border + margin]
            below[2 * node + 1] = own[places[:, way] >= border - margin]
        held = below
    return borders, again


def leaves_of(unit: np.ndarray, borders: Borders, seed: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of the rows of a matrix of unit vectors; a row may be in several leaves."""
    found = []
    held = {1: np.arange(len(unit))}
    while held:
        below = {}
        for node, own in held.items():
            if node not in borders:
                found.append((own, np.full(len(own), node)))
                continue
            way, border = borders[node]
            places = unit[own] @ directions(seed, node.bit_length() - 1, unit.shape[1])[:, way]
            below[2 * node], below[2 * node + 1] = own[places < border + margin], own[places >= border - margin]
        held = below
    return tuple(np.concatenate(c) for c in zip(*found))


def near_duplicate_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = 0.98,
    trees: int = TREES,
    spill: float = SPILL,
    leaf_rows: int = LEAF_ROWS,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Two vectors of one label and one length are linked when their cosine is ``cosine`` or more.
    A vector without label, or that is NULL, empty, all zero or has a NULL or non-finite component, is
    linked with nothing. Equal vectors are compared once and counted as often as they occur.
    component_id is the smallest vec_id reachable; a NULL vec_id is never the smallest unless the
    component has no other, and ``kept`` is false for it. An empty table gives an empty result. Vectors may be of any
    length, and a label may hold all of them. Other columns are not looked at, whatever their names.
    """
    usable = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = stored(
        numbered(
            vectors.select(
                F.col(vec_id).alias("vec_id"),
                F.col(label).alias("label"),
                F.col(embedding).alias("embedding"),
            ).withColumn("_usable", F.coalesce(usable, F.lit(False)))
        ),
        "vectors",
    )
    classes = stored(
        rows.where("_usable")
        .groupBy("label", "embedding")
        .agg(F.min("row_id").alias("cls"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("_least")),
        "classes",
    )
    found = _linked(classes, cosine, trees, spill, leaf_rows, fit_rows)
    components = connected_components(found.where("root IS NOT NULL").select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("id").alias("cls")).agg(F.sum("links").alias("_links"))
    placed = (
        classes.join(links, "cls", "left")
        .join(components.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("_comp", F.coalesce("component", "cls"))
    )
    named = placed.groupBy("_comp").agg(F.min("_least").alias("_name"))
    per_class = placed.join(named, "_comp").select(
        "label", "embedding", F.lit(True).alias("_usable"), "_name",
        (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
    )
    return (
        rows.join(per_class, ["label", "embedding", "_usable"], "left")
        .select(
            "vec_id",
            F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("_name", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column as a matrix, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    matrix = np.zeros((len(column), width or max(lengths, default=0)))
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return matrix


def _unit(matrix: np.ndarray) -> np.ndarray:
    # Scaled first, so that no square leaves the range of doubles.
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


_ENTRY = "cls bigint, tree int, node bigint, open boolean"


def _entries(classes: DataFrame, cosine: float, trees: int, spill: float, leaf_rows: int, fit_rows: int) -> DataFrame:
    """(cls, tree, node): the leaves of each class in each tree; nodes are numbers that only equal nodes share."""
    width = F.size("embedding")
    margin = spill * float(np.sqrt(2 - 2 * cosine)) / 2
    roots = classes.select("cls", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "label", width.alias("width"))
    entries = stored(
        roots.select("cls", "tree", F.xxhash64("label", "width", "tree").alias("node"), F.lit(True).alias("open")), "entries"
    )
    done = []
    while True:
        sizes = stored(entries.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("open")), "sizes")
        large = sizes.where(f"open AND n > {leaf_rows}").select("node", "n")
        if large.isEmpty():
            done.append(entries.select("cls", "tree", "node"))
            break
        counted = join_classes(entries.drop("open"), sizes, "node", "n")
        is_large = F.expr(f"open AND n > {leaf_rows}")
        done.append(counted.where(~is_large).select("cls", "tree", "node"))
        wanted = counted.where(is_large).select("cls", "tree", "node", "n")
        rows = wanted.join(classes.select("cls", "embedding"), "cls")
        borders = _fitted(rows, margin, leaf_rows, fit_rows)
        entries = stored(_routed(rows, large, borders, margin), "entries")
    found = done[0]
    for part in done[1:]:
        found = found.union(part)
    return stored(found, "leaves")


def _fitted(rows: DataFrame, margin: float, leaf_rows: int, fit_rows: int) -> DataFrame:
    """(node, tree, borders) of the nodes, each fitted by one task on a bounded sample of its rows."""
    most = F.greatest(F.lit(LEAST_SAMPLE), F.least(F.lit(fit_rows), F.floor(F.lit(FIT_BYTES) / (8 * F.size("embedding")))))
    chance = F.ceil(F.col("n") / most)
    sample = rows.where(F.pmod(F.xxhash64("node", "cls"), chance) == 0)

    def fit(run: pa.Table) -> pa.RecordBatch:
        run = run.combine_chunks()
        unit = _unit(_matrix(run.column("embedding").chunk(0)))
        tree, size = run.column("tree")[0].as_py(), run.column("n")[0].as_py()
        # The rows come in any order; the borders do not hang on it.
        borders, again = fit_borders(unit, max(size, len(unit)), tree, margin / np.sqrt(unit.shape[1]), leaf_rows)
        packed = np.array([(n, w, 0) for n, (w, _) in borders.items()] + [(n, -1, 0) for n in again], np.int64).reshape(-1, 3)
        places = np.array([b for _, b in borders.values()] + [0.0] * len(again))
        packed[:, 2] = places.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [run.column("node").chunk(0)[:1], pa.array([packed.tobytes()], pa.binary())], names=["node", "borders"]
        )

    return stored(map_runs(sample, "node", fit, "node bigint, borders binary"), "borders")


def _routed(rows: DataFrame, nodes: DataFrame, borders: DataFrame, margin: float) -> DataFrame:
    """The entries below the fitted nodes. A node's borders go once to each task that has rows of it."""
    parts = F.ceil(F.col("n") / ROUTE_ROWS)
    kind = rows.schema["embedding"].dataType.simpleString()
    first = nodes.join(borders, "node").select(
        "node", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), F.lit(0).alias("side"),
        F.lit(None).cast("bigint").alias("cls"), F.lit(None).cast("int").alias("tree"),
        F.lit(None).cast(kind).alias("embedding"), "borders",
    )
    then = rows.select(
        "node", F.pmod(F.xxhash64("cls"), parts).alias("part"), F.lit(1), "cls", "tree", "embedding", F.lit(None).cast("binary")
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[Borders, np.ndarray] = ({}, np.empty(0, np.int64))
        fitted_for = None
        for batch in batches:
            node, side = batch.column("node").to_numpy(), batch.column("side").to_numpy()
            cuts = np.flatnonzero((node[1:] != node[:-1]) | (side[1:] != side[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == end:
                    continue
                run = batch.slice(start, end - start)
                if side[start] == 0:
                    packed = np.frombuffer(run.column("borders")[0].as_py(), np.int64).reshape(-1, 3)
                    places = np.ascontiguousarray(packed[:, 2]).view(np.float64).tolist()
                    found = {n: (w, p) for (n, w, _), p in zip(packed.tolist(), places) if w >= 0}
                    known, fitted_for = (found, packed[packed[:, 1] < 0, 0]), node[start]
                    continue
                # A sample may have missed a small node: it stays as it is then.
                (borders, again), old = known if fitted_for == node[start] else ({}, np.empty(0, np.int64)), node[start]
                unit = _unit(_matrix(run.column("embedding")))
                tree = run.column("tree")[0].as_py()
                row, leaf = leaves_of(unit, borders, tree, margin / np.sqrt(unit.shape[1]))
                new = mixed(np.uint64(old.view(np.uint64) if old < 0 else old) * np.uint64(BASE) + leaf.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [run.column("cls").take(pa.array(row)), run.column("tree").take(pa.array(row)),
                     pa.array(new.view(np.int64)), pa.array(np.isin(leaf, again))],
                    names=["cls", "tree", "node", "open"],
                )

    keys = ["node", "part"]
    return first.union(then).repartition(*keys).sortWithinPartitions(*keys, "side").mapInArrow(route, _ENTRY)


def _linked(
    classes: DataFrame, cosine: float, trees: int, spill: float, leaf_rows: int, fit_rows: int
) -> DataFrame:
    """(id, links, root): links that a leaf found, and the smallest class they lead to."""
    entries = _entries(classes, cosine, trees, spill, leaf_rows, fit_rows)
    # Numbers of leaves rise with the tree, so that the first tree's come first in a row's list.
    number = F.expr("shiftleft(cast(tree AS bigint), 56) + shiftrightunsigned(node, 8)")
    entries = entries.select("cls", number.alias("leaf"), "tree")
    sizes = entries.where("tree = 0").groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    homes = join_classes(entries.where("tree = 0").select("cls", "leaf"), sizes, "leaf", "n")
    homes = homes.groupBy("cls").agg(F.max(F.struct("n", "leaf")).alias("_home")).select("cls", F.col("_home.leaf").alias("_home"))
    lists = entries.groupBy("cls").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    size = F.size("embedding")
    routed = stored(classes.select("cls", "label", "embedding", "copies").join(lists, "cls").join(homes, "cls"), "routed")
    members = routed.select("cls", size.alias("weight"), "_home", F.explode("leaves").alias("leaf")).select(
        F.col("leaf").alias("group"),
        F.col("cls").alias("id"),
        "weight",
        # Rows of one leaf of the first tree have met there.
        F.when(F.col("leaf") < F.lit(1 << 56), F.lit(SMALL)).otherwise(F.col("_home")).cast("bigint").alias("part"),
    )
    met = block_pairs(members, BLOCK_ROWS, BLOCK_NUMBERS, part=True).join(
        routed.withColumnRenamed("cls", "id").drop("_home"), "id"
    )

    def compare(rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.combine_chunks()
        if rows.num_rows < 2:
            return None
        side, ids = rows.column("side").to_numpy(), rows.column("id").to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right)
        if alone:
            right = left
        vectors = _matrix(rows.column("embedding").chunk(0))
        unit = _unit(vectors)
        linked = unit[left] @ unit[right].T >= cosine
        if alone:
            np.fill_diagonal(linked, False)
        i, j = np.nonzero(linked)
        i, j = left[i], right[j]
        labels = rows.column("label").to_numpy(zero_copy_only=False)
        leaf, width = rows.column("group").to_numpy(), rows.column("weight").to_numpy()
        same = (labels[i] == labels[j]) & (width[i] == width[j])
        i, j = i[same], j[same]
        if not len(i):
            return None
        first = _first_common(rows.column("leaves").chunk(0), i, j) == leaf[i]
        copies = rows.column("copies").to_numpy()
        links = np.zeros(rows.num_rows, dtype=np.int64)
        np.add.at(links, i[first], copies[j[first]])
        if not alone:
            np.add.at(links, j[first], copies[i[first]])
        root = _roots(ids, i, j)
        touched = np.union1d(i, j)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[touched]), pa.array(links[touched]), pa.array(root[touched])],
            names=["id", "links", "root"],
        )

    wanted = ["pair", "side", "id", "label", "weight", "group", "embedding", "copies", "leaves"]
    return stored(
        map_runs(met.select(*wanted), "pair", compare, "id bigint, links bigint, root bigint"), "links"
    )


def _first_common(lists: pa.ListArray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest number that the i-th and j-th list share."""
    lengths = np.diff(lists.offsets.to_numpy())
    none = np.iinfo(np.int64).max
    table = np.full((len(lists), lengths.max()), none)
    table[np.arange(table.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy()
    found = np.full(len(i), none)
    for start in range(0, len(i), 1 << 16):
        a, b = table[i[start : start + (1 << 16)]], table[j[start : start + (1 << 16)]]
        least = found[start : start + (1 << 16)]
        for k in range(table.shape[1]):
            shared = (a[:, k : k + 1] == b).any(axis=1)
            np.minimum(least, np.where(shared, a[:, k], none), out=least)
    return found


def _roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches over the links."""
    root = ids.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, i, before[j])
        np.minimum.at(root, j, before[i])
        if (root == before).all():
            return root
