"""Whitening of vectors by the covariance of their distinct values.

Vectors are put on a grid of whole numbers and equal ones are grouped. Each distinct vector enters
the covariance with a weight, its count or one. Every partition gives weight, sums, mean and a
centred product (one weighted matrix product), and these are merged pairwise, so nothing is
subtracted after it was squared. Each distinct vector is whitened once and joined back to its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.llm.hot import join_classes
from commentloom.llm.scratch import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
# Grid values beyond are held at this bound: doubles have no exact neighbours there.
MOST = 1 << 53
LIMB = 26
# Partial results are merged in this many tasks, and theirs in one.
SLOTS = 64
LARGEST_LONG = (1 << 63) - 1
_PART = "slot int, weight double, mean binary, moment binary, high binary, low binary"


@dataclass
class Moments:
    """Weight, mean and centred second moment, with exact whole sums in two limbs."""

    weight: float
    mean: np.ndarray
    moment: np.ndarray
    high: np.ndarray
    low: np.ndarray

    def add(self, other: Moments) -> Moments:
        weight = self.weight + other.weight
        apart = other.mean - self.mean
        return Moments(
            weight,
            self.mean + apart * (other.weight / weight),
            self.moment + other.moment + np.outer(apart, apart) * (self.weight * other.weight / weight),
            self.high + other.high,
            self.low + other.low,
        )

    @property
    def sums(self) -> list[int]:
        return [(int(h) << LIMB) + int(w) for h, w in zip(self.high, self.low)]


@dataclass(frozen=True)
class Whitening:
    """Size and sums of the fit list, unit components (rows) by falling variance, and shares of the whole."""

    size: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    shares: np.ndarray


def usable(vector: str) -> Column:
    """Neither NULL, nor with a NULL or non-finite entry."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & good, F.lit(False))


def _grid(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * values.astype(np.float64))
    return np.clip(scaled, -MOST + SHIFT, MOST - SHIFT).astype(np.int64) + SHIFT


def _moments(matrix: np.ndarray, weights: np.ndarray) -> Moments:
    weight = float(weights.sum())
    # Whole grid values lose nothing against the first row as origin.
    origin = matrix[0]
    apart = (matrix - origin).astype(np.float64)
    mean = weights @ apart / weight
    centred = apart - mean
    whole = matrix.dtype == np.int64
    counts = weights.astype(np.int64)
    high = counts @ (matrix >> LIMB) if whole else np.zeros(matrix.shape[1], np.int64)
    low = counts @ (matrix & ((1 << LIMB) - 1)) if whole else high
    return Moments(weight, origin + mean, (centred * weights[:, None]).T @ centred, high, low)


def _packed(slot: int, m: Moments) -> pa.RecordBatch:
    columns = [
        pa.array([slot], pa.int32()), pa.array([m.weight]),
        *[pa.array([v.tobytes()], pa.binary()) for v in (m.mean, m.moment, m.high, m.low)],
    ]
    return pa.RecordBatch.from_arrays(columns, names=["slot", "weight", "mean", "moment", "high", "low"])


def _unpacked(row: dict) -> Moments:
    mean, high, low = np.frombuffer(row["mean"]), np.frombuffer(row["high"], np.int64), np.frombuffer(row["low"], np.int64)
    return Moments(row["weight"], mean, np.frombuffer(row["moment"]).reshape(len(mean), len(mean)), high, low)


def moments(df: DataFrame, values: str, weight: str | None, dtype: type) -> Moments | None:
    """Moments of the packed vectors in ``values``, all of one length; None without rows.

    What reaches the driver is one row: vectors of one length of sums and one square matrix.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = None
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = np.frombuffer(b"".join(batch.column(values).to_pylist()), dtype).reshape(batch.num_rows, -1)
            weights = batch.column(weight).to_numpy().astype(float) if weight else np.ones(len(matrix))
            part = _moments(matrix, weights)
            found = found.add(part) if found else part
        if found:
            yield _packed(TaskContext.get().partitionId() % SLOTS, found)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            for row in batch.to_pylist():
                found = found.add(_unpacked(row)) if found else _unpacked(row)
        if found:
            yield _packed(0, found)

    parts = df.select(*[c for c in (values, weight) if c]).mapInArrow(partial, _PART)
    few = parts.repartition("slot").mapInArrow(merged, _PART)
    one = few.repartition(1).mapInArrow(merged, _PART).first()
    return _unpacked(one.asDict()) if one else None


def fit_whitening(distinct: DataFrame, components: int, by_count: bool = False) -> Whitening | None:
    """Fit over (x, copies), x packed whole numbers; each vector weighs one, or its count."""
    found = moments(distinct, "x", "copies" if by_count else None, np.int64)
    if found is None:
        return None
    values, vectors = np.linalg.eigh(found.moment / found.weight)
    order = np.argsort(-values, kind="stable")[:components]
    rows = vectors[:, order].T
    # Either sign would do; the largest entry is made positive so that reruns agree.
    rows = rows * np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)])[:, None]
    total = float(np.trace(found.moment / found.weight))
    variances = values[order]
    variances = np.where(variances > total * len(values) * np.finfo(float).eps * 16, variances, np.nan)
    shares = np.maximum(values[order], 0) / total if total > 0 else np.full(len(order), np.nan)
    return Whitening(int(round(found.weight)), found.sums, rows, variances, shares)


def _deviations(matrix: np.ndarray, size: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """(size * x - sums) / size in doubles, and the exact sums of squares of size * x - sums."""
    bound = (int(np.abs(matrix).max(initial=0)) + 1) * size + max((abs(s) for s in sums), default=0)
    if bound < 1 << 62:
        apart = matrix * size - np.array(sums, dtype=np.int64)
        largest = int(np.abs(apart).max(initial=0))
        if largest**2 * matrix.shape[1] <= LARGEST_LONG:
            return apart / size, (apart * apart).sum(axis=1).tolist()
    exact = matrix.astype(object) * size - np.array(sums, dtype=object)
    squares = [int(s) for s in (exact * exact).sum(axis=1)]
    return (exact / size).astype(float), [s if s <= LARGEST_LONG else None for s in squares]


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
    by_count: bool = False,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every row and component.

    Entries become floor(64 * c) + 1000000. Rows whose vector is NULL or has a NULL or non-finite entry are left
    out. All vectors of a fit have one length: the one that most distinct vectors have (of equal ones the larger); rows of
    another length, empty ones too, are left out. Repeated rows come out once each, a NULL id as it is, other columns not at all. A component
    without variance has NULL in whitened, and in explained where nothing varies; identity_error is over the others. A deviation
    beyond a long is NULL. An empty table gives an empty result.
    """
    names = ["vec_id", "key", "x", "width"]
    id_type = vectors.schema[vec_id].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
            grid = _grid(column.flatten().to_numpy(zero_copy_only=False))
            packed = [grid[e - w : e].tobytes() for e, w in zip(ends, np.diff(ends, prepend=0))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.sha256(p).digest() for p in packed], pa.binary()),
                 pa.array(packed, pa.binary()), pa.array(np.diff(ends, prepend=0), pa.int32())],
                names=names,
            )

    chosen = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    rows = stored(
        chosen.where(usable("embedding") & (F.size("embedding") > 0))
        .mapInArrow(place, f"vec_id {id_type}, key binary, x binary, width int"),
        "grid",
    )
    distinct = stored(rows.groupBy("key", "width").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("copies")), "distinct")
    widths = distinct.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0
    distinct = distinct.where(F.col("width") == width).drop("width")
    fitted = fit_whitening(distinct, components, by_count)
    if fitted is None:
        return _result(rows.where("false").withColumns(_no_columns()), None, None)
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scaled = model.components / np.sqrt(model.variances)[:, None]
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.int64).reshape(batch.num_rows, -1)
            centred, squares = _deviations(matrix, model.size, model.sums)
            z = centred @ scaled.T
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copies"), pa.array(squares, pa.int64()),
                 pa.array([v.tobytes() for v in z[:, ~np.isnan(model.variances)]], pa.binary()),
                 pa.array([[None if np.isnan(c) else c for c in v] for v in z.tolist()], pa.list_(pa.float64()))],
                names=["key", "copies", "deviation", "z", "whitened"],
            )

    whitened = stored(
        distinct.mapInArrow(project, "key binary, copies bigint, deviation bigint, z binary, whitened array<double>"),
        "whitened",
    )
    error = None
    if not np.isnan(fitted.variances).all():
        measured = moments(whitened, "z", "copies" if by_count else None, np.float64)
        error = float(np.abs(measured.moment / measured.weight - np.eye(len(measured.mean))).max())
    narrow = rows.where(F.col("width") == width).select("vec_id", "key")
    joined = join_classes(narrow, whitened.drop("z"), "key", "copies")
    return _result(joined, fitted, error)


def _no_columns() -> dict[str, Column]:
    return {"deviation": F.lit(None).cast("long"), "whitened": F.lit(None).cast("array<double>")}


def _result(joined: DataFrame, fitted: Whitening | None, error: float | None) -> DataFrame:
    shares = [] if fitted is None else [None if np.isnan(s) else float(s) for s in fitted.shares]
    return joined.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(0 if fitted is None else fitted.size).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(s).cast("double") for s in shares]).cast("array<double>"), F.col("_at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
