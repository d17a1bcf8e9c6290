"""Quality classifier: naive Bayes support vectors over hashed byte n-grams.

A text is the set of its byte n-grams. Each is scaled by its log-count ratio between the classes
and the scaled set is brought to unit length; a linear model with squared hinge loss is fitted on
it by dual coordinate descent, and its margins are mapped to probabilities. The model is fitted on
a bounded sample of labelled rows; scoring reads every text once, in place, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.llm.shingles import word_hashes

BUCKET_BITS = 18
SIZES = (1, 2, 3, 4)
# Stated bound of the labelled sample, for each of the two classes.
SAMPLE_PER_CLASS = 2_000
# And of the buckets of one text in it; so the fit holds 262 MB at most. Scoring has no such bound.
FIT_BUCKETS = 1 << 14
THRESHOLD = 0.3
FOLDS = 5
LONGEST_RUN = 8
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 20

_MULTIPLIERS = np.array([0, 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)
_seen = np.zeros(1 << BUCKET_BITS, dtype=np.int32)


def gram_buckets(text: bytes) -> np.ndarray:
    """Distinct buckets of the byte n-grams of a whole text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    parts, code = [], np.zeros(len(raw), dtype=np.uint32)
    for size in range(1, max(SIZES) + 1):
        if len(raw) < size:
            break
        code = (code[: len(raw) - size + 1] << np.uint32(8)) | raw[size - 1 :]
        if size in SIZES:
            parts.append(((code + np.uint32(size)) * _MULTIPLIERS[size]) >> np.uint32(32 - BUCKET_BITS))
    if not parts:
        return np.empty(0, dtype=np.uint32)
    parts.append(_repetition(text))
    buckets = np.concatenate(parts)
    # The last place of each bucket, found without sorting.
    places = np.arange(len(buckets), dtype=np.int32)
    _seen[buckets] = places
    return buckets[_seen[buckets] == places]


def _repetition(text: bytes) -> np.ndarray:
    """Buckets for n-grams of one word over and over: runs of repeats, and their share of the text."""
    words = word_hashes(text)
    if len(words) < 2:
        return np.empty(0, dtype=np.uint32)
    same = words[1:] == words[:-1]
    codes = [100 + int(10 * same.mean())]
    for length in range(1, LONGEST_RUN + 1):
        if not same.any():
            break
        codes.append(length)
        same = same[1:] & same[:-1]
    numbers = np.array(codes, dtype=np.uint32)
    return ((numbers + np.uint32(977)) * np.uint32(0x165667B1)) >> np.uint32(32 - BUCKET_BITS)


@dataclass(frozen=True)
class QualityModel:
    """Weights and log-count ratios per bucket, and the map from margin to score."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, sets: list[np.ndarray]) -> np.ndarray:
        product, square = self.weights * self.ratios, self.ratios**2
        norms = np.array([square[s].sum() for s in sets]) + 1e-12
        return np.array([product[s].sum() for s in sets]) / np.sqrt(norms) + self.bias

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margins(sets) + self.shift)))


def held_out(doc_id: str, folds: int = FOLDS) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0


def labelled_sample(
    labels: DataFrame, doc_id: str, quality: str, per_class: int, folds: int = FOLDS
) -> DataFrame:
    """(doc_id, quality) of at most ``per_class`` rows of each class, none of them held out.

    The rows with the smallest hash are taken, so a rerun takes the same. Of contradicting labels
    of a document the lower counts.
    """
    usable = (
        labels.where(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id, folds))
        .groupBy(F.col(doc_id).alias("doc_id"))
        .agg(F.min(quality).cast("int").alias("quality"))
    )
    one, two = (
        usable.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for q in (0, 1)
    )
    return one.union(two)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    per_class: int = SAMPLE_PER_CLASS,
    folds: int = FOLDS,
) -> QualityModel:
    """Fit on a sample of at most ``per_class`` labelled rows per class.

    The sample's doc_ids are few and are sent to the tasks, which turn the sampled texts into
    buckets, at most ``FIT_BUCKETS`` of a text, and one task fits the model on these; only the model reaches the
    driver. Without rows of both classes, so with empty tables too, the model scores every text with the share of
    label 1 (1 without labels). NULL and empty texts have no buckets; rows of one doc_id count once; labels other than
    0 and 1 and NULL ids are left out; other columns are not looked at, whatever their names.
    """
    chosen = labelled_sample(labels, doc_id, quality, per_class, folds).collect()
    if not {row["quality"] for row in chosen} == {0, 1}:
        return _constant(chosen)
    ids = docs.sparkSession.createDataFrame(
        pd.DataFrame({"_id": [r["doc_id"] for r in chosen], "_quality": [r["quality"] for r in chosen]}),
    )
    texts = docs.select(F.col(doc_id).alias("_doc"), F.coalesce(text, F.lit("")).alias("_text")).join(
        F.broadcast(ids), F.col("_doc") == F.col("_id")
    )

    kind = docs.schema[doc_id].dataType.simpleString()

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [bounded(gram_buckets(t.as_buffer().to_pybytes())).astype("<u4").tobytes() for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), batch.column("_quality"), pa.array(sets, pa.binary())],
                names=["doc", "quality", "buckets"],
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).to_pandas()
        if rows["quality"].nunique() < 2:
            return
        # Repeated rows of a document count once; the order of the fit is fixed.
        rows = rows.sort_values(["doc", "buckets"]).drop_duplicates("doc")
        model = fit_sets([np.frombuffer(b, "<u4") for b in rows["buckets"]], rows["quality"].to_numpy())
        numbers = np.array([model.bias, model.slope, model.shift])
        yield pa.RecordBatch.from_arrays(
            [pa.array([v.tobytes()], pa.binary()) for v in (model.ratios, model.weights, numbers)],
            names=["ratios", "weights", "numbers"],
        )

    sampled = texts.select("_doc", F.col("_quality").cast("int").alias("_quality"), "_text").mapInArrow(
        take, f"doc {kind}, quality int, buckets binary"
    )
    # One task learns: at most 2 * per_class rows of at most FIT_BUCKETS numbers. Only the model reaches the driver.
    found = sampled.repartition(1).mapInArrow(learn, "ratios binary, weights binary, numbers binary").first()
    if found is None:
        return _constant(chosen)
    ratios, weights, numbers = (np.frombuffer(v) for v in found)
    return QualityModel(ratios, weights, *numbers.tolist())


def bounded(buckets: np.ndarray) -> np.ndarray:
    """The buckets of a text, or of a very long one an even sample of them, the same on every run."""
    if len(buckets) <= FIT_BUCKETS:
        return buckets
    # An odd factor deals the numbers out anew: those that come first are as good as drawn at random.
    return buckets[np.argpartition(buckets.astype(np.uint32) * np.uint32(0x9E3779B1), FIT_BUCKETS)[:FIT_BUCKETS]]


def _constant(chosen) -> QualityModel:
    share = sum(r["quality"] for r in chosen) / len(chosen) if chosen else 1.0
    share = min(max(share, 1e-6), 1 - 1e-6)
    nothing = np.zeros(1 << BUCKET_BITS)
    return QualityModel(nothing, nothing, 0.0, 0.0, float(np.log(share / (1 - share))))


def log_count_ratios(sets: list[np.ndarray], quality: np.ndarray) -> np.ndarray:
    """Per bucket, the logarithm of its smoothed share in class 1 over that in class 0."""
    counts = np.full((2, 1 << BUCKET_BITS), SMOOTHING)
    for found, label in zip(sets, quality):
        counts[label, found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def _fit_half(sets: list[np.ndarray], quality: np.ndarray) -> QualityModel:
    ratios = log_count_ratios(sets, quality)
    weights, bias = dual_coordinate_descent(sets, np.where(quality == 1, 1.0, -1.0), ratios)
    return QualityModel(ratios, weights, bias, 1.0, 0.0)


def fit_sets(sets: list[np.ndarray], quality: np.ndarray) -> QualityModel:
    """Model of the bucket sets of texts with labels 0 and 1."""
    whole = _fit_half(sets, quality)
    # Margins of rows that neither the ratios nor the weights have seen give the map to probabilities.
    margins, seen = np.zeros(len(sets)), np.zeros(len(sets), dtype=bool)
    for part in (np.arange(len(sets)) % 2 == 0, np.arange(len(sets)) % 2 == 1):
        if len(set(quality[part])) == 2:
            model = _fit_half([s for s, p in zip(sets, part) if p], quality[part])
            margins[~part] = model.margins([s for s, p in zip(sets, part) if not p])
            seen |= ~part
    if len(set(quality[seen])) < 2:
        # Too few rows for halves: the fitted rows themselves have to do.
        margins, seen = whole.margins(sets), np.ones(len(sets), dtype=bool)
    slope, shift = _logistic(margins[seen], quality[seen])
    return QualityModel(whole.ratios, whole.weights, whole.bias, slope, shift)


def dual_coordinate_descent(
    sets: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, rounds: int = ROUNDS, close: float = 1e-3
) -> tuple[np.ndarray, float]:
    """Weights of the scaled, unit-length rows under squared hinge loss, and the bias.

    Each step solves one dual variable exactly. The bias is one more feature of value 1.
    """
    # Rows are scaled as they are met, so only the buckets are held.
    norms = np.array([np.sqrt((ratios[s] ** 2).sum() + 1e-12) for s in sets])
    diagonal = np.array([(ratios[s] ** 2).sum() for s in sets]) / norms**2 + 1 + 1 / (2 * COST)
    weights, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(sets))
    random = np.random.default_rng(7)
    for _ in range(rounds):
        largest = 0.0
        for i in random.permutation(len(sets)):
            row = ratios[sets[i]] / norms[i]
            gradient = signs[i] * (weights[sets[i]] @ row + bias) - 1 + alpha[i] / (2 * COST)
            before = alpha[i]
            alpha[i] = max(before - gradient / diagonal[i], 0.0)
            step = (alpha[i] - before) * signs[i]
            if step:
                weights[sets[i]] += step * row
                bias += step
                largest = max(largest, abs(step))
        if largest < close:
            break
    return weights, bias


def _logistic(margins: np.ndarray, quality: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic map that fits the margins best, by Newton steps."""
    n1, n0 = (quality == 1).sum(), (quality == 0).sum()
    goal = np.where(quality == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    solution = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ solution, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (goal - p))
        solution = solution + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(solution[0]), float(solution[1])


def score(
    docs: DataFrame,
    model: QualityModel,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, score and predicted of every row, and the columns to ``keep`` (not named like these).

    A NULL or empty text has no n-grams and gets the score of the bias; a long one is scored as a whole. Repeated rows
    get equal scores. ``predicted`` is 1 from ``threshold`` on. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            sets = [gram_buckets(t.as_buffer().to_pybytes()) for t in batch.column("_text")]
            found = fitted.scores(sets) if sets else np.empty(0)
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "_text"]
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.float64()), pa.array(found >= threshold).cast(pa.int32())],
                names=[*names, "score", "predicted"],
            )

    chosen = docs.select(
        *keep, F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("_text")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name != "_text"]
    return chosen.mapInArrow(judge, ", ".join([*fields, "score double", "predicted int"]))
