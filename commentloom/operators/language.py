"""Language detection by character n-grams: a trained profile, looked up within each row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.functions import quote

UNKNOWN = "unknown"
TOP_GRAMS = 400
SLICE_CHARS = 1_000_000
#: Of a code point.
BITS = 21

PROFILE_SCHEMA = T.StructType(
    [T.StructField("gram", T.StringType()), T.StructField("weights", T.ArrayType(T.LongType()))]
)


@dataclass(frozen=True)
class LanguageProfile:
    """Per gram, one weight per language: log-probability in millionths, so sums are exact."""

    languages: tuple[str, ...]
    weights: DataFrame

    def save(self, path: str) -> None:
        named = self.weights.withColumn("languages", F.lit(list(self.languages)))
        named.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LanguageProfile:
        stored = spark.read.parquet(path)
        languages = tuple(stored.select("languages").first()["languages"])
        return LanguageProfile(languages, stored.select("gram", "weights"))


def words_only(text: str) -> str:
    """Lower-cased runs of letters, single blanks between them."""
    # A lone blank, as most words have between them, is right as it is: only other runs are replaced.
    others = r"[^\p{L}](?:[^\p{L}]+|(?<! ))"
    return f"trim(regexp_replace(lower(coalesce({text}, '')), {quote(others)}, ' '))"


def _trigram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every letter with the character on either side, blanks at word ends, and how often it comes.

    The letter alone and with its left neighbour are the shorter grams, so one pass serves all three sizes.
    """
    for batch in batches:
        of_language: dict = {}
        for lang, words in zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist()):
            of_language.setdefault(lang, []).append(words)
        for lang, texts in of_language.items():
            for part in _slices(texts):
                grams, counts = _trigrams(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), batch.schema.field("lang").type), pa.array(grams, pa.string()), pa.array(counts, pa.int64())],
                    names=["lang", "gram", "n"],
                )


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about a million characters, which bound the memory of a batch."""
    start, size = 0, 0
    for end, one in enumerate(texts, 1):
        size += len(one) + 1
        if size > SLICE_CHARS or end == len(texts):
            yield texts[start:end]
            start, size = end, 0


def _trigrams(texts: list[str]) -> tuple[list[str], np.ndarray]:
    _, distinct, _, counts = _letters(texts)
    joined = distinct.astype("<u4").tobytes().decode("utf-32-le")
    return [joined[i : i + 3] for i in range(0, len(joined), 3)], counts


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every letter in the texts, put together with blanks, its place and the number of its trigram; and the distinct
    trigrams, (left, letter, right) each, and how often they come.

    Characters are numbered first, so that trigrams are counted in a table; a large alphabet is sorted instead.
    """
    joined = " " + " ".join(texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    alphabet = np.flatnonzero(np.bincount(points))
    number = np.zeros(alphabet[-1] + 1, dtype=np.int64)
    number[alphabet] = np.arange(len(alphabet))
    base = len(alphabet)
    numbered = number[points]
    at = np.flatnonzero(points[1:-1] != 32) + 1
    codes = (numbered[at - 1] * base + numbered[at]) * base + numbered[at + 1]
    if base**3 <= 4 * len(codes):
        table = np.bincount(codes, minlength=base**3)
        found = np.flatnonzero(table)
        counts = table[found]
        table[found] = np.arange(len(found))
        which = table[codes]
    else:
        found, which, counts = np.unique(codes, return_inverse=True, return_counts=True)
    distinct = alphabet[np.stack([found // base**2, found // base % base, found % base], axis=1)]
    return at, distinct, which, counts


def sizes_of(gram: str) -> list[str]:
    return [f"substring({gram}, 2, 1)", f"left({gram}, 2)", gram]


def train_profile(
    corpus: DataFrame, text: str = "text", language: str = "lang", top: int = TOP_GRAMS
) -> LanguageProfile:
    """Fit a profile on labelled texts.

    The vocabulary is the union of each language's most frequent grams of one to three
    characters; a weight is the smoothed log-share of a gram among a language's vocabulary grams.
    Like any fitted model the result is small and lives on the driver: at most ``top`` x
    languages rows.
    """
    if top < 1:
        raise ValueError("top is 1 or more")
    spark = corpus.sparkSession
    texts = corpus.where(F.col(language).isNotNull()).selectExpr(f"{language} AS lang", f"{words_only(text)} AS words")
    # Grams repeat: each task counts them slice by slice, and only distinct ones become rows.
    counts = (
        texts.where("words <> ''")
        .mapInArrow(_trigram_counts, f"lang {texts.schema['lang'].dataType.simpleString()}, gram string, n bigint")
        .groupBy("lang", "gram")
        .agg(F.expr("sum(n) AS n"))
        .selectExpr("lang", f"explode(array({', '.join(sizes_of('gram'))})) AS gram", "n")
        .groupBy("lang", "gram")
        .agg(F.expr("sum(n) AS n"))
        .persist()
    )
    try:
        found = counts.select("lang").distinct().collect()
        languages = tuple(sorted(row["lang"] for row in found))
        if not languages:
            raise ValueError("no labelled text with letters to train on")
        frequent = W.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram"))
        vocabulary = (
            counts.withColumn("_rank", F.row_number().over(frequent))
            .where(F.col("_rank") <= top)
            .select("gram")
            .distinct()
        )
        per_language = [
            F.expr(f"coalesce(sum(n) FILTER (WHERE lang = {quote(name)}), 0) AS n{i}")
            for i, name in enumerate(languages)
        ]
        table = (
            counts.join(vocabulary, "gram", "left_semi")
            .groupBy("gram")
            .agg(*per_language)
            .toPandas()
        )
    finally:
        counts.unpersist()
    return LanguageProfile(languages, _weights(spark, table, len(languages)))


def _weights(spark: SparkSession, table: pd.DataFrame, n_languages: int) -> DataFrame:
    table = table.sort_values("gram")
    counts = table[[f"n{i}" for i in range(n_languages)]].to_numpy(dtype="float64")
    shares = (counts + 1) / (counts.sum(axis=0) + len(table))
    weights = np.floor(np.log(shares) * 1e6 + 0.5).astype("int64")
    local = pa.table({"gram": table["gram"].tolist(), "weights": weights.tolist()})
    return spark.createDataFrame(local, PROFILE_SCHEMA)


def detect_language(
    df: DataFrame,
    profile: LanguageProfile,
    text: str,
    keep: Sequence[str],
    into: str = "language",
) -> DataFrame:
    """Most likely language of each text, or ``unknown`` without any known gram.

    ``keep`` names the columns to carry along. The language is worked out within the row: the profile,
    like any fitted model, is loaded by each task, and grams are looked up in it as numbers, with neither
    a row per gram nor a shuffle. On a tie the language that sorts first wins.
    """
    found = profile.weights.toPandas()
    grams = np.array([_gram_number(g) for g in found["gram"]], dtype=np.uint64)
    order = np.argsort(grams)
    weights = np.array(found["weights"].tolist(), dtype=np.float64).reshape(len(grams), -1)[order]
    shared = df.sparkSession.sparkContext.broadcast((grams[order], weights, np.array([*profile.languages, UNKNOWN])))

    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, weight, names = shared.value
        for batch in batches:
            places = [_best(part, known, weight) for part in _slices(batch.tolist())]
            yield pd.Series(names[np.concatenate(places)] if places else [], dtype=object)

    # Python evaluates annotations lazily here; the UDF needs real types.
    detect.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(detect, T.StringType())
    return df.select(*keep, udf(F.expr(words_only(text))).alias(into))


def _gram_number(gram: str) -> int:
    """A gram of one to three characters as one number, ``BITS`` bits each."""
    number = 0
    for character in gram:
        number = number << BITS | ord(character)
    return number


def _best(texts: list[str], known: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Place of the best language of each text; the place after the last means none."""
    at, distinct, which, _ = _letters(texts)
    bits = np.uint64(BITS)
    left, letter, right = distinct.astype(np.uint64).T
    pair = left << bits | letter
    # What a trigram and the shorter grams in it weigh; weights are whole numbers, so sums are exact in any order.
    weighed = np.zeros((len(distinct), weights.shape[1]))
    for grams in (letter, pair, pair << bits | right) if len(known) else ():
        place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        hit = known[place] == grams
        weighed[hit] += weights[place[hit]]
    # Which text a letter is of, by where the next ones begin.
    begins = np.searchsorted(at - 1, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    totals = np.zeros((len(texts), weights.shape[1]))
    for i in range(weights.shape[1]):
        totals[:, i] = np.bincount(owner, weighed[which, i], minlength=len(texts))
    # Every weight is below zero, so a sum of zero means that no gram was known.
    return np.where(totals[:, 0] < 0, totals.argmax(axis=1), weights.shape[1])
