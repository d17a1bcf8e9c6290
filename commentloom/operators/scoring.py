"""Sentiment scorers. A scorer turns a text column into an array of (label, score)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.functions import quote
from commentloom.functions.categories import CATEGORY_RULES
from commentloom.schemas import SCORES

# The praise and complaint keywords of the category rules, and some words of its own.
POSITIVE_TERMS = (
    *CATEGORY_RULES["Product Praise"],
    "good", "best", "happy", "nice", "excellent", "beautiful", "wonderful", "enjoy", "thank", "gentle",
)
NEGATIVE_TERMS = (
    *CATEGORY_RULES["Negative Experience"],
    "bad", "hate", "awful", "terrible", "ugly", "poor", "greasy", "stupid",
)

BATCH_SIZE = 32


class Scorer(Protocol):
    def add_scores(self, df: DataFrame, text: str, into: str) -> DataFrame:
        """The table with an array of (label, score) for a SQL text expression; NULL in, NULL out."""
        ...


@dataclass(frozen=True)
class LexiconScorer:
    """Share of distinct positive and negative terms; runs as plain expressions.

    positive = p / (p + n + 1), negative = n / (p + n + 1), neutral = 1 / (p + n + 1).
    """

    positive: Sequence[str] = POSITIVE_TERMS
    negative: Sequence[str] = NEGATIVE_TERMS

    def add_scores(self, df: DataFrame, text: str, into: str) -> DataFrame:
        def hits(terms: Sequence[str]) -> str:
            return " + ".join(f"int(contains(_text, {quote(t)}))" for t in dict.fromkeys(terms)) or "int(0)"

        # One projection per step: the lowered text and then the counts are used many times, so Catalyst keeps
        # the steps apart and works each out once, in generated code.
        lowered = df.selectExpr("*", f"lower({text}) AS _text")
        counted = lowered.selectExpr(
            "* EXCEPT (_text)", f"{hits(self.positive)} AS _p", f"{hits(self.negative)} AS _n", "_text IS NOT NULL AS _has"
        )
        shares = ", ".join(
            f"named_struct('label', '{label}', 'score', {count} / double(_p + _n + 1))"
            for label, count in (("positive", "_p"), ("negative", "_n"), ("neutral", "1D"))
        )
        return counted.selectExpr("* EXCEPT (_p, _n, _has)", f"CASE WHEN _has THEN array({shares}) END AS `{into}`")


Model = Callable[[list[str]], list[list[dict]]]


@dataclass(frozen=True)
class ModelScorer:
    """A caller's model, loaded once per Python worker and fed small batches.

    ``load`` returns a function from a list of texts to a list of [{label, score}, ...], one per
    text; another number of results is an error like any other. With ``on_error='skip'`` a failing batch gives no scores, so its rows get the defaults; by
    default the task fails and Spark runs it again.
    """

    load: Callable[[], Model]
    batch_size: int = BATCH_SIZE
    on_error: str = "fail"

    def __post_init__(self):
        if self.on_error not in ("fail", "skip"):
            raise ValueError("on_error is 'fail' or 'skip'")

    def add_scores(self, df: DataFrame, text: str, into: str) -> DataFrame:
        load, size, skip = self.load, self.batch_size, self.on_error == "skip"

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                # NULL marks a text that is not to be scored: a UDF sees every row, whatever
                # condition stands around it.
                wanted = batch[batch.notna()]
                found = pd.Series([None] * len(batch), index=batch.index, dtype=object)
                for start in range(0, len(wanted), size):
                    part = wanted.iloc[start : start + size]
                    try:
                        results = model(part.tolist())
                        if len(results) != len(part):
                            raise ValueError(f"model gave {len(results)} results for {len(part)} texts")
                    except Exception:
                        if not skip:
                            raise
                        continue
                    for at, result in zip(part.index, results):
                        found.at[at] = result
                yield found

        # Python evaluates annotations lazily here; the UDF needs real types.
        score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return df.withColumn(into, F.pandas_udf(score, SCORES)(F.expr(text)))


def score_sentiment(
    df: DataFrame, scorer: Scorer, text: str = "text_original", into: str = "scores"
) -> DataFrame:
    return scorer.add_scores(df, text, into)


def parallel_map(
    df: DataFrame, fn, schema, partitions: int | None = None, key: Sequence[str] | None = None
) -> DataFrame:
    """Run a function over Arrow-backed batches on all cores.

    Rows carry their own id, so no order has to be kept. ``partitions`` is for input with too few
    splits for a costly function; large input is best left as it is.
    """
    if partitions:
        df = df.repartition(partitions, *(key or []))
    return df.mapInPandas(fn, schema)
