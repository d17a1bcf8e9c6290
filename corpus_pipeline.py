"""From raw documents to packed sequences, in stages that each read what the one before wrote.

The stages keep the columns of documents until the last one. Rows are told apart by their place in
the stored files, so NULL and repeated ids and columns of any name go through unharmed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.llm import quality
from commentloom.llm.block_naming import exact_dedup
from commentloom.llm.minhash_join import near_duplicates
from commentloom.llm.mixing import mixed
from commentloom.llm.packing import pack_documents
from commentloom.llm.scratch import numbered, settle, stored

# SQL knows no tokenizer and no fitted model. The operators are tested against brute force, the stages against a plain
# computation over their own inputs.
ORACLE_SQL = None
ROW = ("_row_file", "_row_number")


def _rows(docs: DataFrame) -> DataFrame:
    """The documents with a key for each row: the place in its file, or a stored number."""
    try:
        return docs.select(
            "*",
            F.col("_metadata.file_path").alias(ROW[0]),
            F.col("_metadata.row_index").alias(ROW[1]),
        )
    except AnalysisException:
        return stored(numbered(docs.withColumn(ROW[0], F.lit("")), ROW[1]), "documents")


def _back(docs: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, list(ROW)).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labels of the documents it is given.

    NULL text is scored as an empty one, repeated rows fare alike, an empty table gives an empty one.
    """
    settle(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    names = {c: f"_kept{i}" for i, c in enumerate(docs.columns)}
    carried = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col("doc_id"), F.col("text")
    )
    judged = quality.score(carried, model, keep=tuple(names.values()))
    return judged.where("predicted = 1").select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.

    NULL and empty texts are equal; of repeated rows one stays; an empty table gives an empty one.
    """
    settle(spark)
    rows = _rows(docs)
    kept = exact_dedup(rows, carry=ROW).where("kept").select(*ROW)
    return _back(docs, rows, kept)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by five-word shingles of similarity 0.8 or more.

    Documents without words, NULL ones too, are linked with nothing and all stay; an empty table gives an empty one.
    """
    settle(spark)
    rows = _rows(docs)
    kept = near_duplicates(rows, width=5, percent=80, carry=ROW).where("shown").select(*ROW)
    return _back(docs, rows, kept)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, stored in the order of the schedule's slots.

    The schedule cuts at most two documents of a source; such a one comes as often as the words
    taken from it round to. A source from which all would be rounded off keeps the one that most is taken of. Documents
    without words are never taken, nor sources without any; repeated rows are documents of their own; an
    empty table gives an empty one.
    """
    settle(spark)
    rows = _rows(docs)
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    taken = stored(
        mixed(rows, carry=ROW).where("taken > 0").select(*ROW, "source", "taken", "slots", times.alias("_times")), "taken"
    )
    # One row per source: its most taken document, where none is taken as a whole.
    most = F.max(F.struct("taken", *ROW))
    lost = taken.groupBy("source").agg(F.sum("_times").alias("_all"), most.alias("_most")).where("_all = 0")
    saved = lost.select(*[F.col(f"_most.{c}").alias(c) for c in ROW], F.lit(True).alias("_saved"))
    kept = taken.join(saved, list(ROW), "left").withColumn("_times", F.greatest("_times", F.coalesce(F.col("_saved").cast("int"), F.lit(0))))
    copies = kept.where("_times > 0").select(*ROW, "slots", F.explode(F.expr("sequence(0, _times - 1)")).alias("_copy"))
    # A document whose second part rounds up has slots enough, as that part lies in one of its own.
    slot = F.coalesce(F.get("slots", F.col("_copy")), F.element_at("slots", -1))
    placed = rows.join(copies.select(*ROW, slot.alias("_slot")), list(ROW))
    return placed.orderBy("_slot", *ROW).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    NULL text is an empty document of one token, repeated rows are documents of their own, an empty table has no pieces.
    """
    settle(spark)
    return pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
