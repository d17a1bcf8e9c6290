"""CSV exports, bound to a declared layout by position or by header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.schemas import (
    CAMEL_VIDEO_COLUMNS,
    COMMENTS,
    RAW_COMMENTS,
    STAGING_VIDEOS,
)
from commentloom.sources.tables import evolve_schema, union_all


# Stands for NULL while a file is read: with the empty string in this place quoted empty fields would be NULL too.
_NO_VALUE = "\ue000null\ue000"


def _reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return spark.read.options(
        header=True, multiLine=multi_line, quote='"', escape='"', mode="FAILFAST", maxColumns=100_000,
        nullValue=_NO_VALUE,
    )


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    names: Mapping[str, str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """One or more files with a header line as one table; a bad row fails the load.

    Columns go by position, or by header name if ``names`` maps headers to columns of the schema;
    a header that it does not know becomes a text column. Inside quotes two of them are one. An unquoted empty
    field is NULL, a quoted one is an empty string; a quote inside an unquoted field is a character. A quote that is never closed
    takes what follows into its field, which fails unless the number of fields happens to fit. In files whose lines end in
    carriage return and line feed, such ends inside quotes come out as line feeds. A file whose quotes hold line breaks
    is one task, so large exports are best delivered in several files; without such breaks ``multi_line=False`` reads any file in splits.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not names:
        return _reader(spark, multi_line).schema(schema).csv(paths)
    by_name = {f.name: f for f in schema.fields}
    # Files with equal headers are read together; only headers are looked at here.
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file in spark.read.format("binaryFile").load(paths).inputFiles():
        layouts.setdefault(tuple(_reader(spark, multi_line).csv(file).columns), []).append(file)
    parts = []
    for columns, same in layouts.items():
        known = [by_name.get(names.get(c, "")) for c in columns]
        layout = T.StructType([k or T.StructField(c, T.StringType()) for c, k in zip(columns, known)])
        parts.append(_reader(spark, multi_line).schema(layout).csv(same))
    return union_all(*parts) if parts else spark.createDataFrame([], schema)


def load_videos_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_csv(spark, paths, STAGING_VIDEOS)


def load_comments_csv(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """All comment files as one table, with the enrichment columns still NULL."""
    return evolve_schema(read_csv(spark, paths, RAW_COMMENTS, multi_line=multi_line), COMMENTS)


def load_videos_camel(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The video export with camelCase headers, each file bound by its own header."""
    return read_csv(spark, paths, STAGING_VIDEOS, CAMEL_VIDEO_COLUMNS)


def write_csv(df: DataFrame, path: str) -> None:
    """Write in the form that ``read_csv`` takes: NULL as nothing, an empty string as ""."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    stamped = df.withColumns(
        {n: F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX") for n in names}
    )
    stamped.write.options(
        header="true",
        quote='"',
        escape='"',
        nullValue="",
        emptyValue='""',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
