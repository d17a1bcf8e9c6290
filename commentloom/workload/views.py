"""Comments and videos derived from the given tables, with every special case put in.

The same SELECT runs on Spark and on the checking engine. All rows of the base tables are used
and every text stays whole; a CASE only puts words in front of some of them. The short and missing texts that
triage has to deal with are rows of their own, with ids of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commentloom.session import configure
from commentloom.sources.tables import union_all

EPOCH = 1704067200  # 2024-01-01 UTC
SLOTS = 1296000  # two-second slots in 30 days

# Comments from documents get even seconds and those from conversations odd ones, so that
# (comment_id, published_at) is a key although the ids overlap.
DOCUMENT_COMMENTS = """
SELECT 'youtube#comment' AS kind, doc_id AS comment_id, doc_id % 7 AS channel_id,
  CASE WHEN doc_id % 97 = 0 THEN NULL
       WHEN doc_id % 3 = 0 THEN 'v0' ELSE concat('v', CAST(doc_id % 23 AS STRING)) END AS video_id,
  doc_id % 151 AS author_id,
  CASE doc_id % 13
    WHEN 3 THEN concat('see https://x.example ', text)
    WHEN 4 THEN concat('I LOVE this brand so much ', text)
    WHEN 5 THEN concat('which SPF serum broke out ', text)
    WHEN 6 THEN concat('where can i buy it ', text)
    WHEN 7 THEN concat('it broke out my skin ', text)
    WHEN 8 THEN concat('Obsessed with it ok ', text)
    WHEN 10 THEN concat('HTTP://up.example shows how to blend it ', text)
    ELSE text END AS text_original,
  CASE WHEN doc_id % 3 = 0 THEN doc_id - 1 END AS parent_comment_id,
  CAST(n_chars AS DOUBLE) AS like_count,
  {ts}(({epoch} + ((doc_id * 7919) % {slots}) * 2){scale}) AS published_at,
  {ts}(({epoch} + ((doc_id * 7919) % {slots}) * 2){scale}) AS updated_at
FROM {documents}
UNION ALL
SELECT 'youtube#comment' AS kind, -1 - doc_id AS comment_id, doc_id % 7 AS channel_id,
  CASE WHEN doc_id % 3 = 0 THEN 'v0' ELSE concat('v', CAST(doc_id % 23 AS STRING)) END AS video_id,
  doc_id % 151 AS author_id,
  CASE doc_id % 13 WHEN 1 THEN '' WHEN 2 THEN ' ok ' WHEN 9 THEN 'nice one here' END AS text_original,
  CASE WHEN doc_id % 2 = 0 THEN doc_id END AS parent_comment_id,
  CAST(0 AS DOUBLE) AS like_count,
  {ts}(({epoch} + ((doc_id * 7919) % {slots}) * 2){scale}) AS published_at,
  {ts}(({epoch} + ((doc_id * 7919) % {slots}) * 2){scale}) AS updated_at
FROM {documents} WHERE doc_id % 13 IN (0, 1, 2, 9)
"""

CONVERSATION_COMMENTS = """
SELECT 'youtube#comment' AS kind, conv_id AS comment_id, conv_id % 7 AS channel_id,
  CASE role WHEN 'system' THEN concat('gone', CAST(conv_id AS STRING))
            ELSE concat('v', CAST(conv_id % 400 AS STRING)) END AS video_id,
  turn AS author_id, text AS text_original,
  CASE WHEN turn > 0 THEN conv_id END AS parent_comment_id,
  CAST(turn AS DOUBLE) AS like_count,
  {ts}(({epoch} + ((conv_id * 7919) % {slots} + turn) * 2 + 1){scale}) AS published_at,
  {ts}(({epoch} + ((conv_id * 7919) % {slots} + turn) * 2 + 1){scale}) AS updated_at
FROM {conversations}
"""

STAGED_VIDEOS = """
SELECT 'youtube#video' AS kind, concat('v', CAST(page_id AS STRING)) AS video_id,
  {ts}(({epoch} + ((page_id * 7919) % {slots}) * 2){scale}) AS published_at,
  CAST(page_id % 7 AS STRING) AS channel_id, url AS title,
  CASE page_id % 5 WHEN 1 THEN concat('#ad Great #beauty_tips video ', html)
    WHEN 3 THEN concat('C# and # alone #été! ', html) ELSE html END AS description,
  CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'a,b' END AS tags,
  CASE page_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'en-US' WHEN 2 THEN '' WHEN 3 THEN 'PT-br'
    WHEN 4 THEN 'xx' ELSE 'zh-Hant' END AS default_language,
  CASE page_id % 4 WHEN 0 THEN 'fr' WHEN 1 THEN NULL WHEN 2 THEN 'ko-KR' ELSE 'sv' END
    AS default_audio_language,
  CASE page_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'PT34M30S' WHEN 3 THEN 'P1DT2H'
    WHEN 4 THEN 'P1W' WHEN 5 THEN concat('PT', CAST(page_id AS STRING), 'S') WHEN 6 THEN 'bad'
    WHEN 7 THEN 'P' ELSE 'PT1H2M3S' END AS content_duration,
  CASE WHEN page_id % 10 = 0 THEN NULL ELSE CAST(page_id * 37 AS DOUBLE) END AS view_count,
  CAST(page_id * 3 AS DOUBLE) AS like_count, CAST(NULL AS DOUBLE) AS favourite_count,
  CAST(page_id % 50 AS DOUBLE) AS comment_count,
  CASE page_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN '[]' WHEN 3 THEN 'not a list'
    WHEN 4 THEN '["https://e.example/wiki/Fashion"]'
    WHEN 5 THEN '[''https://e.example/wiki/Hair_care'', ''https://e.example/'']'
    ELSE '["https://e.example/wiki/Physical_attractiveness", "https://e.example/wiki/Lifestyle_(sociology)"]'
    END AS topic_categories
FROM {pages}
UNION ALL
SELECT 'youtube#video' AS kind, concat('x', CAST(page_id AS STRING)) AS video_id,
  {ts}(({epoch} + ((page_id * 7919) % {slots}) * 2 + 1){scale}) AS published_at,
  CAST(page_id % 7 AS STRING) AS channel_id, url AS title,
  CASE page_id % 5 WHEN 2 THEN ' plain text ' WHEN 3 THEN concat('C# and # alone #été! ', url) END AS description,
  CAST(NULL AS STRING) AS tags, CAST(NULL AS STRING) AS default_language,
  'ko-KR' AS default_audio_language, 'PT1S' AS content_duration,
  CAST(NULL AS DOUBLE) AS view_count, CAST(page_id * 3 AS DOUBLE) AS like_count,
  CAST(NULL AS DOUBLE) AS favourite_count, CAST(0 AS DOUBLE) AS comment_count,
  '[]' AS topic_categories
FROM {pages} WHERE page_id % 5 IN (0, 2, 3)
"""

# A later delivery of videos: some ids are known from the pages, most are new.
UPDATED_VIDEOS = """
SELECT 'youtube#video' AS kind, concat('v', CAST(doc_id AS STRING)) AS video_id,
  {ts}(({epoch} + {slots} * 2 + doc_id){scale}) AS published_at,
  CAST(quality AS STRING) AS channel_id, concat('update ', CAST(doc_id AS STRING)) AS title,
  CASE WHEN quality = 1 THEN '#new take two' END AS description, CAST(NULL AS STRING) AS tags,
  CASE WHEN toxic = 1 THEN 'de-AT' END AS default_language,
  CAST(NULL AS STRING) AS default_audio_language,
  concat('PT', CAST(doc_id AS STRING), 'M') AS content_duration,
  CASE WHEN toxic = 1 THEN NULL ELSE CAST(doc_id * 11 AS DOUBLE) END AS view_count,
  CAST(doc_id AS DOUBLE) AS like_count, CAST(quality AS DOUBLE) AS favourite_count,
  CAST(toxic AS DOUBLE) AS comment_count, CAST(NULL AS STRING) AS topic_categories
FROM {labels}
"""

# Comments that an earlier run has enriched.
ENRICHED_IDS = "SELECT doc_id AS comment_id FROM {labels}"


def _spark_sql(template: str) -> str:
    names = {n: "{" + n + "}" for n in ("documents", "conversations", "pages", "labels")}
    return template.format(ts="timestamp_seconds", epoch=EPOCH, slots=SLOTS, scale="", **names)


def duck_sql(template: str) -> str:
    names = {n: n for n in ("documents", "conversations", "pages", "labels")}
    return template.format(
        ts="make_timestamp", epoch=EPOCH, slots=SLOTS, scale=" * 1000000", **names
    ).replace("AS STRING", "AS VARCHAR")


class Views:
    """The derived tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        # The file source takes a folder or a pattern; this pattern names the one file or folder.
        pattern = f"{self.folder}/{name}.parque[t]"
        return self.spark.readStream.schema(self.table(name).schema).parquet(pattern)

    def _select(self, template: str, **tables: DataFrame) -> DataFrame:
        return self.spark.sql(_spark_sql(template), **tables)

    def shared_out(self, name: str, *by: str) -> DataFrame:
        """A table dealt out over the session's shuffle partitions: the given files are one split each."""
        return self.table(name).repartition(*by)

    def documents(self) -> DataFrame:
        return self.shared_out("documents", "doc_id")

    def comments(self) -> DataFrame:
        """All comments, texts shared out for costly expressions."""
        return self._select(DOCUMENT_COMMENTS, documents=self.documents()).unionByName(
            self._select(
                CONVERSATION_COMMENTS,
                conversations=self.shared_out("conversations", "conv_id", "turn"),
            )
        )

    def comment_exports(self) -> list[DataFrame]:
        """The two parts of the comments, as two files would deliver them."""
        return [
            self._select(DOCUMENT_COMMENTS, documents=self.table("documents")),
            self._select(CONVERSATION_COMMENTS, conversations=self.table("conversations")),
        ]

    def comment_keys(self) -> DataFrame:
        """All comments as they lie in the files, for operators that read few narrow columns."""
        return union_all(*self.comment_exports())

    def comment_stream(self) -> DataFrame:
        return self._select(DOCUMENT_COMMENTS, documents=self.stream("documents")).unionByName(
            self._select(CONVERSATION_COMMENTS, conversations=self.stream("conversations"))
        )

    def comment_deliveries(self) -> list[DataFrame]:
        """The two parts of the comments as streams."""
        return [
            self._select(DOCUMENT_COMMENTS, documents=self.stream("documents")),
            self._select(CONVERSATION_COMMENTS, conversations=self.stream("conversations")),
        ]

    def staging(self) -> DataFrame:
        return self._select(STAGED_VIDEOS, pages=self.shared_out("pages", "page_id"))

    def staging_stream(self) -> DataFrame:
        return self._select(STAGED_VIDEOS, pages=self.stream("pages"))

    def updates(self) -> DataFrame:
        return self._select(UPDATED_VIDEOS, labels=self.table("labels"))

    def update_stream(self) -> DataFrame:
        return self._select(UPDATED_VIDEOS, labels=self.stream("labels"))

    def enriched_ids(self) -> DataFrame:
        return self._select(ENRICHED_IDS, labels=self.table("labels"))
