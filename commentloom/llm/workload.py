"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.llm import quality
from commentloom.llm.attribution import section_tokens
from commentloom.llm.bit_codes import nearest_vectors
from commentloom.llm.block_naming import exact_dedup
from commentloom.llm.collocations import collocations
from commentloom.llm.html_text import extract_text
from commentloom.llm.minhash_join import near_duplicates
from commentloom.llm.mixing import mixed
from commentloom.llm.packing import pack_documents
from commentloom.llm.preference import MOST_CHARS, learned_chars, preference_turns, render_preferences, rendered_chars, swapped_replies
from commentloom.llm.rp_forest import near_duplicate_vectors
from commentloom.llm.scratch import stored
from commentloom.llm.url_rank import judge_urls
from commentloom.llm.whitening import whiten
from commentloom.session import configure


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_rp_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, folder, "embeddings"))


def op2_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Per pair and part a checksum of the rendered text, its characters, learned ones and a digest of the turns in order.

    Pairs beyond ``MOST_CHARS`` have no texts in one row and so no checksums of them; their turns count all the same.
    """
    turns = stored(preference_turns(*swapped_replies(table(spark, folder, "conversations"))), "turns")
    texts = render_preferences(turns)
    role, text = F.col("role"), F.coalesce("text", F.lit(""))
    chars = F.length(text).cast("long")
    code = F.conv(F.substring(F.md5(F.concat(F.coalesce(role, F.lit("")), F.lit(":"), F.md5(text))), 1, 15), 16, 10).cast("decimal(19,0)")
    kinds = ("prompt", "chosen", "rejected")
    parts = turns.groupBy("pair_id").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("part") == p, value)), F.lit(0)).alias(f"{p}_{name}")
            for p in kinds
            for name, value in (
                ("chars", rendered_chars(role, chars)), ("learned", learned_chars(role, chars)), ("digest", code * (F.col("place") + 1)),
            )
        ]
    )

    def masked(part: str) -> Column:
        """Learned characters by the mask, or where there is none by the turns."""
        spans = F.aggregate(f"{part}_mask", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
        return F.coalesce(spans, F.col(f"{part}_learned")).alias(f"{part}_learned")

    return texts.join(parts, "pair_id").select(
        "pair_id", "prompt_turns", *[F.md5(p).alias(f"{p}_md5") for p in kinds],
        *[F.coalesce(F.length(p).cast("long"), F.col(f"{p}_chars")).alias(f"{p}_chars") for p in kinds], masked("chosen"), masked("rejected"),
        *[F.col(f"{p}_digest").cast("decimal(38,0)").cast("string").alias(f"{p}_digest") for p in kinds],
    )


def op3_shortest_pack_first(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))


def op4_nb_support_vectors(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted"
    )


def op5_link_graph(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))


def op6_offset_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return section_tokens(table(spark, folder, "documents"))


def op7_minhash_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op8_host_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op9_low_discrepancy_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix by document; first_slot is -1 where it takes none of it."""
    return mixed(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "n_slots", F.coalesce(F.get("slots", F.lit(0)), F.lit(-1)).alias("first_slot")
    )


def op10_block_naming(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op11_rotated_bit_codes(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_vectors(table(spark, folder, "embeddings"))


def op12_multiplicity_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op13_weighted_automata(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


QUERIES = {
    "op1_rp_forest": op1_rp_forest,
    "op2_preference_pairs": op2_preference_pairs,
    "op3_shortest_pack_first": op3_shortest_pack_first,
    "op4_nb_support_vectors": op4_nb_support_vectors,
    "op5_link_graph": op5_link_graph,
    "op6_offset_attribution": op6_offset_attribution,
    "op7_minhash_join": op7_minhash_join,
    "op8_host_suffixes": op8_host_suffixes,
    "op9_low_discrepancy_mix": op9_low_discrepancy_mix,
    "op10_block_naming": op10_block_naming,
    "op11_rotated_bit_codes": op11_rotated_bit_codes,
    "op12_multiplicity_whitening": op12_multiplicity_whitening,
    "op13_weighted_automata": op13_weighted_automata,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Turns of both sides in order, and the first place where they differ.
_PAIRS = """
    WITH turns AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS body, md5(coalesce(text, '')) AS text, coalesce(length(text), 0) AS chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS nth
      FROM conversations WHERE conv_id IS NOT NULL),
    replies AS (
      SELECT conv_id, max(nth) AS last, row_number() OVER (ORDER BY conv_id) - 1 AS k, count(*) OVER () AS n
      FROM turns WHERE role = 'assistant' GROUP BY conv_id),
    both_sides AS (
      SELECT a.conv_id AS pair_id, a.last, t.turn, o.text AS other, o.body AS other_body, o.chars AS other_chars
      FROM replies a JOIN replies b ON b.k = CASE WHEN xor(a.k, 1) < a.n THEN xor(a.k, 1) ELSE 0 END AND a.k <> b.k
      JOIN turns t ON t.conv_id = a.conv_id AND t.nth = a.last JOIN turns o ON o.conv_id = b.conv_id AND o.nth = b.last),
    sides AS (
      SELECT 'chosen' AS side, pair_id, t.turn, role, text, body, chars FROM turns t JOIN both_sides ON conv_id = pair_id
      UNION ALL
      SELECT 'rejected', pair_id, t.turn, role, text, body, chars FROM turns t JOIN both_sides ON conv_id = pair_id
      WHERE nth < last
      UNION ALL
      SELECT 'rejected', pair_id, turn, 'assistant', other, other_body, other_chars FROM both_sides),
    placed AS (
      SELECT *, coalesce(role, '') AS named,
        row_number() OVER (PARTITION BY side, pair_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) - 1 AS place
      FROM sides),
    common AS (
      SELECT coalesce(c.pair_id, r.pair_id) AS pair_id,
        coalesce(min(CASE WHEN c.named = r.named AND c.text = r.text THEN NULL ELSE coalesce(c.place, r.place) END),
          count(*)) AS prompt_turns
      FROM (SELECT * FROM placed WHERE side = 'chosen') c
      FULL JOIN (SELECT * FROM placed WHERE side = 'rejected') r ON c.pair_id = r.pair_id AND c.place = r.place
      GROUP BY 1),
    parts AS (
      SELECT p.pair_id, prompt_turns, CASE WHEN place < prompt_turns THEN 'prompt' ELSE side END AS part,
        place, '<|' || named || '|>' || chr(10) || body || '<|end|>' || chr(10) AS piece,
        chars + length(named) + 13 AS chars, CASE WHEN role = 'assistant' THEN chars + 8 ELSE 0 END AS learned,
        CAST('0x' || substr(md5(named || ':' || text), 1, 15) AS HUGEINT) * (place + 1) AS code
      FROM placed p JOIN common c ON p.pair_id = c.pair_id WHERE place >= prompt_turns OR side = 'chosen')"""


def _of_parts(name: str, value: str, kind: str, parts: tuple[str, ...] = ("prompt", "chosen", "rejected")) -> str:
    return ", ".join(f"CAST(coalesce(sum({value}) FILTER (part = '{p}'), 0) AS {kind}) AS {p}_{name}" for p in parts)


# Checksums of the rendered texts of pairs up to the size that is joined.
_TEXTS = ", ".join(
    f"CASE WHEN sum(chars) <= {MOST_CHARS} THEN md5(coalesce(string_agg(piece, '' ORDER BY place) FILTER (part = '{p}'), '')) END AS {p}_md5"
    for p in ("prompt", "chosen", "rejected")
)

ORACLES = {
    "op2_preference_pairs": f"""{_PAIRS}
        SELECT pair_id, CAST(prompt_turns AS BIGINT) AS prompt_turns, {_TEXTS}, {_of_parts("chars", "chars", "BIGINT")},
          {_of_parts("learned", "learned", "BIGINT", ("chosen", "rejected"))}, {_of_parts("digest", "code", "VARCHAR")}
        FROM parts GROUP BY pair_id, prompt_turns""",
    # Sources stop at three times their size: in the order of cap per weight the capped ones come
    # first. A source's words are then taken from the front of its shuffled documents, in rounds.
    "op9_low_discrepancy_mix": """
        WITH d AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
            md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS o
          FROM documents),
        s AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS n,
            row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r
          FROM d GROUP BY source),
        w AS (SELECT *, r % 3 + 1 AS weight, 3 * n AS cap FROM s),
        c AS (
          SELECT *, CAST(cap AS DOUBLE) / weight AS ratio,
            CAST(sum(n) OVER () - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, r
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
              / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, r
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS share
          FROM w),
        t AS (
          SELECT source, n, r, least(CAST(cap AS DOUBLE),
            coalesce(max(CASE WHEN ratio > share THEN share END) OVER (), 0) * weight) AS target
          FROM c),
        b AS (
          SELECT *, least(3 * n, CAST(floor(target + 0.5) AS BIGINT)) AS words,
            CAST(ceil(words / 256) AS BIGINT) AS blocks,
            CAST(sum(blocks) OVER (ORDER BY r) AS BIGINT) AS high, high - blocks AS low,
            greatest(1, length(ltrim(bin(greatest(sum(blocks) OVER (), 1) - 1), '0'))) AS bits
          FROM t),
        -- Every point of the sequence, the source that it falls to, and its rank there.
        p AS (
          SELECT i, list_sum(list_transform(range(bits), lambda k: ((i >> k) & 1) << (bits - 1 - k))) AS v
          FROM (SELECT bits, unnest(range(1 << bits)) AS i FROM (SELECT any_value(CAST(bits AS INTEGER)) AS bits FROM b))),
        q AS (
          SELECT b.r, i AS slot, row_number() OVER (PARTITION BY b.r ORDER BY i) - 1 AS block
          FROM p JOIN b ON v >= low AND v < high),
        x AS (
          SELECT d.*, b.n, b.r, b.target, words,
            CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS f
          FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
        y AS (
          SELECT *, greatest(0, least(size, words - f)) AS t0, greatest(0, least(size, words - n - f)) AS t1,
            greatest(0, least(size, words - 2 * n - f)) AS t2
          FROM x)
        SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, target, CAST(t0 + t1 + t2 AS BIGINT) AS taken,
          CAST(CASE WHEN t0 > 0 THEN (f + t0 - 1) // 256 - f // 256 + 1 ELSE 0 END
            + CASE WHEN t1 > 0 THEN (n + f + t1 - 1) // 256 - (n + f) // 256 + 1 ELSE 0 END
            + CASE WHEN t2 > 0 THEN (2 * n + f + t2 - 1) // 256 - (2 * n + f) // 256 + 1 ELSE 0 END AS BIGINT) AS n_slots,
          CAST(CASE WHEN t0 > 0 THEN q.slot ELSE -1 END AS BIGINT) AS first_slot
        FROM y LEFT JOIN q ON q.r = y.r AND q.block = f // 256""",
    "op10_block_naming": f"""
        WITH texts AS (SELECT doc_id, {_LOWER} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
          count(*) OVER (PARTITION BY t) AS group_size,
          doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM texts""",
    # The score is worked out from the first entry to the last, in doubles.
    "op11_rotated_bit_codes": """
        WITH v AS (
          SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND len(q.e) = len(c.e) AND (q.vec_id, q.e) <> (c.vec_id, c.e))
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
          vec_id, score
        FROM s QUALIFY rank <= 20""",
    "op13_weighted_automata": f"""
        WITH p AS (
          SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
          FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
        g AS (
          SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS ph
          FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS t(m))),
        c AS (SELECT lang, m, ph, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30 ),
        t AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
        d AS (SELECT lang, m, ph, f AS a, string_split(ph, ' ') AS s FROM c WHERE m >= 2),
        k AS (
          SELECT d.lang, d.ph, d.m, d.a, k, x.f AS l, y.f AS r, CAST(2000000 AS HUGEINT) * d.a // (x.f + y.f) AS score
          FROM (SELECT *, unnest(range(1, m)) AS k FROM d) d
          JOIN c x ON x.lang = d.lang AND x.ph = array_to_string(d.s[1:k], ' ')
          JOIN c y ON y.lang = d.lang AND y.ph = array_to_string(d.s[k + 1:], ' ')
          QUALIFY row_number() OVER (PARTITION BY d.lang, d.ph ORDER BY score, k) = 1),
        inside AS (
          SELECT lang, array_to_string(s[i:i + z - 1], ' ') AS ph, max(a) AS most
          FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS z FROM d)) GROUP BY ALL)
        SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, k.ph) AS rank,
          k.ph AS phrase, a, l, r, CAST(t.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM k JOIN t ON t.lang = k.lang LEFT JOIN inside i ON i.lang = k.lang AND i.ph = k.ph
        WHERE NOT coalesce(100 * CAST(most AS HUGEINT) >= 80 * CAST(a AS HUGEINT), false)
        QUALIFY rank <= 2000""",
}
