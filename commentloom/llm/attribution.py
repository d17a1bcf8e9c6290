"""Token counts per section: whole documents are encoded once and tokens are put to sections by offset.

A section is a stretch of characters of a document. Tokens run through the document without gaps, so
both are sorted intervals and meet in one merge. A token that crosses a border belongs to the
section that holds its first byte. The counts of a document's sections therefore add up to its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.tokens import tokenizer, vocabulary_path


def line_sections(text: bytes) -> np.ndarray:
    """First byte of each line; the line break belongs to the line that it ends."""
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.append(0, breaks[breaks < len(text)])


def section_tokens(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    fields: tuple[str, ...] = (),
    vocabulary: str | None = None,
) -> DataFrame:
    """doc_id, section, start_char, n_chars, n_tokens, crossing and doc_tokens of every section.

    The sections of a document are its lines, or, with ``fields``, these text columns, which are joined by line breaks and
    encoded as one document (a NULL field is an empty section; a break belongs to the field before it). ``crossing``
    counts the section's tokens that reach into later ones. A NULL or empty text is one section
    without tokens. Repeated rows give their sections each. An empty table gives an empty result.
    """
    path = vocabulary or vocabulary_path()
    columns = fields or (text,)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(c).alias(f"_f{i}") for i, c in enumerate(columns)])

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path)
        # Bytes of each token, by id.
        sizes = np.zeros(max(encoder.ranks.values()) + 1, dtype=np.int64)
        for token, number in encoder.ranks.items():
            sizes[number] = len(token)
        for batch in batches:
            rows, found = [], []
            texts = [batch.column(f"_f{i}").to_pylist() for i in range(len(columns))]
            for at, parts in enumerate(zip(*texts)):
                parts = [p or "" for p in parts]
                whole = "\n".join(parts)
                raw = whole.encode()
                if fields:
                    ends = np.cumsum([len(p.encode()) + 1 for p in parts])
                    starts = np.minimum(np.append(0, ends[:-1]), len(raw))
                else:
                    starts = line_sections(raw)
                chunks = encoder.chunks(whole)
                encoded = encoder.encode_chunks(chunks)
                lengths = _token_bytes(encoder, chunks, encoded, sizes)
                first = np.cumsum(lengths) - lengths
                found.append(_allocate(raw, starts, first, lengths))
                rows.append(np.full(len(starts), at))
            order = np.concatenate(rows) if rows else np.empty(0, np.int64)
            table = np.concatenate(found) if found else np.empty((0, 6), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(order)), *[pa.array(c) for c in np.ascontiguousarray(table.T)]],
                names=["doc_id", "section", "start_char", "n_chars", "n_tokens", "crossing", "doc_tokens"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in ("section", "start_char", "n_chars", "n_tokens", "crossing", "doc_tokens"))
    return chosen.mapInArrow(attribute, f"doc_id {kind}, {counts}")


def _token_bytes(encoder, chunks: list[str], encoded: list[bytes], sizes: np.ndarray) -> np.ndarray:
    ids = np.frombuffer(b"".join(encoded), "<u4")
    known = ids < len(sizes)
    lengths = sizes[np.where(known, ids, 0)]
    if not known.all():  # special tokens, whose text is not among the ranks
        for at in np.flatnonzero(~known):
            lengths[at] = len(encoder.tokenizer.id_to_token(int(ids[at])).encode())
    return lengths


def _allocate(raw: bytes, starts: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of (section, start_char, n_chars, n_tokens, crossing, doc_tokens)."""
    # Characters ahead of each byte: all bytes but those that continue a character.
    heads = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    owner = np.searchsorted(starts, first, side="right") - 1
    ends = np.append(starts[1:], len(raw))
    crossing = (first + lengths) > ends[owner] if len(first) else np.empty(0, bool)
    count = len(starts)
    return np.stack(
        [
            np.arange(count),
            heads[starts],
            heads[ends] - heads[starts],
            np.bincount(owner, minlength=count),
            np.bincount(owner[crossing], minlength=count),
            np.full(count, len(first)),
        ],
        axis=1,
    ).astype(np.int64)
