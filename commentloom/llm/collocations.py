"""Collocations: phrases that are frequent for what their parts are.

N-grams are counted level by level. A shard of texts sorts its n-grams and builds count automata
from them, one per range of labels; the automata of a range are united, counts added up, and n-grams below the
least count go. A longer n-gram is looked at only where the n-grams inside it may be frequent: a bit
filter of bounded size tells, which may say yes in vain but never no. Parts of phrases are then looked up by sending them to the
automata of their ranges, where a part also learns the largest count of a longer phrase that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.llm.count_automata import CountAutomaton, union
from commentloom.llm.scratch import stored
from commentloom.llm.shingles import BASE, LETTERS, mixed, powers

LONGEST = 4
LEAST = 30
FIRST = 2000
CONTAINED_PERCENT = 80
SCORE_UNIT = 2_000_000
NO_LANG = "und"

# Text hashed at once, words sorted at once, words that a range of n-grams stands for.
CHUNK_BYTES, SHARD_WORDS, RANGE_WORDS = 4 << 20, 1 << 22, 1 << 18
# N-grams that a task holds before it unites them.
UNITE_ROWS = 1 << 20
# Bits per frequent n-gram in a filter, and the most bits of one (16 MB).
FILTER_SHARE, FILTER_BITS = 16, 1 << 27

_PIECE_SIGNS = np.zeros(256, dtype=bool)
_PIECE_SIGNS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _PIECE_SIGNS.copy()
_GAPS[[0x20, 0x09]] = True
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

_AUTOMATA = "lang string, size int, range bigint, automaton binary"
_WORDS = [f"w{i}" for i in range(LONGEST)]


def lang_seed(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def labelled_words(raw: bytes, lang: str) -> tuple[np.ndarray, ...]:
    """(label, number of the piece, start, end) of each word. Labels hang on the lower-cased word and the language."""
    text = np.frombuffer(raw, dtype=np.uint8)
    if not len(text):
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
    gap = _GAPS[text]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate(([0], edge))
    if not gap[-1]:
        edge = np.append(edge, len(text))
    starts, ends = edge[0::2], edge[1::2]
    up, down = powers.upto(len(text))
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(LETTERS[text] * up, out=sums[1:])
    labels = mixed(mixed((sums[ends] - sums[starts]) * down[starts]) ^ lang_seed(lang))
    pieces = np.cumsum(_PIECE_SIGNS[text], dtype=np.int64)[starts]
    return labels, pieces, starts, ends


def _chunks(texts: list[bytes]) -> Iterator[bytes]:
    """The texts, each a piece or more, in stretches of bounded size; long texts are cut between pieces."""
    held, size = [], 0
    for text in texts:
        if len(text) > CHUNK_BYTES:
            signs = _PIECE_SIGNS[np.frombuffer(text, np.uint8)]
            at = 0
            while at < len(text):
                cut = at + CHUNK_BYTES
                if cut < len(text):
                    # The last sign within reach, or else the next one after it.
                    near = np.flatnonzero(signs[at:cut])
                    far = signs[cut:].argmax() if len(near) == 0 else 0
                    cut = at + near[-1] + 1 if len(near) else (cut + far + 1 if signs[cut + far] else len(text))
                yield text[at:cut]
                at = cut
            continue
        held.append(text)
        size += len(text) + 1
        if size > CHUNK_BYTES:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    langs = batch.column("lang").to_pylist()
    for lang in dict.fromkeys(langs):
        for chunk in _chunks([t for t, at in zip(texts, langs) if at == lang]):
            yield lang, chunk


@dataclass(frozen=True)
class Filter:
    """One bit per hashed n-gram, set for those that are frequent; no n-gram is said to be rare that is not."""

    words: np.ndarray
    shift: int

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(self.shift)
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def fit_filter(keys: DataFrame) -> Filter:
    """From the column ``key`` (longs). At most ``FILTER_BITS`` bits reach the driver and the tasks."""
    count = keys.count()
    bits = max(6, min(FILTER_BITS.bit_length() - 1, (FILTER_SHARE * max(count, 1)).bit_length()))
    place = F.shiftrightunsigned("key", 64 - bits)
    one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 AS int))")
    rows = keys.groupBy(F.shiftrightunsigned(place, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return Filter(words, 64 - bits)


def gram_keys(columns: list[np.ndarray]) -> np.ndarray:
    """One number per n-gram from the labels of its words."""
    value = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for column in columns:
        value = mixed(value * np.uint64(BASE) + column)
    return value


def ranges(grams: np.ndarray, bits: int) -> np.ndarray:
    """The range of each n-gram: the highest bits of all its labels, so that no single beginning fills a range."""
    size = grams.shape[1]
    found = np.zeros(len(grams), dtype=np.uint64)
    for i in range(size):
        width = bits // size + (i < bits % size)
        if width:
            found = (found << np.uint64(width)) | (grams[:, i] >> np.uint64(64 - width))
    return found.astype(np.int64)


def _automata(lang: str, grams: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple]:
    """(lang, size, range, automaton) from sorted n-grams."""
    where = ranges(grams, bits)
    order = np.argsort(where, kind="stable")
    starts = np.flatnonzero(np.diff(where[order], prepend=-1))
    for start, end in zip(starts, np.append(starts[1:], len(order))):
        part = order[start:end]
        yield lang, grams.shape[1], int(where[part[0]]), CountAutomaton.build(grams[part], counts[part]).pack()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    lang, size, where, automaton = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(where, pa.int64()), pa.array(automaton, pa.binary())],
        names=["lang", "size", "range", "automaton"],
    )


def shard_grams(labels: np.ndarray, pieces: np.ndarray, size: int, frequent: Filter) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts), sorted, of those whose two parts of one word less may both be frequent."""
    count = len(labels) - size + 1
    if count < 1:
        return np.empty((0, size), np.uint64), np.empty(0, np.int64)
    parts = gram_keys([labels[i : len(labels) - size + 2 + i] for i in range(size - 1)])
    good = frequent(parts)
    del parts
    at = np.flatnonzero(good[:-1] & good[1:] & (pieces[:count] == pieces[size - 1 :]))
    # Only the words of n-grams that stay are numbered.
    used = np.zeros(len(labels), dtype=bool)
    for i in range(size):
        used[at + i] = True
    names = np.unique(labels[used])
    number = np.zeros(len(labels), dtype=np.uint32)
    number[used] = np.searchsorted(names, labels[used])
    del used
    key, space = number[at].astype(np.uint64), len(names)
    for i in range(1, size):
        if space * len(names) >= 1 << 64:
            # Numbers of the beginnings instead of their keys: order and equality stay.
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
            space = int(key.max(initial=0)) + 1
        key = key * np.uint64(len(names)) + number[at + i].astype(np.uint64)
        space *= len(names)
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return labels[at[first][:, None] + np.arange(size)], counts


def count_words(docs: DataFrame) -> DataFrame:
    """lang, label, word and n of all words of the columns lang and text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw in _by_lang(batch):
                labels, _, starts, ends = labelled_words(raw, lang)
                names, first, counts = np.unique(labels, return_index=True, return_counts=True)
                text = raw.translate(_LOWER)
                words = [text[s:e] for s, e in zip(starts[first], ends[first])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array(names.view(np.int64)),
                     pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts)],
                    names=["lang", "label", "word", "n"],
                )

    counted = docs.mapInArrow(count, "lang string, label bigint, word string, n bigint")
    return stored(counted.groupBy("lang", "label", "word").agg(F.sum("n").alias("n")), "words")


def united(parts: DataFrame, least: int) -> DataFrame:
    """One automaton per language, size and range, with the n-grams of at least ``least``."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, size = None, [], 0

        def close() -> list[tuple]:
            whole = union(held).kept(least)
            return [(*current, whole.pack())] if len(whole) else []

        for batch in batches:
            out = []
            for lang, length, where, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (lang, length, where) != current:
                    out += close() if current else []
                    current, held, size = (lang, length, where), [], 0
                held.append(CountAutomaton.unpack(data))
                size += len(held[-1])
                if size > UNITE_ROWS and len(held) > 1:
                    # What a range holds in the end is bounded by its different n-grams, not by the shards.
                    held = [union(held)]
                    size = len(held[0]) // 2
            yield _batch(out)
        if current:
            yield _batch(close())

    keys = ["lang", "size", "range"]
    return stored(parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(unite, _AUTOMATA), "automata")


def count_grams(docs: DataFrame, size: int, frequent: Filter, bits: dict[str, int], least: int) -> DataFrame:
    """Automata of the frequent n-grams of one size; ``frequent`` knows those of one word less."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, widths = shared.value
        held: dict[str, list] = {}
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, shards in held.items():
                labels, pieces = (np.concatenate(p) for p in zip(*shards))
                shards.clear()
                grams, counts = shard_grams(labels, pieces, size, known)
                yield _batch(list(_automata(lang, grams, counts, widths.get(lang, 0))))

        for batch in batches:
            for lang, raw in _by_lang(batch):
                labels, pieces, _, _ = labelled_words(raw, lang)
                if not len(labels):
                    continue
                before = held.setdefault(lang, [])
                # Pieces go on counting from stretch to stretch.
                at = int(before[-1][1][-1]) + 1 if before else 0
                # Only neighbours are compared, so narrow numbers do.
                before.append((labels, (pieces + at).astype(np.int32)))
                total += len(labels)
                if total >= SHARD_WORDS:
                    yield from flush()
                    held, total = {}, 0
        yield from flush()

    found = united(docs.mapInArrow(count, _AUTOMATA), least)
    # Only now, as nothing is worked out from the broadcast again: the result is stored.
    shared.unpersist()
    return found


def _keys_of(automata: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("automaton").to_pylist():
                grams = CountAutomaton.unpack(data).grams()
                yield pa.RecordBatch.from_arrays([pa.array(gram_keys(list(grams.T)).view(np.int64))], names=["key"])

    return automata.mapInArrow(keys, "key bigint")


def _word_automata(words: DataFrame, bits: dict[str, int]) -> DataFrame:
    """The automata of single words, in the same form."""
    shared = words.sparkSession.sparkContext.broadcast(bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            langs = batch.column("lang").to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(langs):
                mine = np.flatnonzero(langs == lang)
                labels = batch.column("label").to_numpy().view(np.uint64)[mine]
                order = np.argsort(labels)
                counts = batch.column("n").to_numpy()[mine][order]
                rows += _automata(lang, labels[order][:, None], counts, shared.value.get(lang, 0))
            yield _batch(rows)

    return united(words.select("lang", "label", "n").mapInArrow(build, _AUTOMATA), 1)


_REQUEST = (
    "lang string, size int, range bigint, kind int, automaton binary, from_size int, from_range bigint, "
    + ", ".join(f"{w} bigint" for w in _WORDS)
    + ", n bigint, asked boolean"
)
_REQUEST_NAMES = [c.strip().split()[0] for c in _REQUEST.split(",")]


def _requests(lang, size, where, kind, from_size, from_range, grams, n, asked) -> pa.RecordBatch:
    """Rows of parts with a number each; the arguments are single values or arrays."""
    rows = len(grams)

    def full(value, dtype):
        return pa.array(np.broadcast_to(np.asarray(value), rows), dtype)

    words = [pa.array(grams[:, i].view(np.int64)) if i < grams.shape[1] else pa.nulls(rows, pa.int64()) for i in range(LONGEST)]
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * rows, pa.string()), full(size, pa.int32()), full(where, pa.int64()), full(kind, pa.int32()),
         pa.nulls(rows, pa.binary()), full(from_size, pa.int32()), full(from_range, pa.int64()), *words,
         full(n, pa.int64()), full(asked, pa.bool_())],
        names=_REQUEST_NAMES,
    )


def _grams_of(run: pa.RecordBatch | pa.Table, size: int) -> np.ndarray:
    columns = [run.column(w).to_numpy().astype(np.int64).view(np.uint64) for w in _WORDS[:size]]
    return np.stack(columns, axis=1)


def _asked_parts(automata: DataFrame, bits: dict[str, int]) -> DataFrame:
    """The parts of all phrases, once per range of phrases, addressed to the parts' own ranges."""
    shared = automata.sparkSession.sparkContext.broadcast(bits)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, size, where, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                whole = CountAutomaton.unpack(data)
                grams = whole.grams()
                for length in range(1, size):
                    starts = range(size - length + 1)
                    parts = np.concatenate([grams[:, s : s + length] for s in starts])
                    longer = CountAutomaton.of(parts, np.tile(whole.counts, len(starts)), sums=False)
                    # Only beginnings and ends are parts of a cut; those in the middle are just told.
                    ends = CountAutomaton.of(
                        np.concatenate([grams[:, :length], grams[:, size - length :]]), np.ones(2 * len(grams), np.int64)
                    )
                    distinct = longer.grams()
                    yield _requests(
                        lang, length, ranges(distinct, shared.value.get(lang, 0)), 1, size, where,
                        distinct, longer.counts, ends.lookup(distinct) > 0,
                    )

    return automata.mapInArrow(ask, _REQUEST)


def _addressed(automata: DataFrame, requests: DataFrame) -> DataFrame:
    """Automata and what is sent to their ranges, the automaton first."""
    rows = automata.selectExpr(
        "lang", "size", "range", "0 AS kind", "automaton", "CAST(NULL AS int) AS from_size", "CAST(NULL AS bigint) AS from_range",
        *[f"CAST(NULL AS bigint) AS {w}" for w in _WORDS], "CAST(NULL AS bigint) AS n", "CAST(NULL AS boolean) AS asked",
    )
    keys = ["lang", "size", "range"]
    return rows.union(requests).repartition(*keys).sortWithinPartitions(*keys, "kind")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows of one (lang, size, range, kind)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lang = batch.column("lang").to_numpy(zero_copy_only=False)
        rest = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("size", "range", "kind")])
        differs = (lang[1:] != lang[:-1]) | (rest[:, 1:] != rest[:, :-1]).any(axis=0)
        cuts = np.flatnonzero(differs) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield (lang[start], *rest[:, start].tolist()), batch.slice(start, end - start)


def _composed(automata: DataFrame, requests: DataFrame) -> DataFrame:
    """Answers: the counts of parts (kind 1) to who asked, and (kind 2) to the parts themselves the counts of longer phrases."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        for (lang, size, where, kind), run in _runs(batches):
            if kind == 0:
                automaton = CountAutomaton.unpack(run.column("automaton")[0].as_py())
                continue
            grams = _grams_of(run, size)
            asked = run.column("asked").to_numpy(zero_copy_only=False).astype(bool)
            to_size, to_range = (run.column(c).to_numpy() for c in ("from_size", "from_range"))
            if asked.any():
                found = automaton.lookup(grams[asked])
                yield _requests(lang, to_size[asked], to_range[asked], 1, size, where, grams[asked], found, True)
            if size > 1:
                longer = CountAutomaton.of(grams, run.column("n").to_numpy(), sums=False)
                yield _requests(lang, size, where, 2, size, where, longer.grams(), longer.counts, False)

    return _addressed(automata, requests).mapInArrow(compose, _REQUEST)


_JUDGED = "lang string, " + ", ".join(f"{w} bigint" for w in _WORDS) + ", a bigint, l bigint, r bigint, score bigint"


def cut_scores(a: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """floor(SCORE_UNIT * a / (left + right)) in whole numbers of any size."""
    if int(a.max(initial=0)) < (1 << 62) // SCORE_UNIT:
        return SCORE_UNIT * a // (left + right)
    exact = SCORE_UNIT * a.astype(object) // (left.astype(object) + right.astype(object))
    return exact.astype(np.int64)


def _judged(automata: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """The phrases that no longer one stands for, with the parts and score of their worst cut."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, phrases, parts, longer = None, None, {}, []

        def close() -> pa.RecordBatch:
            lang, size = current
            grams, a = phrases.grams(), phrases.counts
            known = {n: CountAutomaton.of(*(np.concatenate(p) for p in zip(*found)), sums=False) for n, found in parts.items()}
            best = np.full(len(grams), np.iinfo(np.int64).max)
            left, right = np.zeros_like(best), np.zeros_like(best)
            for k in range(1, size):
                first, rest = known[k].lookup(grams[:, :k]), known[size - k].lookup(grams[:, k:])
                score = cut_scores(a, first, rest)
                lower = score < best
                best, left, right = (np.where(lower, new, old) for new, old in ((score, best), (first, left), (rest, right)))
            keep = np.ones(len(grams), dtype=bool)
            if longer:
                most = CountAutomaton.of(*(np.concatenate(p) for p in zip(*longer)), sums=False).lookup(grams)
                # In two steps, as a hundred times a count may pass 64 bits.
                whole, rest = np.divmod(a, 100)
                keep = most < whole * percent + -(-rest * percent // 100)
            grams = grams[keep]
            words = [pa.array(grams[:, i].view(np.int64)) if i < size else pa.nulls(len(grams), pa.int64()) for i in range(LONGEST)]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), *words, *[pa.array(v[keep]) for v in (a, left, right, best)]],
                names=["lang", *_WORDS, "a", "l", "r", "score"],
            )

        for (lang, size, where, kind), run in _runs(batches):
            if kind == 0:
                if phrases is not None:
                    yield close()
                current, parts, longer = (lang, size), {}, []
                phrases = CountAutomaton.unpack(run.column("automaton")[0].as_py())
            elif kind == 1:
                lengths, n = run.column("from_size").to_numpy(), run.column("n").to_numpy()
                for length in np.unique(lengths).tolist():
                    mine = np.flatnonzero(lengths == length)
                    parts.setdefault(length, []).append((_grams_of(run.take(pa.array(mine)), length), n[mine]))
            else:
                longer.append((_grams_of(run, size), run.column("n").to_numpy()))
        if phrases is not None:
            yield close()

    return stored(_addressed(automata, answers).mapInArrow(judge, _JUDGED), "judged")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    first: int = FIRST,
    percent: int = CONTAINED_PERCENT,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of two to four words of each language.

    Everything is per language, NULL being ``und``. Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line
    ends, and those into words at blanks and tabs. NULL and empty texts have no words; repeated rows count each; a language without
    frequent phrases gives no row, an empty table none at all. Other columns are ignored. Words are told apart by 64-bit labels; should
    two frequent words of a language share one, the run fails rather than mix them up.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    words = count_words(texts)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    # Only languages of more words than a range is meant for, so one row per so many words at most.
    large = sizes.where(F.col("n") > RANGE_WORDS).collect()
    bits = {r["lang"]: int(r["n"] // RANGE_WORDS).bit_length() for r in large}
    frequent = stored(words.where(F.col("n") >= least), "frequent")
    if frequent.groupBy("label").count().where("count > 1").limit(1).count():
        raise ValueError("two words share a label")
    levels = [_word_automata(frequent, bits)]
    known = fit_filter(_keys_of(levels[0]))
    for size in range(2, LONGEST + 1):
        levels.append(count_grams(texts, size, known, bits, least))
        if size < LONGEST:
            known = fit_filter(_keys_of(levels[-1]))
    phrases = levels[1].union(levels[2]).union(levels[3])
    answers = _composed(levels[0].union(phrases), _asked_parts(phrases, bits))
    judged = _judged(phrases, answers, percent)
    # Ties at the last place stay until the words are there to settle them.
    by_number = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = judged.withColumn("_place", F.rank().over(by_number)).where(F.col("_place") <= first).drop("_place")
    for w in _WORDS:
        names = frequent.select("lang", F.col("label").alias(w), F.col("word").alias(f"_{w}"))
        best = best.join(names, ["lang", w], "left")
    named = best.withColumn("phrase", F.concat_ws(" ", *[f"_{w}" for w in _WORDS]))
    by_phrase = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        named.withColumn("rank", F.row_number().over(by_phrase).cast("long"))
        .where(F.col("rank") <= first)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
