"""Dedup, mixing, packing, quality and attribution against brute force on small awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.llm import quality
from commentloom.llm.attribution import section_tokens
from commentloom.llm.block_naming import exact_dedup
from commentloom.llm.minhash_join import least_matches, near_duplicates
from commentloom.llm.mixing import mix_schedule, mixed, word_count
from commentloom.llm.packing import pack_documents, shortest_pack_first
from commentloom.llm.tokens import tokenizer, vocabulary_path

WORDS = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Extra columns carry names that the operators use inside.
SCHEMA = "doc_id bigint, text string, source string, row_id bigint, name string, cls int, size int, pair string, _text int"


def words(rng, n, kinds=400):
    return " ".join(f"w{int(kinds * rng.random() ** 2)}" for _ in range(n))


def make_rows():
    rng = random.Random(3)
    base = words(rng, 120)
    rows = [(None, "x y z", None), (1, None, "a"), (2, "", "a"), (3, "  \n", None), (4, "One", "b"), (5, "oNE", "b"),
            (6, "É one", "c"), (7, "é one", "c"), (8, "b", "d"), (8, "b", "d"), (9, "x  y\tz", "d")]
    long_text = words(rng, 9000)
    rows += [(10, long_text, "a"), (11, long_text.upper(), "b"), (12, long_text + " end", "c")]
    for i in range(40):  # near copies of one text: most are linked by it alone
        near = base.split(" ")
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(len(near))] = f"edit{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(near), "hot"))
    rows += [(200 + i, words(rng, rng.randint(1, 60)), rng.choice("abc")) for i in range(60)]
    rows += [(300 + i, base + " " + words(rng, 130), "hot") for i in range(20)]
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, 0, "n", 1, 2, "p", 3) for i, t, s in ROWS], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, width):
    found = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1)))


@pytest.mark.parametrize("block", [4, 1024])
def test_exact_dedup(docs, block):
    found = exact_dedup(docs, block_bytes=block).collect()
    groups = collections.defaultdict(list)
    for i, t, _ in ROWS:
        groups[(t or "").translate(LOWER)].append(i)
    want = collections.Counter()
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: -1 if i is None else i)
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    assert sum(r.kept for r in found) == len(groups)


def test_exact_dedup_by_bytes_where_hashes_meet(docs, monkeypatch):
    plain = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup(docs, block_bytes=64).collect()}
    from commentloom.llm import block_naming

    real = F.xxhash64
    monkeypatch.setattr(block_naming.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(7)))
    weak = {(r.doc_id, r.keep_id, r.group_size) for r in block_naming.exact_dedup(docs, block_bytes=64).collect()}
    assert weak == plain


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, width, percent):
    sets = [shingles(t, width) for _, t, _ in ROWS]
    parent = list(range(len(ROWS)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ROWS)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[find(a)] = find(b)
    members = collections.defaultdict(list)
    for a, (i, _, _) in enumerate(ROWS):
        members[find(a)].append(i)
    want = collections.Counter()
    for a, (i, _, _) in enumerate(ROWS):
        least = min((x for x in members[find(a)] if x is not None), default=None)
        want[(i, len(sets[a]), least, i is not None and i == least)] += 1
    found = near_duplicates(docs, width=width, percent=percent).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == want
    assert sum(r.shown for r in found) == len(members)


def test_long_lists_are_cut_and_nothing_is_lost(docs, monkeypatch):
    from commentloom.llm import minhash_join

    whole = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    monkeypatch.setattr(minhash_join, "LONG_LIST", 2)
    monkeypatch.setattr(minhash_join, "BLOCK_ROWS", 4)
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()} == whole


def test_joins_beyond_the_broadcast_bounds_give_the_same_rows(docs, monkeypatch):
    from commentloom.llm import minhash_join, packing

    near = {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
    pieces = collections.Counter((r.doc_id, r.start, r.length) for r in pack_documents(docs).collect())
    monkeypatch.setattr(minhash_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(packing, "BROADCAST_PLACES", 0)
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()} == near
    packed = pack_documents(docs).collect()
    assert collections.Counter((r.doc_id, r.start, r.length) for r in packed) == pieces
    # Gapless in every sequence.
    held = collections.defaultdict(list)
    for r in packed:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]


def test_match_threshold():
    assert least_matches(1, 0.5, 1e-9) == 1
    assert least_matches(32, 0.85**3, 1e-5) == 8


def test_mixing(docs):
    rows = mixed(docs, block_words=16).collect()
    again = mixed(docs.repartition(3), block_words=16).collect()
    key = lambda r: (r.doc_id or 0, r.size, r.taken, r.source or "")
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert len(rows) == len(ROWS) and all(r.taken <= 3 * r["size"] for r in rows)
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, open_names, left = {}, set(names), sum(sizes.values())
    while True:  # share by weight, stop at the caps, share the excess again
        unit = left / sum(weights[s] for s in open_names)
        full = {s for s in open_names if unit * weights[s] >= 3 * sizes[s]}
        if not full:
            want |= {s: unit * weights[s] for s in open_names}
            break
        want |= {s: 3 * sizes[s] for s in full}
        left -= sum(want[s] for s in full)
        open_names -= full
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 1


def test_mixing_schedule_is_even(docs):
    schedule = mix_schedule(docs, block_words=16)
    slots = schedule.groupBy("slot", "source_rank").agg(F.sum("length").alias("n")).orderBy("slot").collect()
    total, seen = collections.Counter(), collections.Counter()
    for s in slots:
        total[s.source_rank] += 1
    for i, s in enumerate(slots, 1):
        seen[s.source_rank] += 1
        for r, n in total.items():
            assert abs(seen[r] - i * n / len(slots)) <= 6


def test_slots_follow_the_sequence(docs):
    """Slots against the sequence itself: each point, its bits turned round, falls to a source; blocks take a source's points in turn."""
    schedule = mix_schedule(docs, block_words=16).collect()
    blocks = {(r.source_rank, r.block) for r in schedule}
    counts = collections.Counter(rank for rank, _ in blocks)
    total = sum(counts.values())
    bits = max(1, (total - 1).bit_length())
    low, owner = 0, []
    for rank in sorted(counts):
        owner += [rank] * counts[rank]
    taken, slot_of = collections.Counter(), {}
    for slot in range(1 << bits):
        point = int(f"{slot:0{bits}b}"[::-1], 2)
        if point < total:
            slot_of[owner[point], taken[owner[point]]] = slot
            taken[owner[point]] += 1
    assert all(slot_of[r.source_rank, r.block] == r.slot for r in schedule) and len(schedule) > 300
    by_row = collections.defaultdict(set)
    starts = collections.defaultdict(dict)
    for r in schedule:
        by_row[r.row_id].add((r.repeat, r.slot))
        starts[r.row_id].setdefault(r.repeat, r.slot)
        starts[r.row_id][r.repeat] = min(starts[r.row_id][r.repeat], r.slot)
    rows = mixed(docs, block_words=16).collect()
    # Row numbers are given anew in each run: compare what rows hold.
    got = collections.Counter((r.n_slots, tuple(r.slots)) for r in rows if r.taken)
    want = collections.Counter((len(s), tuple(v for _, v in sorted(starts[i].items()))) for i, s in by_row.items())
    assert got == want


def test_mixing_counts_words_without_listing_them(spark):
    rng = random.Random(8)
    # White space of other kinds, signs beyond 16 bits and those that mean something in a replacement are parts of words.
    signs = " \t\n\x0b\f\r" * 2 + "aé漢😀\x1c\x85\u2003.$\\"
    texts = [None, "", " ", "\r\n \t", "a", " a", "a ", " $1 \\ "] + ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(500)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = docs.select("text", word_count(F.col("text")).alias("n"))
    assert [r["n"] for r in found.collect()] == [len(WORDS.findall(t or "")) for t in texts]
    # A list of its words is many times a text's size; one of ten million words passes here.
    assert "extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()
    long = spark.range(1).select(F.repeat(F.lit("ab cd "), 5_000_000).alias("text"))
    assert long.select(word_count(F.col("text")).alias("n")).first()["n"] == 10_000_000


def test_mixing_spreads_equal_rows(spark):
    # Half of all rows are one document: they are laid one after another like any others.
    rows = [(7, "a b c", "s")] * 6000 + [(None, f"w{i} x", "s") for i in range(3000)] + [(i, "one two three four", "t") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    found = mixed(docs).collect()
    assert len(found) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in found)
    for s in "st":
        mine = [r for r in found if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1
    again = mixed(docs.repartition(3)).collect()
    key = lambda r: (r.doc_id or 0, r.size, r.taken, tuple(r.slots))
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_packing(docs):
    found = pack_documents(docs, sequence=64, keep_ids=True).collect()
    plain = tokenizer(vocabulary_path()).tokenizer
    want = collections.Counter()
    for i, t, _ in ROWS:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 64):
            piece = ids[start : start + 64]
            want[(i, start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(ids), tuple(piece))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, tuple(r.ids)) for r in found) == want
    ends = collections.defaultdict(list)
    for r in found:
        ends[r.sequence_id].append((r.offset, r.length))
    for places in ends.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(ends) == list(range(len(ends)))


def test_histogram_packing_places_all():
    rng = random.Random(1)
    histogram = {rng.randint(1, 1023): rng.randint(1, 5000) for _ in range(700)}
    patterns = shortest_pack_first(histogram, 1024)
    used, tokens = collections.Counter(), 0
    for count, pattern in patterns:
        assert sum(length * copies for length, copies in pattern) <= 1024
        for length, copies in pattern:
            used[length] += count * copies
    assert used == histogram
    tokens = sum(length * n for length, n in histogram.items())
    assert tokens / (1024 * sum(c for c, _ in patterns)) > 0.95


def test_chunked_ids_are_those_of_the_whole_text():
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "'s", "b1", " ", "　", "\x1c", "\x85", "é", "!", "日本", "<|endoftext|>", "word", "​"]
    chunked = tokenizer(vocabulary_path())
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(chunked.encode(text), "<u4").tolist() == chunked.tokenizer.encode(text, add_special_tokens=False).ids


def test_attribution(docs):
    texts = {400: "a\n\nbé 日本\n", 401: None, 402: "one line", 403: "\n"}
    more = docs.sparkSession.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    plain = tokenizer(vocabulary_path()).tokenizer
    found = collections.defaultdict(list)
    for r in section_tokens(more).orderBy("doc_id", "section").collect():
        found[r.doc_id].append(tuple(r)[1:])
    for i, text in texts.items():
        lines = (text or "").splitlines(keepends=True) or [""]
        starts = np.cumsum([0] + [len(x) for x in lines])
        tokens = plain.encode(text or "", add_special_tokens=False).offsets
        want = []
        for k, line in enumerate(lines):
            mine = [t for t in tokens if starts[k] <= t[0] < starts[k + 1]]
            want.append((k, int(starts[k]), len(line), len(mine), sum(t[1] > starts[k + 1] for t in mine), len(tokens)))
        assert found[i] == want
    sums = section_tokens(docs).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.sum("n_chars").alias("c")).collect()
    chars = collections.Counter()
    for i, t, _ in ROWS:
        chars[i] += len(t or "")
    assert {r.doc_id: r.c for r in sums} == chars
    fields = section_tokens(docs.limit(5), fields=("text", "source")).groupBy("section").count().collect()
    assert {r.section for r in fields} == {0, 1}


def test_quality_learns_from_its_folds_only(spark):
    rng = random.Random(5)
    rows, labels = [(None, "null id"), (10**6, None), (10**6 + 1, "")], []
    for i in range(600):
        good = i % 2
        text = words(rng, rng.randint(5, 80))
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split())))
        out = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, (1 - good) if out else good))  # held-out labels are wrong on purpose
    labels += [(None, 1), (10**7, 0), (3, None)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, score int, quality int")
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    found = quality.score(docs, model).withColumn("held_out", quality.held_out("doc_id")).collect()
    assert len(found) == len(rows)
    right = [r.predicted == r.doc_id % 2 for r in found if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    empty = quality.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.predicted for r in quality.score(docs, empty).collect()} == {1}


def test_empty_tables(nothing):
    assert exact_dedup(nothing).count() == 0
    assert near_duplicates(nothing).count() == 0
    assert mixed(nothing).count() == 0
    assert pack_documents(nothing).count() == 0
    assert section_tokens(nothing).count() == 0
    labels = nothing.sparkSession.createDataFrame([], "doc_id bigint, quality int")
    assert quality.score(nothing, quality.fit(nothing, labels)).count() == 0
    assert isinstance(exact_dedup(nothing).schema["doc_id"].dataType, T.LongType)


def test_ratios_dual_solution_and_score_against_a_second_computation():
    rng = np.random.default_rng(4)
    size = 1 << quality.BUCKET_BITS
    sets, labels = [], []
    for i in range(60):
        label = i % 2
        own = rng.integers(0, 40, 12) + 30 * label
        sets.append(np.unique(np.concatenate([own, rng.integers(0, 200, 10)])).astype(np.uint32))
        labels.append(label)
    labels = np.array(labels)
    ratios = quality.log_count_ratios(sets, labels)
    for bucket in (0, 35, 69, 150, 5000):
        shares = []
        for label in (1, 0):
            counts = [sum(bucket in s for s, q in zip(sets, labels) if q == label), sum(len(s) for s, q in zip(sets, labels) if q == label)]
            shares.append((counts[0] + 1) / (counts[1] + size))
        assert ratios[bucket] == pytest.approx(math.log(shares[0] / shares[1]))
    signs = np.where(labels == 1, 1.0, -1.0)
    weights, bias = quality.dual_coordinate_descent(sets, signs, ratios, rounds=500, close=1e-10)
    # The primal problem, |w|^2 / 2 + b^2 / 2 + C * sum(max(0, 1 - y f)^2), has its minimum where its gradient is zero.
    table = np.zeros((len(sets), size))
    for i, s in enumerate(sets):
        table[i, s] = ratios[s] / np.sqrt((ratios[s] ** 2).sum())
    slack = np.maximum(0, 1 - signs * (table @ weights + bias))
    gradient = weights - 2 * quality.COST * (signs * slack) @ table
    assert np.abs(gradient).max() < 1e-6 and abs(bias - 2 * quality.COST * (signs * slack).sum()) < 1e-6
    model = quality.fit_sets(sets, labels)
    margins = table @ model.weights + model.bias
    expected = 1 / (1 + np.exp(-(model.slope * margins + model.shift)))
    assert model.scores(sets) == pytest.approx(expected, abs=1e-9)
    assert (expected[labels == 1].mean() - expected[labels == 0].mean()) > 0.3


def test_the_fit_is_bounded_and_scores_long_texts_whole(spark):
    rng = random.Random(2)
    long_text = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(40000))
    assert len(quality.gram_buckets(long_text.encode())) > quality.FIT_BUCKETS
    few = quality.bounded(quality.gram_buckets(long_text.encode()))
    assert len(few) == quality.FIT_BUCKETS == len(set(few.tolist()))
    rows = [(i, ("good text here " if i % 2 else "BAD!!! ") * (5 + i % 7), i % 2) for i in range(200)] + [(1000, long_text, 1), (1001, "BAD!!! " * 90000, 0)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t, _ in rows], "doc_id bigint, text string, quality int, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    found = {r.doc_id: r.predicted for r in quality.score(docs, model).collect()}
    assert sum(found[i] == q for i, _, q in rows) >= 0.98 * len(rows) and found[1001] == 0
