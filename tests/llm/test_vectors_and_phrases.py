"""Vector search, whitening and collocations against brute force on small awkward tables."""

import collections
import math
import random
import re

import numpy as np
import pytest

from commentloom.llm import collocations as phrases
from commentloom.llm.bit_codes import encode, estimate, nearest_vectors
from commentloom.llm.count_automata import CountAutomaton, union
from commentloom.llm.whitening import whiten

NAMES = "key int, cls string, least int, copies int, width int, block int, side int, x string, n int, deviation int"
SCHEMA = f"vec_id bigint, embedding array<double>, {NAMES}"
FILL = (1, "c", 2, 3, 4, 5, 6, "x", 7, 8)


def vector_rows():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((6, 64))
    rows = [(i, (base[i % 6] + 0.4 * rng.standard_normal(64)).tolist()) for i in range(900)]
    copy = rows[7][1]
    rows += [(1000 + i, copy) for i in range(450)]  # a third of all rows are one vector
    rows += [(60, rows[60][1]), (60, rows[61][1])]  # a repeated row, and an id of two vectors
    rows += [(2000, None), (2020, [0.0] * 64), (2040, [math.nan] + [1.0] * 63), (2060, [None] + [1.0] * 63)]
    rows += [(2080, []), (None, copy), (2100, [1e300] * 64), (2120, (3 * np.array(copy)).tolist())]
    rows += [(2200 + i, rng.standard_normal(3).tolist()) for i in range(21)]
    rows += [(3000 + 20 * i, rng.standard_normal(3000).tolist()) for i in range(3)]
    return rows


VECTORS = vector_rows()


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*r, *FILL) for r in VECTORS], SCHEMA).repartition(7)


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], SCHEMA)


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def test_nearest_vectors(vectors, no_vectors):
    rows = [(i, tuple(v)) for i, v in VECTORS if i is not None and good(v) and any(v)]
    rows = list(dict.fromkeys(rows))
    expected = collections.Counter()
    for i, v in rows:
        if i % 20:
            continue
        near = []
        for j, u in rows:
            if len(u) == len(v) and (i, v) != (j, u):
                with np.errstate(over="ignore"):
                    near.append((-np.cumsum(np.array(v) * np.array(u))[-1], j))
        expected.update((i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:20]))
    found = nearest_vectors(vectors).collect()
    assert collections.Counter(map(tuple, found)) == expected
    assert {r["query_id"] for r in found} >= {60, 1000, 2100, 2220, 3040} and 2020 not in {r["query_id"] for r in found}
    assert nearest_vectors(no_vectors).collect() == []


def test_error_bounds_hold():
    rng = np.random.default_rng(2)
    data, queries = rng.standard_normal((3000, 64)) * 3, rng.standard_normal((40, 64))
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    middle, error = estimate(*encode(data), queries)
    outside = np.abs(middle - data @ queries.T) > error[:, None]
    assert outside.mean() < 0.004  # three deviations
    assert np.abs((middle - data @ queries.T).mean()) < 0.01


def whitened_by_hand(rows, components=16):
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = (distinct * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviations, ((x * n - sums) / n) @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_whitening(vectors, no_vectors):
    # The row of huge entries passes a long, so it is taken out here and tested apart.
    ids = [i for i, v in VECTORS if good(v) and len(v) == 64 and max(map(abs, v)) < 1e9]
    n, deviations, z, shares = whitened_by_hand([(i, v) for i, v in VECTORS if good(v) and len(v) == 64 and max(map(abs, v)) < 1e9])
    found = whiten(vectors.where("vec_id IS NULL OR vec_id <> 2100")).collect()
    assert len(found) == 16 * len(ids) and {r["n"] for r in found} == {n}
    assert collections.Counter(r["vec_id"] for r in found) == collections.Counter(ids * 16)
    by_row = collections.defaultdict(dict)
    for r in found:
        if r["vec_id"] is not None and r["vec_id"] != 60:
            by_row[r["vec_id"]][r["component"]] = r
    signs = {}
    for k, (i, deviation) in enumerate(zip(ids, deviations)):
        for c, r in by_row.get(i, {}).items():
            assert r["deviation"] == deviation
            assert abs(r["explained"] - shares[c - 1]) <= 1e-9
            sign = signs.setdefault(c, 1 if r["whitened"] * z[k, c - 1] >= 0 else -1)
            assert abs(sign * r["whitened"] - z[k, c - 1]) < 1e-6
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9
    assert whiten(no_vectors).collect() == []


def test_whitening_of_odd_vectors(spark):
    def run(rows, **options):
        return whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), **options).collect()

    # One vector only: nothing varies.
    alone = run([(1, [1.0, 2.0]), (1, [1.0, 2.0])])
    assert sorted((r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone) == [
        (1, 1, 0, None, None, None)] * 2 + [(2, 1, 0, None, None, None)] * 2
    # A constant entry has no variance.
    flat = run([(i, [float(i), 5.0]) for i in range(4)])
    assert {r["component"] for r in flat if r["whitened"] is None} == {2} and flat[0]["identity_error"] < 1e-9
    # Beyond a long there is no deviation, but the projection is still there.
    huge = run([(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])])
    assert {r["deviation"] for r in huge} == {None} and all(r["n"] == 3 for r in huge)
    # Counts as weights: the covariance of all rows.
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(30)] * 3 + [(99, [1.0] * 5)] * 60
    by_count = run(rows, by_count=True)
    z = np.array([[r["whitened"] for r in sorted(by_count, key=lambda r: r["component"]) if r["vec_id"] == i][::3] for i, _ in rows[:30]])
    full = np.concatenate([z, z, z, np.tile([[r["whitened"] for r in sorted(by_count, key=lambda r: r["component"]) if r["vec_id"] == 99][::60]], (60, 1))])
    assert by_count[0]["n"] == 150 and np.abs(full.T @ full / 150 - np.eye(5)).max() < 1e-9


def test_count_automata():
    rng = np.random.default_rng(0)
    for size in (1, 2, 3, 4):
        for rows in (0, 1, 5, 400):
            grams, counts = rng.integers(0, 6, (rows, size)).astype(np.uint64), rng.integers(1, 400, rows)
            expected = collections.Counter()
            for gram, count in zip(map(tuple, grams.tolist()), counts.tolist()):
                expected[gram] += count
            whole = CountAutomaton.unpack(CountAutomaton.of(grams, counts).pack())
            assert dict(zip(map(tuple, whole.grams().tolist()), whole.counts.tolist())) == dict(expected)
            asked = rng.integers(0, 8, (200, size)).astype(np.uint64)
            assert whole.lookup(asked).tolist() == [expected.get(tuple(a), 0) for a in asked.tolist()]
            half = rows // 2
            parts = [CountAutomaton.of(grams[:half], counts[:half]), CountAutomaton.of(grams[half:], counts[half:])]
            assert union(parts).pack() == whole.pack()
            assert len(whole.kept(300)) == sum(c >= 300 for c in expected.values())


TEXTS = "doc_id bigint, text string, lang string, size int, range int, automaton string, label int, word string, n int, w0 int, a int"


def phrase_rows():
    rng = random.Random(9)
    vocabulary = ["alpha", "Beta", "gamma", "de", "la", "Ünter", "x y", "zeta-9"]
    rows = []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        marks = [rng.choice([" ", "  ", "\t", ", ", ".", "\n", "; "] + [" "] * 12) for _ in words]
        rows.append(("".join(w + m for w, m in zip(words, marks)), rng.choice(["en", "en", "de", None, "und"])))
    rows += [("new york city hall", "en")] * 200 + [("NEW YORK", "en")] * 20 + [("go go go go go go", "fr")] * 40
    rows += [(None, "en"), ("", "es"), (" ,.\n", "es"), ("long word " * 30000, "xx")]
    return rows


def phrases_by_hand(rows, least=30, first=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    result = set()
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        most = collections.Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i : i + m]] = max(most[p[i : i + m]], a)
        ranked = []
        for p, a in candidates.items():
            if 100 * most[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:first], 1):
            result.add((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return result


def test_collocations(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame([(1, t, g, 2, 3, "a", 4, "w", 5, 6, 7) for t, g in rows], TEXTS).repartition(6)
    found = phrases.collocations(docs).collect()
    assert len(found) == len(set(found)) and set(map(tuple, found)) == phrases_by_hand(rows)
    assert {r["lang"] for r in found} >= {"en", "de", "und", "fr", "xx"}
    few = phrases.collocations(docs, first=3).collect()
    assert set(map(tuple, few)) == phrases_by_hand(rows, first=3)
    assert phrases.collocations(spark.createDataFrame([], TEXTS)).collect() == []


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 50)
    rng = random.Random(4)
    long_text = "".join(rng.choice(["a b c", "d e.", "f, ", "gg " * 30, "\n"]) for _ in range(200)).encode()
    chunks = list(phrases._chunks([b"x y", long_text, b"", b"z" * 300, b"end."]))

    def pieces(raw):
        return [p.split() for p in re.split(b"[.,;:!?\n-\r]", raw) if p.split()]

    found = [p for c in chunks for p in pieces(c)]
    expected = [p for t in (b"x y", long_text, b"", b"z" * 300, b"end.") for p in pieces(t)]
    assert sorted(found) == sorted(expected) and len(chunks) > 50


def test_shard_grams_with_many_words():
    # So many words that keys of four pass 64 bits and are numbered on the way.
    labels = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 100_000, dtype=np.uint64))
    stream = np.concatenate([labels, labels[:1000], labels[:1000]])
    every = phrases.Filter(np.full(1, (1 << 64) - 1, np.uint64), 58)
    grams, counts = phrases.shard_grams(stream, np.zeros(len(stream), np.int64), 4, every)
    expected = collections.Counter(zip(*(stream[i : len(stream) - 3 + i].tolist() for i in range(4))))
    assert dict(zip(map(tuple, grams.tolist()), counts.tolist())) == dict(expected)
    assert grams.tolist() == sorted(grams.tolist())


def test_scores_are_exact_beyond_64_bits():
    a = np.array([5 * 10**17, 3], np.int64)
    left, right = np.array([9 * 10**17, 4], np.int64), np.array([7 * 10**17 + 1, 9], np.int64)
    assert phrases.cut_scores(a, left, right).tolist() == [2_000_000 * int(x) // (int(y) + int(z)) for x, y, z in zip(a, left, right)]
