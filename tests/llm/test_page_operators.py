"""Vectors, pages, links and preferences against brute force, and the pipeline as a whole."""

import collections
import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from commentloom.llm import html_text, quality, scratch, workload
from commentloom.llm.html_text import extract_text, page_blocks, page_links
from commentloom.llm.mixing import mixed
from commentloom.llm.preference import format_preferences, preference_turns, swapped_replies
from commentloom.llm.rp_forest import SPILL, fit_borders, leaves_of, near_duplicate_vectors
from commentloom.llm.url_rank import host_edges, judge_urls, propagated

SF = "/root/testdata/sf0.001"


def test_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(1, None, 0), (2, [0.0] * 8, 0), (3, [1.0] * 7 + [None], 0), (4, [1.0] * 7 + [float("nan")], 0), (5, [1.0] * 8, None),
            (6, [], 1), (None, [1.0] * 8, 0), (7, [2.0] * 8, 0), (8, [1.0] * 8, 1), (9, [1.0] * 8, 0), (9, [1.0] * 8, 0), (10, [1.0] * 7, 0)]
    centre = rng.standard_normal((6, 8))
    for i in range(900):
        v = centre[i % 6] + rng.standard_normal(8) * (0.15 if i % 4 else 1.5)
        rows.append((100 + i, [float(np.float32(x)) for x in v], int(i % 2)))
    df = spark.createDataFrame([(i, v, l, 5, 6) for i, v, l in rows], "vec_id bigint, embedding array<float>, label int, copies int, leaf int")
    found = near_duplicate_vectors(df, leaf_rows=60).collect()
    ok = [v is not None and l is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, l in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.float32(rows[a][1]).astype(float), np.float32(rows[b][1]).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    parent[find(a)] = find(b)
    members = collections.defaultdict(list)
    for a, r in enumerate(rows):
        members[find(a)].append(r[0])
    want = collections.Counter()
    for a, r in enumerate(rows):
        least = min((x for x in members[find(a)] if x is not None), default=None)
        want[(r[0], links[a], least, r[0] is not None and r[0] == least)] += 1
    assert sum(links) > 1000
    got = collections.Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in found)
    assert sum((got & want).values()) >= 0.999 * len(rows)
    empty = spark.createDataFrame([], df.schema)
    assert near_duplicate_vectors(empty).count() == 0


@pytest.mark.parametrize("fit_rows", [8192, 200])
def test_deep_trees_lose_no_links_of_dense_groups(spark, fit_rows):
    """A dense third in a label of its own size, and skewed labels; with small samples nodes are fitted in several rounds."""
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((3600, 64))
    centre = rng.standard_normal(64)
    vectors[:1000] = centre / np.linalg.norm(centre) + np.sqrt(0.0204 / 64) * rng.standard_normal((1000, 64))
    vectors[1000:1300] = vectors[1300:1600] + 0.19 / 8 * np.linalg.norm(vectors[1300:1600], axis=1)[:, None] * rng.standard_normal((300, 64))
    labels = np.where(np.arange(3600) < 3000, 1, np.arange(3600) % 7)
    df = spark.createDataFrame(
        [(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(vectors, labels))], "vec_id int, embedding array<double>, label int"
    )
    found = {r.vec_id: r.n_links for r in near_duplicate_vectors(df, fit_rows=fit_rows).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = ((unit @ unit.T >= 0.98) & (labels[:, None] == labels)).sum(axis=1) - 1
    assert want.sum() > 100_000 and (want[1000:1600] > 0).sum() > 300
    assert sum(found[i] == n for i, n in enumerate(want)) >= 0.999 * len(want)


def test_borders_spare_dense_groups():
    """Comparisons of the forest stay far below all pairs, beside a dense third too, and leaves small without one."""
    rng = np.random.default_rng(7)
    margin = SPILL * np.sqrt(0.04) / 8 / 2
    for dense in (False, True):
        vectors = rng.standard_normal((6000, 64))
        if dense:
            centre = rng.standard_normal(64)
            vectors[:2000] = centre / np.linalg.norm(centre) + np.sqrt(0.0204 / 64) * rng.standard_normal((2000, 64))
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        borders, again = fit_borders(unit, len(unit), 0, margin, 32)
        _, leaf = leaves_of(unit, borders, 0, margin)
        sizes = np.unique(leaf, return_counts=True)[1]
        assert not again and (sizes.astype(float) ** 2).sum() < (0.2 if dense else 0.05) * 6000**2
        assert dense or sizes.max() <= 64


def test_long_vectors_and_repeated_rows(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((40, 3000))
    rows = [(i, base[i % 40].tolist(), 1) for i in range(120)]
    df = spark.createDataFrame(rows + rows[:3], "vec_id bigint, embedding array<double>, label int")
    found = near_duplicate_vectors(df).collect()
    assert len(found) == 123 and {r.component_id for r in found} == set(range(40))
    assert all(r.n_links == (3 if r.vec_id % 40 < 3 else 2) for r in found)


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body class="ad-free"><nav>menu</nav>
<div class="ad">buy</div><article><header>by line</header><h1>Head &amp;  line</h1><p>One<b> two</b><br>three<p>four
 five&nbsp;six</p><script>x("</p>")</script><form>send</form><!-- <p>no</p> --><ul><li>a</li><li>b</li></ul>
<section class="reader-comments"><p>first!</p></section><aside>more</aside>tail</article><footer>&copy; end</footer></body></html>"""


def blocks_by_kind(page):
    found = collections.defaultdict(list)
    for kind, text in page_blocks(page):
        found[kind].append(text)
    return found


def test_blocks_of_a_page():
    found = blocks_by_kind(PAGE)
    assert found["article"] == ["Head & line", "One two three", "four five six", "a", "b", "tail"]
    assert found["side"] == ["menu", "buy", "by line", "send", "first!", "more", "© end"] and len(found) == 2
    assert page_blocks("") == []
    assert blocks_by_kind("<article><p>a &am</p><p>b</p")["article"] == ["a &am", "b"]
    assert page_blocks("plain <i>text</i>") == [("open", "plain text")]
    items = blocks_by_kind("<article><ul><li class=ad>x<li>y</ul><p class='promo'>buy<div>z</div><p>end</article>")
    assert items["article"] == ["y", "z", "end"] and items["side"] == ["x", "buy"]
    assert page_blocks("<article>zero\u200bwidth\u00a0\u3000blank</article>") == [("article", "zero\u200bwidth blank")]


NAMED_PARTS = [
    '<article>One <section id="search-algorithms">two</section> three</article>',
    '<article>One <section class="related-work">two</section> three</article>',
    '<article>One <section class="menu-items">two</section> three</article>',
    '<article>One <p class="first notice-period">two</p> three</article>',
    '<article>One <h2 id="cookies">two</h2> three</article>',
    "<article>One <button>two</button> three</article>",
    '<article>One <b class="ad">two three</article>',
    '<article>One <span class="promo" hidden>two</span> three',
    '<article>One <p id="comments">two</p> three</article>',
]


def test_names_alone_cut_nothing_from_an_article(spark):
    rows = [(i, f"http://h{i}.x/1", page) for i, page in enumerate(NAMED_PARTS)]
    found = {r.page_id: r.text.split() for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found == {i: ["One", "two", "three"] for i in range(len(rows))}


def test_doubtful_parts_are_settled_by_the_host(spark):
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    offer = text(10)
    rows = [(i, f"http://big.x/{i}", f"<article><p>{text(20)}<div class=offer-widget>{offer} {i}</div></article>") for i in range(6)]
    rows += [(10 + i, f"http://small.x/{i}", f"<article><p>{text(20)}<div class=offer-widget>{text(10)}</div></article>") for i in range(6)]
    # A repeated run in the article itself is content.
    rows += [(20 + i, f"http://plain.x/{i}", f"<article><p>{offer}<p>{text(20)}</article>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r for r in extract_text(df).collect()}
    assert all(offer not in found[i].text and found[i].text.endswith(f"\n{i}") and found[i].n_repeated == 10 for i in range(6))
    assert all(len(found[10 + i].text.split()) == 30 and found[10 + i].n_repeated == 0 for i in range(6))
    assert all(offer in found[20 + i].text for i in range(6))


def test_repeated_runs_against_brute_force(spark):
    rng = random.Random(12)
    shared = [[f"s{k}_{i}" for i in range(rng.randint(6, 14))] for k in range(8)]
    rows, streams = [], {}
    for i in range(60):
        host = rng.choice("abc")
        words = []
        for _ in range(rng.randint(1, 5)):
            words += [f"own{i}_{rng.randrange(10**6)}" for _ in range(rng.randint(0, 6) if words else 12)]
            words += rng.choice(shared)[rng.randint(0, 3) :]
        streams[i] = (host, words)
        rows.append((i, f"http://{host}.x/{i}", " ".join(words)))
    rows += [(100, "http://z.x/9", rows[0][2]), (101, None, None), (102, "http://a.x/1", "")]
    pages = collections.defaultdict(set)  # (host, run) -> pages
    for i, (host, words) in streams.items():
        for at in range(len(words) - 7):
            pages[host, tuple(words[at : at + 8])].add(i)
    sizes = collections.Counter(host for host, words in streams.values() if len(words) >= 8)
    found = {r.page_id: r for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    changed = 0
    for i, (host, words) in streams.items():
        covered = set()
        for at in range(len(words) - 7):
            if len(pages[host, tuple(words[at : at + 8])]) >= max(2, min(5, sizes[host] // 2 + 1)):
                covered.update(range(at, at + 8))
        assert found[i].text == " ".join(w for at, w in enumerate(words) if at not in covered)
        assert found[i].n_repeated == len(covered)
        changed += bool(covered)
    assert changed > 10 and found[101].text == found[102].text == ""


def test_a_host_of_thousands_of_open_pages(spark):
    rows = [(i, "http://h.x/", f"<div>this very long line of words stands on each page</div><p>own{i}</p>") for i in range(4000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    found = extract_text(df).selectExpr("text = concat('own', page_id) AS same", "n_repeated").distinct().collect()
    assert [tuple(r) for r in found] == [(True, 10)]


@pytest.mark.parametrize("page", [
    "<html><head><title>x</title><body><article>A text</article>",
    "<head><title>x<body><article>A text</article>",
    "<head><meta name=a><script>'<p>'</script><article>A text</article>",
    "<svg/><article>A text</article><svg></svg>",
    "<svg viewBox='0 0 1 1'><path d=x><article>A text</article>",
    "<article><svg><title>t</title></svg>A text</article>",
    "<select><option>a<article>A text</article>",
    "<iframe src=x><article>A text</article>",
    "<main class='has-sidebar'>A text</main>",
    "<div class='sidebar'><main>A text</main></div>",
    "<div id='header-layout'><p>x</p><article>A text</article></div>",
    "<div id='header-layout'><article>A text</article></div><div class='related-posts'><article>no</article></div>",
    "<form id=all><div class=comments><article class='share'>A text</article></div></form>",
    "<article class='post category-social hasSidebar'>A text<div id=comments><article class=comment-body>no</article></div></article>",
])
def test_no_page_is_swallowed(page):
    assert blocks_by_kind(page)["article"] == ["A text"]


def test_extract_text(spark):
    shared = "this very line of words stands on each page of the host"
    rows = [(1, "http://H.x/1", PAGE), (2, "http://h.x/2", f"<div>{shared}</div><div>only here one</div>"),
            (3, "http://h.x/3", f"<div>{shared} and more</div><p>only there two</p>"),
            (4, "http://other.x/3", f"<div>{shared}</div>"), (5, None, None), (None, "", ""),
            (6, "http://h.x/4", "<article>" + "long " * 50000 + "</article>")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, row_id int")
    found = {r.page_id: r for r in extract_text(df).collect()}
    assert found[1].text == "Head & line\nOne two three\nfour five six\na\nb\ntail"
    assert found[2].text == "only here one"
    assert found[3].text == "and more\nonly there two"
    assert found[4].text == shared
    assert found[5].text == "" and found[None].text == "" and found[6].n_chars == 249999
    assert all(r.n_chars == len(r.text) for r in found.values())
    assert extract_text(df.limit(0)).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    story, quote, shared = text(80), text(9), text(12)
    near = story.split(" ")
    near[40] = "edited"
    pages = {1: ("h", story), 2: ("h", story), 3: ("h", " ".join(near)), 4: ("alone", story), 5: ("alone", story)}
    kept = {i: t for i, (_, t) in pages.items()}
    for i in range(10, 20):
        own = text(30)
        said = f"{own} {quote}" if i < 12 else own
        pages[i] = ("big", f"<div>{shared}</div><p>{said}</p>")
        kept[i] = said
    rows = [(i, f"http://{h}.x/{i}", t) for i, (h, t) in pages.items()]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r for r in extract_text(df).collect()}
    assert {i: r.text for i, r in found.items()} == kept
    assert {found[i].n_repeated for i in (1, 2, 3, 4, 5)} == {0} and found[10].n_repeated == 12


def test_link_graph(spark):
    a = lambda *hosts: " ".join(f"<A class=x href='http://{h}/'>x</a>" for h in hosts)
    pages = [(1, "http://good.org/fr/a", a("friend.example.com", "GOOD.org")), (2, "http://bad.net/x?y#z", ""),
             (3, "https://farm.com/a", a("bad.net", "bad.net")), (4, "http://friend.example.com/", a("bad.net", "good.org")),
             (5, "http://example.net/en/1", ""), (6, "HTTP://A.Example.com/de/1?q", None), (7, None, None), (8, "no scheme", ""),
             (9, "http://bad.net", ""), (10, "http://x.org/fr", ""), (11, "http://notexample.com/de/", "")]
    df = spark.createDataFrame([(*p, 1, 2) for p in pages], "page_id bigint, url string, html string, score int, host int")
    found = {r.page_id: r for r in judge_urls(df).collect()}
    assert [found[i].rule for i in range(1, 12)] == ["org/fr/", "net/", None, None, "example.net/en/", "example.com/de/", None, None, None, None, None]
    assert found[2].path == "/x" and found[9].path == "" and found[8].host == "" and found[6].host == "a.example.com"
    assert found[3].verdict == "block"  # all it links to is blocked
    assert found[4].verdict == "allow"  # trusted by good.org, which counts for more
    assert found[7].verdict == found[8].verdict == "allow"
    assert judge_urls(df.limit(0)).count() == 0


def test_links_of_a_page(spark):
    page = """<head><base href='//cdn.x/a/'><base href=http://other.x></head><!-- <a href="http://bad.net/">no</a> -->
        <script>x = '<a href="http://bad.net/">'</script><A HREF = http://one.x/p?q>1</A><a title='href="http://no.x"' href='h&#116;tp://two.x'>2</a>
        <a href="//three.x#f">3</a><a href="rel/path">4</a><a href="mailto:x@y.z">5</a><a name=x>6</a><area href="http://no.x">"""
    assert page_links(page) == ["http://one.x/p?q", "http://two.x", "http://three.x#f", "http://cdn.x/a/"]
    assert page_links("<a href='/x'>") == [] == page_links("")
    rows = [(1, "http://a.com/", page), (2, "http://c.com/", "<!-- <a href='http://bad.net/'></a> -->" ),
            (3, "http://d.com/", "<base href='http://bad.net/'><a href='x'>x</a>"), (4, "http://bad.net/", ""), (4, "http://bad.net/", ""),
            (5, "http://long.com/" + "x" * 100_000, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = collections.Counter((r.page_id, r.verdict) for r in judge_urls(df).collect())
    assert found == {(1, "allow"): 1, (2, "allow"): 1, (3, "block"): 1, (4, "block"): 2, (5, "allow"): 1}
    quoted = judge_urls(df, rules=[("bad.net", "/", "block"), ("d.com", "/it's", "block")]).collect()
    assert {r.rule for r in quoted} == {None, "bad.net/"}


def test_propagation_is_personalised_pagerank(spark):
    rng = random.Random(4)
    edges = sorted({(rng.randrange(12), rng.randrange(12)) for _ in range(40)})
    table = spark.createDataFrame([(f"h{x}", f"h{y}") for x, y in edges], "src string, dst string")
    seeds = spark.createDataFrame([(f"h{i}", i < 3) for i in range(12)], "host string, s boolean")
    found = {r.host: r.score for r in propagated(table, seeds, "s", rounds=7).collect()}
    out = collections.Counter(x for x, _ in edges)
    score = {i: 1 / 3 for i in range(3)}
    for _ in range(7):
        after = {i: 0.15 / 3 for i in range(3)}
        for x, y in edges:
            if x in score:
                after[y] = after.get(y, 0) + 0.85 * score[x] / out[x]
        score = after
    assert found.keys() == {f"h{i}" for i in score}
    assert all(found[f"h{i}"] == pytest.approx(s) for i, s in score.items())
    assert host_edges(spark.createDataFrame([], "host string, _html string")).count() == 0


def test_suffixes_are_sorted_for_pages_that_markup_settles(spark):
    menu = " ".join(f"entry{i}" for i in range(9))
    rows = [(i, f"http://{h}.net/{i}", f"<nav>{menu} page {i}</nav><article><p>text {i} {menu}</p></article>") for i, h in enumerate("aaab")]
    found = {r.page_id: r for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    # Runs are nine tokens and the one after them; article text keeps them.
    assert [found[i].n_beside for i in range(4)] == [10, 10, 10, 0]
    assert all(found[i].text == f"text {i} {menu}" and found[i].n_repeated == 0 for i in range(4))


def test_suffixes_of_sure_article_text_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    shared = [[f"s{k}_{i}" for i in range(rng.randint(7, 12))] for k in range(6)]
    rows, streams = [], {}
    for i in range(50):
        host = "aaab"[i % 4] if i < 46 else f"c{i % 2}"
        stream = lambda: sum(([f"own{i}_{rng.randrange(10**6)}", *rng.choice(shared)[rng.randint(0, 2) :]] for _ in range(rng.randint(1, 3))), [])
        menu, doubt, sure = stream() if i % 3 else [], stream() if i % 5 == 0 else [], stream()
        streams[i] = host, doubt + menu, sure, len(doubt)
        rows.append((i, f"http://{host}.x/{i}", f"<nav>{' '.join(menu)}</nav><article><p>{' '.join(sure)}</p><p class=ad-note>{' '.join(doubt)}</p></article>"))
    rows += [(100, rows[1][1], rows[1][2]), (101, rows[1][1], rows[1][2]), (102, None, None)]
    beside, anywhere = collections.defaultdict(set), collections.defaultdict(set)
    for i, (host, *both, _) in streams.items():
        for j, words in enumerate(both):
            for at in range(len(words) - 7):
                anywhere[host, tuple(words[at : at + 8])].add(i)
                if not j:
                    beside[host, tuple(words[at : at + 8])].add(i)
    enough = [collections.Counter(host for host, *both, _ in streams.values() if any(len(w) >= 8 for w in both[:n])) for n in (1, 2)]

    def covered(host, words, pages, counts):
        starts = [at for at in range(len(words) - 7) if len(pages[host, tuple(words[at : at + 8])]) >= max(2, min(5, counts[host] // 2 + 1))]
        return {at + k for at in starts for k in range(8)}

    monkeypatch.setattr(html_text, "MOST_HELD", 100)
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6)
    found = {r.page_id: r for r in extract_text(df).collect()}
    total = 0
    for i, (host, outside, sure, doubtful) in streams.items():
        gone, inside = covered(host, outside, beside, enough[0]), covered(host, sure, anywhere, enough[1])
        cut = [w for at, w in enumerate(outside[:doubtful]) if at not in gone]
        assert found[i].text == "\n".join(" ".join(x) for x in (sure, cut) if x)
        assert (found[i].n_repeated, found[i].n_beside) == (doubtful - len(cut), len(gone) - doubtful + len(cut))
        assert found[i].n_inside == len(inside)
        total += len(inside)
    assert total > 100 and all(tuple(found[i])[1:] == tuple(found[1])[1:] for i in (100, 101))


def test_texts_that_markup_settles_are_not_stored(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(html_text, "stored", lambda df, label: kept.append(scratch.stored(df, label)) or kept[-1])
    menu = " ".join(f"entry{i}" for i in range(9))
    rows = [(i, f"http://a.net/{i}", f"<nav>{menu}</nav><article><p>settled {i}</p></article>") for i in range(5)]
    rows += [(5, "http://a.net/5", f"<p>open text of its own {menu}</p>")]
    found = extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {(r.page_id, r.text, r.n_beside) for r in found.collect()} == {(i, f"settled {i}", 9) for i in range(5)} | {(5, "open text of its own", 0)}
    held = [str(r) for df in kept for r in df.collect()]
    assert any("open text" in row for row in held) and not any("settled" in row for row in held)


def test_query_renders_its_preferences(spark):
    found = workload.op2_preference_pairs(spark, SF)
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    texts = {r.pair_id: r for r in format_preferences(*swapped_replies(turns)).collect()}
    rows = found.collect()
    assert len(rows) == len(texts) > 0
    for r in rows:
        t = texts[r.pair_id]
        assert [r.prompt_md5, r.chosen_md5, r.rejected_md5] == [hashlib.md5(x.encode()).hexdigest() for x in (t.prompt, t.chosen, t.rejected)]
        assert r.chosen_learned == sum(m.end - m.start for m in t.chosen_mask)


def test_preferences(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hé"), (1, 1, "assistant", "no"), (1, 2, "user", None),
             (2, 0, "user", "x"), (3, 0, "assistant", "y"), (4, 0, "assistant", "alone"), (None, 0, "user", "z")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id bigint, turn bigint, role string, text string, pair_id int")
    chosen, rejected = swapped_replies(df)
    found = {r.pair_id: r for r in format_preferences(chosen, rejected).collect()}
    # 2 has no reply: 0 goes with 1, 3 with 4.
    assert found.keys() == {0, 1, 3, 4} and found[3].rejected == "<|assistant|>\nalone<|end|>\n"
    first = found[0]
    assert first.prompt == "<|user|>\nhi<|end|>\n" and first.prompt_turns == 1
    assert first.chosen == "<|assistant|>\nyes<|end|>\n" and first.rejected == "<|assistant|>\nno<|end|>\n"
    for text, mask, said in ((first.chosen, first.chosen_mask, "yes"), (first.rejected, first.rejected_mask, "no")):
        assert [text[m.start : m.end] for m in mask] == [said + "<|end|>\n"]
    assert found[1].chosen.endswith("<|user|>\n<|end|>\n") and len(found[1].chosen_mask) == 1
    same = format_preferences(chosen, chosen).collect()
    assert all(r.chosen == r.rejected == "" and not r.chosen_mask for r in same)
    assert format_preferences(*swapped_replies(df.limit(0))).count() == 0


def test_every_conversation_with_a_reply_has_a_pair(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, place int, part string, side string"
    rows = [(2 * i, t, r, f"{r} {i}", 1, "p", "s") for i in range(7) for t, r in enumerate(("user", "assistant"))]
    df = spark.createDataFrame(rows, schema).repartition(3)
    found = {r.pair_id: r for r in format_preferences(*swapped_replies(df)).collect()}
    assert sorted(found) == [0, 2, 4, 6, 8, 10, 12]
    assert found[4].rejected == "<|assistant|>\nassistant 3<|end|>\n" and found[12].rejected == "<|assistant|>\nassistant 0<|end|>\n"
    assert format_preferences(*swapped_replies(df.where("conv_id = 2"))).count() == 0


def test_a_very_long_conversation_is_taken_turn_by_turn(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(20000)]
    rows += [(2, i, ("user", "assistant")[i % 2], "x" * (1 + i)) for i in range(4)] + [(3, 0, "assistant", "y" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    pair = swapped_replies(df)
    turns = preference_turns(*pair)
    assert turns.where("pair_id = 1 AND part = 'prompt'").count() == 19999
    assert {(r.part, r.text) for r in turns.where("pair_id = 1 AND part <> 'prompt'").collect()} == {("chosen", "turn 19999"), ("rejected", "xxxx")}
    short = {r.pair_id: r for r in format_preferences(*pair, most_chars=100_000).collect()}
    assert short[1].prompt is None and short[1].prompt_turns == 19999 and short[3].prompt is None and short[2].prompt_turns == 3
    whole = {r.pair_id: r for r in format_preferences(*pair).collect()}
    assert whole[1].prompt.count("<|end|>") == 19999 and len(whole[3].chosen) == 300_000 + len("<|assistant|>\n<|end|>\n")


def test_unnumbered_tied_and_repeated_turns_stay_on_both_sides(spark):
    turns = [(0, None, "system", "s"), (0, 0, "user", "hi"), (0, 1, "assistant", "a"), (0, 1, "assistant", "b"),
             (1, None, "system", "s"), (1, 2, "assistant", "c"), (1, 2, "assistant", "c")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    found = {r.pair_id: r for r in format_preferences(*swapped_replies(df)).collect()}
    say = lambda *texts: "".join(f"<|assistant|>\n{t}<|end|>\n" for t in texts)
    assert found[0].prompt_turns == 3 and (found[0].chosen, found[0].rejected) == (say("b"), say("c"))
    # Equal numbers are ordered by a digest of the text, in which c comes ahead of b.
    assert found[1].prompt_turns == 2 and (found[1].chosen, found[1].rejected) == (say("c"), say("b"))


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    return db


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_queries_keep_all_rows(spark, duck, name):
    found = workload.QUERIES[name](spark, SF).toPandas()
    rows = {t: duck.execute(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in ("documents", "embeddings", "pages")}
    per_row = {"op1": "embeddings", "op4": "documents", "op5": "pages", "op7": "documents", "op8": "pages", "op9": "documents", "op10": "documents"}
    if (number := name.split("_")[0]) in per_row:
        assert len(found) == rows[per_row[number]]
    assert len(found) > 0


def shingle_set(text, width=5):
    words = re.findall("[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_pipeline(spark):
    """Each stage against a plain computation over its own input."""
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs, outputs = raw, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == raw.columns
        outputs[name] = (docs.collect(), (stored := corpus_pipeline.stored(after, name)).collect())
        docs = stored
    ids = lambda rows: sorted(r.doc_id for r in rows)

    before, after = outputs["quality"]
    fitted = [r for r in before if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5]
    sets = {r.doc_id: quality.gram_buckets(r.text.encode()) for r in before}
    fitted.sort(key=lambda r: (r.doc_id, sets[r.doc_id].astype("<u4").tobytes()))
    model = quality.fit_sets([sets[r.doc_id] for r in fitted], np.array([labels[r.doc_id] for r in fitted]))
    scores = model.scores([sets[r.doc_id] for r in before])
    assert ids(after) == sorted(r.doc_id for r, s in zip(before, scores) if s >= 0.3) and len(after) < len(before)

    before, after = outputs["exact_dedup"]
    best = {}
    for r in before:
        same = re.sub("[A-Z]", lambda m: m[0].lower(), r.text)
        best[same] = max(best.get(same, -1), r.doc_id)
    assert ids(after) == sorted(best.values()) and len(after) < len(before)

    before, after = outputs["near_dedup"]
    shingled = [(r.doc_id, shingle_set(r.text)) for r in before]
    group = {i: i for i, _ in shingled}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for (i, a), (j, b) in itertools.combinations(shingled, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            group[max(find(i), find(j))] = min(find(i), find(j))
    assert ids(after) == sorted({find(i) for i in group})

    before, after = outputs["mix"]
    plan = [r for r in mixed(docs_of(spark, before)).collect()]
    copies, size = collections.Counter(r.doc_id for r in after), {r.doc_id: r["size"] for r in plan}
    assert max(copies.values()) <= 3 and {r.source for r in after} == {r.source for r in plan if r.taken}
    for source in {r.source for r in plan}:
        mine = [r for r in plan if r.source == source]
        words = sum(copies[r.doc_id] * size[r.doc_id] for r in mine)
        # Whole documents: off by less than the two that the schedule cuts.
        assert abs(words - mine[0].target) <= 2 * max(r["size"] for r in mine)
    first = {r.doc_id: r.slots[0] for r in plan if r.slots}
    order = [first[d] for d in dict.fromkeys(r.doc_id for r in after)]
    assert order == sorted(order)

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.groupBy().sum("length").first()[0] == pieces.where("start = 0").groupBy().sum("doc_tokens").first()[0]
    assert ids(pieces.where("start = 0").collect()) == ids(docs.collect())


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_no_source_is_lost_in_the_mix(spark):
    rows = [(i, "w " * n, "en", s, 1) for i, (n, s) in enumerate([(101, "a"), (100, "b"), (100, "c"), (100, "c")])]
    found = corpus_pipeline.mix(spark, docs_of(spark, rows), SF)
    assert {r.source for r in found.collect()} == {"a", "b", "c"}
    alone = corpus_pipeline.mix(spark, docs_of(spark, [(1, "w " * 5, "en", None, 1), (2, None, "en", "x", 0)]), SF)
    assert [r.doc_id for r in alone.collect()] == [1]


def test_pipeline_on_awkward_rows(spark):
    rows = [(1, "a good text of several plain words", "en", "s", 1), (None, None, None, None, None), (1, "a good text of several plain words", "en", "s", 1),
            (2, "", "en", None, 0), (2, "another text", None, "s", 3)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, score int")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
        assert (now.count() == 0) == empty
