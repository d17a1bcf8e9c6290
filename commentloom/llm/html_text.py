"""Main text of web pages: markup tells the sure cases, a suffix array per host the others.

A page is cut into blocks. What stands in an article is main text, what stands in menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles is not. Two kinds of blocks are open to
doubt: those of a page without an article, and those in an article whose names only hint at such a part. They
are settled by the host: the token streams of all its pages are taken together
and their suffixes are sorted; neighbours from different pages that share a long prefix show a
substring that repeats across pages. From the blocks in doubt such substrings are cut out
as boilerplate where enough pages hold them, and the other runs stay. Copies and near copies of
a page count as one page: what only they share is their content.

The suffixes are brought into order by a shuffle on (host, first tokens): suffixes with equal long
prefixes meet in one group, wherever their pages are, and a group is only ever reduced to the number of its
pages. A place is covered by a substring of ``LEAST_RUN`` tokens or more that occurs in so many pages
if it is covered by such a prefix, so no longer comparison is needed.

All suffixes of all pages take part, those of sure article text too. Most occur once; to move them in little room they
are first sorted and counted as short numbers, packed, and only those that may occur often enough go on with their
page and place to the exact count.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.blocks import map_runs
from commentloom.llm.minhash_join import near_duplicates
from commentloom.llm.scratch import numbered, stored

LEAST_RUN = 8
#: A run on this many different pages of a host is boilerplate; where a host has few, on more than half of them.
MANY_PAGES = 5
#: How hard texts are packed on their way to the places found in them.
PACKING = 3
#: Suffixes are first counted by so many bits of their numbers, in ranges by the first of these; the bits after these
#: name their places in the tables of those that come again (16 MB each, and 2 MB for hosts).
SHORT_BITS, RANGE_BITS, TABLE_BITS, HOST_BITS = 34, 10, 27, 24
#: Suffixes that a task holds before it sorts and packs them, rows of them that it gives at once, and characters of text
#: that are cut into such at once.
MOST_HELD, MOST_GIVEN, SLICE_CHARS = 1 << 22, 1 << 17, 1 << 18

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(>|\Z)",
    re.S | re.I,
)
#: Elements that are left out up to an end tag, or to the start of one of these.
_ENDS = {
    tag: re.compile(rf"</{tag}\s*>" + (rf"|(?=<(?:{before})(?:[\s/>]|\Z))" if before else ""), re.I)
    for tag, before in {
        "script": "", "style": "", "textarea": "", "title": "/head|body",
        "noscript": "", "template": "", "iframe": "", "select": "select|textarea|article|main|body",
        "svg": "article|main|section|body|p|div|h[1-6]|ul|ol|dl|li|table|pre|blockquote|center|span|img|br|hr",
    }.items()
}
#: Plain text for a browser: without an end tag they run to the body or the end of the page. The others hide nothing then.
RAW = frozenset("script style textarea title".split())
_BODY = re.compile(r"(?=</head\s*>|<body\b)", re.I)
_MARKS = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")

#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset(["article", "main"])
#: Elements whose text is not main text.
SIDE = frozenset("nav header footer aside form menu dialog button search".split())
ITEMS = frozenset("li dt dd tr td th option".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class and id names, and roles, of such parts.
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disclaimer footer form header login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification overlay pager pagination popup promo promotion related reply replies respond search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget contentinfo complementary alert".split()
)
#: Those that, next to other words, may tell how a part is laid out ("has-sidebar") and not what it is.
LAYOUT_WORDS = frozenset(
    "banner footer form header masthead menu nav navbar navigation search share sharing sidebar social toolbar widget".split()
)
#: Words beside them that say where such a part is, or whose, and not what it is.
PLACE_WORDS = frozenset(
    "reader readers user users visitor visitors site top bottom left right inner outer list box block area section wrapper container wrap".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that hold other blocks.
HOLDERS = frozenset("address article details div dl fieldset figure ol section table ul".split())
#: How surely a part is no main text: by a layout word, by another word of its names, by its tag or state.
LAYOUT, NAMED, CERTAIN = 1, 2, 3
#: Kinds of blocks.
ARTICLE, DOUBTFUL, OPEN_KIND, SIDE_KIND = "article", "doubtful", "open", "side"
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SCHEME = re.compile(r"[a-z][a-z0-9+.-]*://", re.I)
#: Schemes without a host: mailto, javascript, data.
_OTHER = re.compile(r"[a-z][a-z0-9+.-]*:", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_ARTICLE = re.compile(r"<article\b", re.I)


def _side_level(tag: str, attributes: str) -> int:
    if tag in SIDE:
        return CERTAIN
    if tag in ("body", "html") or not attributes:
        return 0
    level = 0
    for name, *values in _MARKS.findall(attributes):
        value = "".join(values)
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return CERTAIN
        # A main part is one whatever its names are.
        if name in ("class", "id", "role") and tag != "main":
            for one in value.split():
                words = _WORDS.findall(_CAMEL.sub(" ", one).lower())
                # An article can be a comment; that is what its names begin with then.
                marks = SIDE_WORDS.intersection(words[:1] if tag == "article" else words)
                if not marks:
                    continue
                if name == "role" and tag != "article":
                    return CERTAIN
                weak = marks <= LAYOUT_WORDS and not SIDE_WORDS.issuperset(words)
                level = max(level, LAYOUT if weak else NAMED)
    return level


def _mark_in_article(tag: str, attributes: str) -> tuple[int, bool]:
    """Level of a part inside an article, and whether its names leave it in doubt.

    A name counts only if all its words are those of a side part, and neither on a heading nor, as an id, on a paragraph
    or item, where it may be an anchor; a name with such a word otherwise is a doubt. Inline elements are text, buttons too.
    """
    if tag in SIDE and tag != "button":
        return CERTAIN, False
    if tag not in BLOCKS and tag not in MAIN or not attributes:
        return 0, False
    doubt = False
    for name, *values in _MARKS.findall(attributes):
        value = "".join(values)
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return CERTAIN, False
        if name in ("class", "id", "role") and tag != "main":
            for one in value.split():
                words = set(_WORDS.findall(_CAMEL.sub(" ", one).lower()))
                if not words & SIDE_WORDS:
                    continue
                sure = words <= SIDE_WORDS | PLACE_WORDS and (tag in HOLDERS or name == "class" and tag not in HEADINGS)
                if name == "role" or sure:
                    return NAMED, False
                doubt = True
    return 0, doubt


def page_blocks(source: str) -> list[tuple[str, str]]:
    """(kind, text) of the blocks of a page, in order: article, doubtful (in an article), open, side.

    A main element in a wrapper whose class or id holds a side word is main text all the same, and so is an article
    in one that such a word only tells the layout of. If the page shows no main text then, no name and no form
    round an article counts.
    """
    found = _page_blocks(source, False)
    if not has_article(found) and _ARTICLE.search(source):
        freed = _page_blocks(source, True)
        return freed if has_article(freed) else found
    return found


def has_article(blocks: list[tuple[str, str]]) -> bool:
    return any(kind in (ARTICLE, DOUBTFUL) for kind, _ in blocks)


def _page_blocks(source: str, free: bool) -> list[tuple[str, str]]:
    blocks: list[tuple[str, str]] = []
    stack: list[tuple[str, bool, int, bool]] = []
    parts: list[str] = []
    in_main, in_side, in_doubt = False, 0, False
    endless: set[str] = set()

    def end_block() -> None:
        if parts:
            # References are decoded before white space is folded: a blank may be written as one.
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                kind = OPEN_KIND if not in_main else DOUBTFUL if in_doubt else ARTICLE
                blocks.append((SIDE_KIND if in_side else kind, text))

    at = 0
    while found := _TAG.search(source, at):
        if found.start() > at:
            parts.append(source[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        if not found[4]:
            break  # a tag that the end of the page cuts off
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _ENDS:
            if found[1]:
                continue
            parts.append(" ")
            if found[3].rstrip().endswith("/") and tag not in RAW:
                continue
            end = None if tag in endless else _ENDS[tag].search(source, at)
            if end is None:
                endless.add(tag)
                if tag in RAW:
                    end = _BODY.search(source, at)
                    at = len(source)
            if end:
                at = end.end()
            continue
        if tag == "button" and in_main and not in_side:
            continue  # a word of the sentence round it
        if found[1]:
            if tag in BLOCKS or tag in MAIN or tag in SIDE:
                end_block()
            # Close up to the matching element; a stray end tag closes nothing.
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if any(s[0] in MAIN or s[0] in SIDE for s in stack[depth + 1 :]) and tag not in BLOCKS:
                        break
                    in_main, in_side, in_doubt = stack[depth][1:]
                    del stack[depth:]
                    break
            continue
        if tag in BLOCKS or tag in MAIN or tag in SIDE:
            end_block()
        if tag in VOID or found[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        # A paragraph ends where another block begins, an item where the next one does.
        if stack and (stack[-1][0] == "p" and tag in BLOCKS or tag in ITEMS and stack[-1][0] == tag):
            in_main, in_side, in_doubt = stack.pop()[1:]
        if in_main:
            level, doubt = _mark_in_article(tag, found[3])
        else:
            block = tag in BLOCKS or tag in MAIN or tag in SIDE
            level, doubt = _side_level(tag, found[3]) if block else 0, False
        if free and not in_main and tag in ("form", "article"):
            level = NAMED if tag == "form" else level if level == CERTAIN else 0
        if tag in BLOCKS or tag in MAIN or tag in SIDE and (level or not in_main):
            stack.append((tag, in_main, in_side, in_doubt))
            # Wrappers of a main part that only their names mark do not hide it.
            spared = NAMED if tag == "main" or free else LAYOUT
            if tag in MAIN and not in_main and in_side <= spared:
                in_side = 0
            in_main = in_main or tag in MAIN
            in_side, in_doubt = max(in_side, level), in_doubt or doubt
    else:
        if at < len(source):
            parts.append(source[at:])
    end_block()
    return blocks


def page_links(source: str) -> list[str]:
    """Addresses of the links of a page, absolute ones and those that its base element makes so, in page order.

    Only anchors outside comments, scripts and the like count; references are decoded. An address without a
    host of its own stays with the base, or without one with the page, and is left out then.
    """
    found, base, at = [], "", 0
    while tag := _TAG.search(source, at):
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name or tag[1] or not tag[4]:
            continue
        if name in _ENDS and not (tag[3].rstrip().endswith("/") and name not in RAW):
            end = _ENDS[name].search(source, at)
            at = end.end() if end else len(source) if name in RAW else at
        elif name in ("a", "base"):
            href = next(("".join(v) for key, *v in _ATTRIBUTE.findall(tag[3]) if key.lower() == "href"), None)
            if href is None:
                continue
            href = html.unescape(href).strip()
            absolute = "http:" + href if href.startswith("//") else href if _SCHEME.match(href) else ""
            if name == "base":
                base = base or absolute
            elif absolute:
                found.append(absolute)
            elif base and not _OTHER.match(href):
                found.append(base)
    return found


def host_of(url: str) -> str:
    """SQL for the host of a url: after the first ``://`` up to /, ?, # or the end, A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        f"CASE WHEN instr({url}, '://') > 0 THEN translate(regexp_extract(substring({url}, instr({url}, '://') + 3), "
        f"'^[^/?#]*', 0), '{upper}', '{upper.lower()}') ELSE '' END"
    )


def extract_text(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    source: str = "html",
    least_run: int = LEAST_RUN,
) -> DataFrame:
    """page_id, url, text, n_chars, n_repeated, n_beside and n_inside of every row.

    The text is that of the article blocks in page order, one line each, white space within a
    block folded to one space; in a page without an article it is what stands in the open. Open blocks, and those of an
    article whose names hint at a side part, come without the runs that ``MANY_PAGES`` different
    pages of the host hold, or more than half of them where that is fewer, two at least; n_repeated is the number of tokens
    cut so, and n_beside that of the tokens beside the text (menus, footers) that lie in such runs. The suffixes of sure article
    text are sorted with the others: n_inside is the number of its tokens in runs that so many pages hold, anywhere. That text
    is content, so it keeps them, and its runs cut nothing elsewhere. NULL html counts as empty and gives an empty text; a NULL url has the empty host. Pages of which such blocks are
    looked at, and whose texts are equal or near copies
    (linked as by ``near_duplicates``), are one page here, and so are other pages that are equal; repeated rows thus cut nothing from each
    other and come out once each. An empty table gives an empty result, other columns are not looked at.
    """
    chosen = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.expr(host_of(f"`{url}`")), F.lit("")).alias("host"),
        F.coalesce(F.col(source), F.lit("")).alias("_html"),
    )
    # What a page finds in the suffixes of its host follows from its host and blocks, so the pages are parsed once more
    # for it: texts are not stored, and moved once.
    streams = stored(numbered(_streams(chosen, least_run)), "streams")
    pages = streams.where("bucket IS NULL")
    copies = _copies(pages)
    hosts = _enough(_named(pages.select("host", "digest", "has_beside", "has_any"), copies))
    moved = _moved(chosen)
    return _assembled(moved, _covered(moved, _again(streams, hosts), copies, hosts, least_run), least_run)


def _streams(chosen: DataFrame, least_run: int) -> DataFrame:
    """A row per page, with its text where blocks are in doubt, and one per range of the suffixes' numbers.

    The latter hold, as bits, which places of the table are those of suffixes that come twice, and ``MANY_PAGES`` times.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            rows, pages = [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("_html").to_pylist()):
                found = page_blocks(source)
                blocks, marks, others = _parted(found)
                digest, number, doubtful = _digest(host, found), _host_number(host), any(marks)
                pages.append((number, *_two_streams(blocks, marks, others)))
                rows.append([digest & ((1 << RANGE_BITS) - 1), number, digest, doubtful, False, False, "\n".join(blocks) if doubtful else None, None])
            for row, (sides, at, keys) in zip(rows, _suffixes(pages, least_run)):
                row[4:6] = len(at) > 0 and bool(at[0] < sides), len(at) > 0
                held.append(keys)
                size += len(keys)
            yield _rows(rows, _SENT)
            if size > MOST_HELD:
                yield _rows(_ranges(held), _SENT)
                size = 0
        yield _rows(_ranges(held), _SENT)

    def count(table: pa.Table) -> pa.RecordBatch:
        packed = table.column("packed")
        pages = table.filter(packed.is_null()).drop_columns(["bucket", "packed"]).to_pydict()
        shorts = [_unpacked(x) for x in packed.drop_null().to_pylist()]
        rows = [(None, *page, None, None) for page in zip(*pages.values())]
        if shorts:
            rows.append((table.column("bucket")[0].as_py(), *[None] * len(pages), *_come_again(np.concatenate(shorts))))
        return _rows(rows, _FOUND)

    sent = chosen.select("host", "_html").mapInArrow(parse, _sql(_SENT))
    return map_runs(sent, "bucket", count, _sql(_FOUND))


_PAGE = [("host", "bigint"), ("digest", "bigint"), ("in_doubt", "boolean"), ("has_beside", "boolean"), ("has_any", "boolean"), ("text", "string")]
_SENT = [("bucket", "int"), *_PAGE, ("packed", "binary")]
_FOUND = [("bucket", "int"), *_PAGE, ("twice", "binary"), ("often", "binary")]
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def _sql(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns)


def _rows(rows: list[tuple], columns: list[tuple[str, str]]) -> pa.RecordBatch:
    values = zip(*rows) if rows else [()] * len(columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, _ARROW[kind]) for v, (_, kind) in zip(values, columns)], names=[name for name, _ in columns]
    )


def _two_streams(blocks: list[str], marks: list[bool], others: list[str]) -> tuple[str, str]:
    """What stands outside the sure article text, the blocks in doubt first, and that text."""
    doubtful = [text for text, mark in zip(blocks, marks) if mark]
    return " ".join((*doubtful, *others)), " ".join(text for text, mark in zip(blocks, marks) if not mark)


def _suffixes(pages: list[tuple[int, str, str]], least_run: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per page, given as its host's number and its two streams, the tokens of the first, and where and which the suffixes are.

    Places in the second stream come after those in the first. A suffix is known by a number of its first ``least_run``
    tokens and its host.
    """
    held, size = [], 0
    for page in pages:
        held.append(page)
        size += len(page[1]) + len(page[2])
        if size > SLICE_CHARS:
            yield from _cut(held, least_run)
            held, size = [], 0
    yield from _cut(held, least_run)


def _cut(held: list[tuple[int, str, str]], least_run: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    streams = [text for _, *texts in held for text in texts]
    # Blocks hold single blanks and no other white space, so tokens are counted by them.
    starts = np.append(0, np.cumsum([text.count(" ") + 1 if text else 0 for text in streams], dtype=np.int64)).tolist()
    prefixes = _prefixes(" ".join(text for text in streams if text), least_run)
    for i, (host, _, _) in enumerate(held):
        first, middle, last = starts[2 * i : 2 * i + 3]
        at = np.concatenate([np.arange(first, middle - least_run + 1), np.arange(middle, last - least_run + 1)])
        yield middle - first, at - first, _keys(host, prefixes[at])


def _host_number(host: str) -> int:
    return int.from_bytes(hashlib.blake2b(host.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _keys(host: int, prefixes: np.ndarray) -> np.ndarray:
    from commentloom.llm.shingles import BASE, mixed

    return mixed(prefixes * np.uint64(BASE) + np.array([host]).view(np.uint64))


def _ranges(held: list[np.ndarray]) -> list[tuple]:
    """Rows of the suffixes' short numbers, sorted, by range, as packed distances. Empties the list."""
    if not held:
        return []
    shorts = np.concatenate(held)
    held.clear()
    shorts >>= np.uint64(64 - SHORT_BITS)
    shorts.sort()
    within = SHORT_BITS - RANGE_BITS
    ends = np.searchsorted(shorts, np.arange(1 << RANGE_BITS, dtype=np.uint64) + np.uint64(1) << np.uint64(within)).tolist()
    rows = []
    for bucket, (start, end) in enumerate(zip([0, *ends], ends)):
        if end > start:
            steps = np.diff(shorts[start:end] & np.uint64((1 << within) - 1), prepend=np.uint64(0))
            # The high bytes are mostly zero: bytes of one place stand together.
            data = steps.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
            rows.append((bucket, *[None] * len(_PAGE), zlib.compress(data, 1)))
    return rows


def _unpacked(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel(), dtype=np.int64)


def _come_again(shorts: np.ndarray) -> tuple[bytes, bytes]:
    """Bits of the places in a range's part of the table whose suffixes come twice, and ``MANY_PAGES`` times."""
    shorts = np.sort(shorts)
    found = []
    for times in (2, MANY_PAGES):
        last = shorts[times - 1 :]
        again = last[last == shorts[: len(last)]]
        bits = np.zeros(1 << TABLE_BITS - RANGE_BITS, dtype=bool)
        bits[again >> SHORT_BITS - TABLE_BITS] = True
        found.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
    return tuple(found)


def _table(parts: list[tuple[int, bytes]], bits: int) -> np.ndarray:
    """Bytes of a table from packed parts, some of which may be missing."""
    table = np.zeros((1 << RANGE_BITS, (1 << bits - RANGE_BITS) // 8), dtype=np.uint8)
    for bucket, packed in parts:
        table[bucket] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return table.ravel()


def _marked(table: np.ndarray, numbers: np.ndarray, bits: int) -> np.ndarray:
    at = numbers >> np.uint64(64 - bits)
    return table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1) != 0


def _again(streams: DataFrame, hosts: DataFrame):
    """Broadcast: the packed tables of suffixes that come twice, of those that come ``MANY_PAGES`` times, and of small hosts.

    A table has a bounded size. Where it is full, more suffixes than need be go to the exact count, never fewer.
    """

    def place(table: pa.Table) -> pa.RecordBatch:
        bits = np.zeros(1 << HOST_BITS - RANGE_BITS, dtype=bool)
        numbers = table.column("host").to_numpy().view(np.uint64) >> np.uint64(64 - HOST_BITS)
        bits[numbers & np.uint64(len(bits) - 1)] = True
        packed = zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
        return _rows([(table.column("bucket")[0].as_py(), packed)], [("bucket", "int"), ("packed", "binary")])

    # On them fewer pages than elsewhere make a run boilerplate.
    small = hosts.where(F.col("_enough_beside") < MANY_PAGES).select("host", F.expr(f"CAST(shiftrightunsigned(host, {64 - RANGE_BITS}) AS int)").alias("bucket"))
    parts = [tuple(r) for r in streams.where("bucket IS NOT NULL").select("bucket", "twice", "often").collect()]
    hosts_of = [tuple(r) for r in map_runs(small, "bucket", place, "bucket int, packed binary").collect()]
    return streams.sparkSession.sparkContext.broadcast(
        ([(b, twice) for b, twice, _ in parts], [(b, often) for b, _, often in parts], hosts_of)
    )


def _parted(found: list[tuple[str, str]]) -> tuple[list[str], list[bool], list[str]]:
    """The blocks of the text, which of them are in doubt, and the other blocks."""
    kept = (ARTICLE, DOUBTFUL) if has_article(found) else (OPEN_KIND,)
    blocks = [text for kind, text in found if kind in kept]
    marks = [kind != ARTICLE for kind, _ in found if kind in kept]
    return blocks, marks, [text for kind, text in found if kind not in kept]


def _digest(host: str, found: list[tuple[str, str]]) -> int:
    """A number for a host and the blocks of a page of it."""
    whole = "\0".join([host, *(f"{kind}\n{text}" for kind, text in found)]).encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little", signed=True)


def _prefixes(text: str, least_run: int) -> np.ndarray:
    """One number for each stretch of ``least_run`` tokens, by where it begins."""
    from commentloom.llm.shingles import BASE, mixed, word_hashes

    # Tokens are the words of the text; letters count alike in either case.
    words = word_hashes(text.encode("utf-8", "replace"))
    count = max(len(words) - least_run + 1, 0)
    value = np.full(count, least_run, dtype=np.uint64)
    for i in range(least_run):
        value = mixed(value * np.uint64(BASE) + words[i : i + count])
    return value


def _copies(streams: DataFrame) -> DataFrame | None:
    """(digest, page) of the pages with blocks in doubt: a number that copies and near copies share. None without such pages."""
    asked = streams.where("in_doubt")
    if asked.isEmpty():
        return None
    copies = near_duplicates(asked.select(F.col("row_id").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("row_id"), "component_id"
    )
    joined = asked.select("row_id", "digest").join(copies, "row_id")
    return stored(joined.groupBy("digest").agg(F.xxhash64(F.min("component_id")).alias("page")), "copies")


def _named(pages: DataFrame, copies: DataFrame | None) -> DataFrame:
    """With ``page``: the digest, or what copies of a page in doubt share."""
    if copies is None:
        return pages.withColumn("page", F.col("digest"))
    return pages.join(copies, "digest", "left").withColumn("page", F.coalesce("page", "digest"))


def _enough(pages: DataFrame) -> DataFrame:
    """Per host how many pages make a run boilerplate, by pages with suffixes beside sure article text and by all with any.

    A page too short for any run says nothing about what the others share.
    """
    one = pages.groupBy("host", "page").agg(*[F.max(F.col(c).cast("int")).alias(c) for c in ("has_beside", "has_any")])
    counts = one.groupBy("host").agg(F.sum("has_beside").alias("_beside"), F.sum("has_any").alias("_any"))
    enough = "greatest(2, least({}, {} div 2 + 1))"
    return counts.selectExpr("host", f"{enough.format(MANY_PAGES, '_beside')} AS _enough_beside", f"{enough.format(MANY_PAGES, '_any')} AS _enough")


def _moved(chosen: DataFrame) -> DataFrame:
    """The pages by digest: their blocks, packed, and which of those of the text are in doubt."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, hosts, packed, marked = [], [], [], []
            for host, source in zip(batch.column("host").to_pylist(), batch.column("_html").to_pylist()):
                found = page_blocks(source)
                blocks, marks, others = _parted(found)
                digests.append(_digest(host, found))
                hosts.append(_host_number(host))
                # Blocks hold no line breaks and are not empty.
                whole = "\n".join(blocks) + "\n\n" + "\n".join(others)
                packed.append(zlib.compress(whole.encode("utf-8", "replace"), PACKING))
                marked.append(marks if any(marks) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(digests, pa.int64()), pa.array(hosts, pa.int64()),
                 pa.array(packed, pa.binary()), pa.array(marked, pa.list_(pa.bool_()))],
                names=["page_id", "url", "digest", "host", "packed", "marks"],
            )

    parsed = chosen.mapInArrow(parse, f"{_kinds(chosen)}, digest bigint, host bigint, packed binary, marks array<boolean>")
    return parsed.repartition("digest")


def _unpacked_page(packed: bytes, marks: list[bool]) -> tuple[list[str], list[bool], list[str]]:
    """The blocks of the text, which are in doubt, and the other blocks."""
    text, _, others = zlib.decompress(packed).decode().partition("\n\n")
    blocks = text.split("\n") if text else []
    return blocks, marks or [False] * len(blocks), others.split("\n") if others else []


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))


def _covered(moved: DataFrame, again, copies: DataFrame | None, hosts: DataFrame, least_run: int) -> DataFrame:
    """(digest, repeated): the places where a run begins that enough pages of the host have as well.

    Sure article text is content, however often it comes: places outside it count only the pages that have the run
    outside it, too. Places in it count all pages.
    """

    def joined(parts: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(c)) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays(columns, names=["digest", "host", "at", "key", "beside", "first"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, often, small = (_table(parts, bits) for parts, bits in zip(again.value, (TABLE_BITS, TABLE_BITS, HOST_BITS)))
        # Equal pages have equal places and lie in one task.
        seen = set()
        for batch in batches:
            new = [i for i, d in enumerate(batch.column("digest").to_pylist()) if not (d in seen or seen.add(d))]
            one = batch.select(["digest", "host", "packed", "marks"]).take(pa.array(new, pa.int64()))
            digests, hosts = one.column("digest").to_pylist(), one.column("host").to_numpy()
            few = _marked(small, hosts.view(np.uint64), HOST_BITS).tolist()
            streams = (_two_streams(*_unpacked_page(p, m)) for p, m in zip(one.column("packed").to_pylist(), one.column("marks").to_pylist()))
            pages = ((host, *two) for host, two in zip(hosts.tolist(), streams))
            parts, size = [], 0
            for digest, host, is_small, (sides, at, keys) in zip(digests, hosts.tolist(), few, _suffixes(pages, least_run)):
                asked = _marked(twice if is_small else often, keys, TABLE_BITS)
                at, keys = at[asked], keys[asked].view(np.int64)
                first = np.zeros(len(at), dtype=bool)
                first[np.unique(keys, return_index=True)[1]] = True
                parts.append((np.full(len(at), digest), np.full(len(at), host), at.astype(np.int32), keys, at < sides, first))
                size += len(at)
                if size > MOST_GIVEN:
                    yield joined(parts)
                    parts, size = [], 0
            if parts:
                yield joined(parts)

    found = moved.mapInArrow(places, "digest bigint, host bigint, at int, key bigint, beside boolean, first boolean")
    # A page has a run once, and has it beside sure article text if the first place is there.
    named = _named(found.where("first").select("digest", "key", "host", F.col("beside").cast("int").alias("beside")), copies)
    if copies is not None:
        named = named.groupBy("key", "host", "page").agg(F.max("beside").alias("beside"))
    shared = (
        named.groupBy("key", "host")
        .agg(F.count(F.lit(1)).alias("_pages"), F.sum("beside").alias("_beside"))
        .where("_pages > 1")
        .join(hosts, "host")
        .select("key", F.expr("_beside >= _enough_beside").alias("_cut"), F.expr("_pages >= _enough").alias("_shared"))
        .where("_cut OR _shared")
    )
    met = found.select("digest", "at", "key", "beside").join(shared, "key").where("CASE WHEN beside THEN _cut ELSE _shared END")
    return met.groupBy("digest").agg(F.collect_set("at").alias("repeated"))


def _assembled(moved: DataFrame, covered: DataFrame, least_run: int) -> DataFrame:
    """The pages, repeated runs cut out of the blocks in doubt and counted in the others."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, repeated, beside, inside = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("packed", "marks", "repeated"))
            for packed, marks, starts in zip(*columns):
                blocks, marks, others = _unpacked_page(packed, marks)
                stream, _ = _two_streams(blocks, marks, others)
                sides = stream.count(" ") + 1 if stream else 0
                outside = [s for s in starts or [] if s < sides]
                text, cut = unique_runs(blocks, marks, outside, least_run) if any(marks) else ("\n".join(blocks), 0)
                texts.append(text)
                repeated.append(cut)
                beside.append(covered_tokens(outside, least_run) - cut)
                inside.append(covered_tokens([s for s in starts or [] if s >= sides], least_run))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 *(pa.array(n, pa.int64()) for n in (repeated, beside, inside))],
                names=["page_id", "url", "text", "n_chars", "n_repeated", "n_beside", "n_inside"],
            )

    # All columns of the pages stay: their shuffle is then the one that the places came from.
    return moved.join(covered, "digest", "left").mapInArrow(
        assemble, f"{_kinds(moved)}, text string, n_chars bigint, n_repeated bigint, n_beside bigint, n_inside bigint"
    )


def covered_tokens(starts: list[int], least_run: int) -> int:
    """Tokens that lie in the runs beginning at these places."""
    ordered = sorted(starts)
    return sum(min(least_run, after - at) for at, after in zip(ordered, ordered[1:])) + (least_run if ordered else 0)


def unique_runs(blocks: list[str], marks: list[bool], starts: list[int], least_run: int) -> tuple[str, int]:
    """The blocks, the marked ones without their covered tokens, and how many these are; a block without tokens goes.

    ``starts`` are places in the stream, which begins with the tokens of the marked blocks.
    """
    tokens = [block.split(" ") for block in blocks]
    cover = np.zeros(sum(len(t) for t, m in zip(tokens, marks) if m) + least_run, dtype=bool)
    starts = np.asarray([s for s in starts if s < len(cover) - least_run], dtype=np.int64)
    for shift in range(least_run):
        cover[starts + shift] = True
    kept, at, cut = [], 0, 0
    for block, words, mark in zip(blocks, tokens, marks):
        if mark:
            gone = cover[at : at + len(words)]
            at += len(words)
            cut += int(gone.sum())
            block = " ".join(w for w, g in zip(words, gone) if not g)
        if block:
            kept.append(block)
    return "\n".join(kept), cut
