"""Main text of web pages by markup and a host suffix array.

A page is cut into blocks, each with the place it stands in: boilerplate by its markup (menus,
headers, footers, sidebars, notices, adverts, forms, comments), the article, or neither. Classes and
ids count as markup word by word, but names of a state (``has-sidebar``, ``menu-closed``) do not, nor
do those of ``html``, ``body``, ``main``, an outermost ``article`` and the elements around the page's
article: the first of those with the fewest marked elements around them.

Markup alone can't judge the blocks that stand in neither, so each host's pages are compared. The
tokens of all blocks outside the article, page after page, form the host's token stream, and the
sorted order of its suffixes - its suffix array - brings equal passages together: suffixes that
share their first ``REPEAT_TOKENS`` tokens are neighbours. A passage of at least that length found
on two or more distinct pages of the host is boilerplate. A passage may run over several blocks, and
on behind the article; of a block goes what passages cover if that is ``REPEAT_TOKENS`` or more in a run, and what is left,
its unique runs, stays. A phrase that prose happens to share is shorter and stays too. Blocks too
short to hold a passage go if they stand, as a whole, on ``BLOCK_SHARE`` of the host's distinct pages
and on ``BLOCK_PAGES`` at least. All other blocks that stand in neither are main text, such as a
heading above the article. Inside the article nothing goes.

Pages whose text is the same but for boilerplate by markup are copies and count as one page, so a page
does not lose its text because it is listed twice.

A host may hold a third of all pages, so its stream is cut into chunks of bounded length, each a
task's suffix array. A passage may occur once in each of two chunks; therefore each chunk writes,
for every passage, the smallest and the largest page that holds it, and Spark folds these by host
and passage: two distinct pages make it a repeat. Where a passage is a repeat within its chunk,
its places are written as runs, not one by one.

Null html is empty, and pages without a host share one. Rows are known by ``page_id`` and a hash of
their html, so null and repeated ids do no harm; repeated rows get the same text each.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import mix, slices, stored

#: Tokens of the shortest passage whose repetition counts.
REPEAT_TOKENS = 20
#: A shorter block is boilerplate on this share of a host's distinct pages, if on that many pages.
BLOCK_SHARE = 0.2
BLOCK_PAGES = 3
#: Tokens that one task's suffix array holds, about 50 bytes each while it is built.
CHUNK_TOKENS = 25_000

# Elements by their part in a page.
_SILENT = frozenset(
    "script style noscript template svg math canvas iframe object audio video map head title select option textarea "
    "button datalist".split()
)
_BOILER = frozenset("nav footer aside form menu dialog fieldset".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words of class names and ids that mark boilerplate.
_MARKS = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer footer gdpr masthead menu modal nav navbar navigation newsletter notice notification pagination popup "
    "promo promoted promotion recommended related replies reply respond share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
# Words that make a class name tell a state of the element rather than its part.
_STATES = frozenset(
    "has no not with without is active closed collapsed disabled enabled expanded fixed hidden off on open opened visible".split()
)
_WORD = re.compile(r"[a-z]+")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    # Attributes may hold > in quotes; a quote that is never closed counts as a plain character.
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?=>|$)|[^>]*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![A-Za-z_:-])([A-Za-z_:-]++)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")

BOILER, ARTICLE, OTHER, MARKED = 0, 1, 2, 3


class Block(NamedTuple):
    place: int
    text: str


def _names_boilerplate(value: str) -> bool:
    """Whether one of the class names (or the id) has a word for boilerplate and none for a state."""
    for name in value.split():
        words = _WORD.findall(name)
        if not _MARKS.isdisjoint(words) and _STATES.isdisjoint(words):
            return True
    return False


def _marked(name: str, attributes: str, in_article: bool) -> int:
    """BOILER if the element is boilerplate by its markup, MARKED if only by its class or id, else OTHER."""
    if name in _BOILER or (name == "header" and not in_article):
        return BOILER
    if not attributes.strip():
        return OTHER
    marked = False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id"):
            marked = marked or _names_boilerplate(value)
        if key == "role" and value in _ROLES or key == "aria-hidden" and value == "true":
            return BOILER
        if key == "style" and "display:none" in value.replace(" ", ""):
            return BOILER
    if re.search(r"(?:^|\s)hidden(?:[\s=/]|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)):
        return BOILER
    if name in ("html", "body", "main") or name == "article" and not in_article:
        return OTHER
    return MARKED if marked else OTHER


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, white space folded, entities decoded.

    The time is in proportion to the page, however its elements are nested or left open.
    """
    # Blocks with the place they have but for classes and ids, and the innermost marked element around them.
    out: list[tuple[int, int, str]] = []
    words: list[str] = []
    # Open elements that matter, as (name, boilerplate or article or marked); how many of each name and kind.
    stack: list[tuple[str, int]] = []
    named: dict[str, int] = {}
    kinds = [0, 0, 0, 0]
    # Marked elements by number, from 1: the marked element around each, and how many are around it.
    outer, depth = [0], [0]
    inside = 0
    around: int | None = None  # the innermost marked element around the page's article
    endless_head = False

    def flush() -> None:
        text = " ".join(entities.unescape("".join(words)).split())
        words.clear()
        if text:
            out.append((BOILER if kinds[BOILER] else ARTICLE if kinds[ARTICLE] else OTHER, inside, text))

    def push(name: str, kind: int) -> None:
        stack.append((name, kind))
        named[name] = named.get(name, 0) + 1
        kinds[kind] += 1

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            words.append(page[at:])
            break
        words.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                words.append(m[0][9:].removesuffix("]]>"))
            continue
        name = m[2].lower()
        if name in _SILENT:
            if name in _BLOCKS or name == "title":
                flush()
            if not m[1] and not m[3].endswith("/") and not (name == "head" and endless_head):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.I).search(page, at)
                if name == "head" and not close:
                    endless_head = True
                    continue
                # Without an end the rest of the page belongs to it, as a browser reads it.
                at = close.end() if close else size
            continue
        if name in ("br", "wbr", "img", "input"):
            words.append(" " if name == "br" else "")
            continue
        if name in _BLOCKS:
            flush()
        if m[1]:
            while named.get(name):  # close the innermost of that name and what is open within
                gone, kind = stack[-1]
                if kind != OTHER:
                    flush()
                stack.pop()
                named[gone] -= 1
                kinds[kind] -= 1
                if kind == MARKED:
                    inside = outer[inside]
                if gone == name:
                    break
            continue
        if name in _VOID or m[3].endswith("/"):
            continue
        kind = _marked(name, m[3], kinds[ARTICLE] > 0)
        if kind != OTHER:
            flush()
            push(name, kind)
            if kind == MARKED:
                outer.append(inside)
                depth.append(depth[inside] + 1)
                inside = len(outer) - 1
        elif name in ("article", "main"):
            if not kinds[BOILER] and (around is None or depth[inside] < depth[around]):
                around = inside
            push(name, ARTICLE)
        elif name in _BLOCKS and name not in ("p", "li", "dt", "dd", "tr", "td", "th", "body", "html") or name == "span":
            push(name, OTHER)
    flush()
    free = {0}
    while around:
        free.add(around)
        around = outer[around]
    barred = [False]
    for i in range(1, len(outer)):
        barred.append(i not in free or barred[outer[i]])
    return [Block(BOILER if barred[mark] else kind, text) for kind, mark, text in out]


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ordered by their first ``depth`` tokens or more, and a rank that equal prefixes share.

    Prefix doubling: the order by 2k tokens follows from the ranks by k tokens at a position and k
    further. ``tokens`` ends texts with values that occur once, so no shared prefix spans two texts.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < depth:
        step = min(width, depth - width)
        ahead = np.full(len(rank), -1, np.int64)
        if step < len(rank):
            ahead[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + ahead + 1, return_inverse=True)[1].astype(np.int64)
        width += step
    return np.argsort(rank, kind="stable"), rank


def _hashes(texts: list[str]) -> np.ndarray:
    flat = np.empty(len(texts), dtype=object)
    flat[:] = texts
    return pd.util.hash_array(flat, categorize=False).view(np.int64) if len(flat) else np.empty(0, np.int64)


_STREAM = "host string, page_id long, html_key long, page long, at int, tokens array<long>, block long"


def _streams(depth: int):
    """What is compared of each page: its token stream outside the article, its short undecided blocks, itself."""
    names = [c.split()[0] for c in _STREAM.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            rows: list[tuple] = []
            words: list[list[str]] = []
            shorts: list[str] = []
            mains: list[str] = []
            for row, page in enumerate(part.column("html").to_pylist()):
                blocks = blocks_of(page)
                mains.append("\n".join(b.text for b in blocks if b.place != BOILER))
                rows.append((row, None, None))
                tokens = [w for b in blocks if b.place != ARTICLE for w in b.text.split(" ")]
                # A long stream in parts, each with the begin of the next, so that no passage is lost.
                for at in range(0, max(len(tokens) - depth + 1, 0), CHUNK_TOKENS):
                    rows.append((row, at, None))
                    words.append(tokens[at : at + CHUNK_TOKENS + depth - 1])
                for text in {b.text for b in blocks if b.place == OTHER and b.text.count(" ") + 1 < depth}:
                    rows.append((row, None, len(shorts)))
                    shorts.append(text)
            source = pa.array([r for r, _, _ in rows], pa.int64())
            sizes = iter([len(w) for w in words])
            cuts = np.cumsum([0, *(0 if at is None else next(sizes) for _, at, _ in rows)])
            ids = _hashes([w for some in words for w in some])
            columns = [part.column(c).take(source) for c in ("host", "page_id", "html_key")]
            columns += [
                pa.array(_hashes(mains)).take(source),
                pa.array([at for _, at, _ in rows], pa.int32()),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids)),
                pa.array(_hashes(shorts)).take(pa.array([b for _, _, b in rows], pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


_PASSAGE = "host string, passage long, low long, high long, page_id long, html_key long, at int, n int"


def _chunk_arrays(depth: int):
    """Rows in order of (host, chunk): each chunk's suffix array, folded to what other chunks must know.

    A passage on two pages gives one row without a place, and its places as runs without a passage.
    A passage on one page gives a row for each of its places.
    """
    names = [c.split()[0] for c in _PASSAGE.split(", ")]

    def arrays(host: str, rows: list) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(r[-1]) for r in rows])
        # A separator of its own ends every part of a stream.
        tokens = np.concatenate([np.append(r[-1], np.int64(-i - 1)) for i, r in enumerate(rows)])
        ends = np.cumsum(sizes + 1)
        owner = np.repeat(np.arange(len(rows)), sizes + 1)
        position = np.arange(len(tokens)) - (ends - sizes - 1)[owner]
        order, rank = suffix_array(tokens, depth)
        order = order[position[order] + depth <= sizes[owner[order]]]
        if not len(order):
            return
        # The passage's identity across chunks: a hash of its tokens.
        value = np.zeros(len(order), np.uint64)
        for k in range(depth):
            value = mix(value + np.uint64(0x9E3779B97F4A7C15) + tokens[order + k].view(np.uint64))
        page = np.array([r[2] for r in rows], dtype=np.int64)[owner[order]]
        group = rank[order]
        heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))  # neighbours that share their prefix
        sizes_of = np.diff(np.append(heads, len(group)))
        low, high = np.minimum.reduceat(page, heads), np.maximum.reduceat(page, heads)
        shared = low < high
        here = np.repeat(shared, sizes_of)
        # Places of shared passages, as runs: neighbouring starts cover one run.
        hit = np.zeros(len(tokens) + 1, bool)
        hit[order[here]] = True
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8)]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lone = order[~here]
        begins = np.array([r[3] for r in rows], dtype=np.int64)
        ids, keys = pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())

        def batch(n, passage=None, lows=None, highs=None, starts=None, lengths=None):
            none = pa.nulls(n, pa.int64())
            at = None if starts is None else pa.array(owner[starts])
            columns = [
                pa.array([host], pa.string()).take(pa.array(np.zeros(n, np.int64))),
                *(none if x is None else pa.array(x.astype(np.int64)) for x in (passage, lows, highs)),
                *(none if at is None else x.take(at) for x in (ids, keys)),
                *(pa.nulls(n, pa.int32()) if x is None else pa.array(x.astype(np.int32)) for x in (
                    None if starts is None else begins[owner[starts]] + position[starts], lengths)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        value = value.view(np.int64)
        yield batch(int(shared.sum()), value[heads][shared], low[shared], high[shared])
        yield batch(len(first), starts=first, lengths=last - first + depth - 1)
        yield batch(len(lone), value[~here], page[~here], page[~here], lone, np.full(len(lone), depth))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rows, held = None, [], 0
        for batch in batches:
            lists = batch.column("tokens")
            fields = (batch.column(c).to_pylist() for c in ("host", "chunk", "page_id", "html_key", "page", "at"))
            for i, (host, chunk, *row) in enumerate(zip(*fields)):
                if (host, chunk) != here or held >= 2 * CHUNK_TOKENS:
                    if rows:
                        yield from arrays(here[0], rows)
                    here, rows, held = (host, chunk), [], 0
                tokens = lists[i].values.to_numpy(zero_copy_only=False)
                rows.append((*row, tokens))
                held += len(tokens) + 1
        if rows:
            yield from arrays(here[0], rows)

    return run


def repeats(pages: DataFrame, depth: int = REPEAT_TOKENS) -> DataFrame:
    """(page_id, html_key, runs, blocks): the covered runs of a page's stream, as place * 2**32 + length, and
    the hashes of its short blocks that stand on many of the host's pages."""
    streams = stored(pages.mapInArrow(_streams(depth), _STREAM), "streams")
    parts = streams.where("at IS NOT NULL")
    # Chunks of a host: as many as its tokens ask for, its pages dealt by hash, copies of a page apart.
    hosts = parts.groupBy("host").agg(F.ceil(F.sum(F.size("tokens") + 1) / CHUNK_TOKENS).cast("int").alias("chunks"))
    laid = parts.join(hosts, "host").withColumn("chunk", F.pmod(F.xxhash64("page_id", "html_key"), "chunks").cast("int"))
    laid = laid.repartition("host", "chunk").sortWithinPartitions("host", "chunk", "page_id", "html_key", "at")
    columns = ("host", "chunk", "page_id", "html_key", "page", "at", "tokens")
    passages = stored(laid.select(*columns).mapInArrow(_chunk_arrays(depth), _PASSAGE), "passages")
    # A passage seen on two pages of one chunk is a repeat at once; others must meet another chunk's.
    place = ("page_id", "html_key", "at", "n")
    spans = passages.where("passage IS NOT NULL").groupBy("host", "passage").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    lone = passages.where("low = high").select("host", "passage", *place)
    found = lone.join(spans.where("low < high"), ["host", "passage"], "left_semi")
    runs = passages.where("passage IS NULL").select(*place).union(found.select(*place))
    runs = runs.select("page_id", "html_key", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("n")).alias("run"), F.lit(None).cast("long").alias("block"))
    # Short blocks: distinct pages that hold them, against the distinct pages of the host.
    shorts = streams.where("block IS NOT NULL")
    many = shorts.select("host", "block", "page").distinct().groupBy("host", "block").agg(F.count(F.lit(1)).alias("n"))
    size = streams.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    many = many.where(F.col("n") >= BLOCK_PAGES).join(size, "host").where(F.col("n") >= F.col("pages") * BLOCK_SHARE)
    common = shorts.join(many, ["host", "block"], "left_semi").select("page_id", "html_key", F.lit(None).cast("long").alias("run"), "block")
    return runs.union(common).groupBy("page_id", "html_key").agg(F.collect_set("run").alias("runs"), F.collect_set("block").alias("blocks"))


def main_text(page: str, runs: Iterable[int] = (), common: Iterable[int] = (), depth: int = REPEAT_TOKENS) -> tuple[str, int]:
    """The main text, and the number of tokens outside the article that repetition covers."""
    blocks = blocks_of(page)
    covered: list[list[int]] = []  # disjoint, in order
    for begin, n in sorted((r >> 32, r & 0xFFFFFFFF) for r in runs):
        if covered and begin <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], begin + n)
        else:
            covered.append([begin, begin + n])
    common = set(common)
    known = dict.fromkeys(b.text for b in blocks if b.place == OTHER) if common else {}
    shared = {t for t, h in zip(known, _hashes(list(known)).tolist()) if h in common}
    out, at, k = [], 0, 0
    for block in blocks:
        if block.place == ARTICLE:
            out.append(block.text)
            continue
        words = block.text.split(" ")
        begin, end = at, at + len(words)
        at = end
        if block.place == BOILER or block.text in shared:
            continue
        left, here = [], 0
        while k < len(covered) and covered[k][1] <= begin:
            k += 1
        i = k
        while i < len(covered) and covered[i][0] < end:
            a, b = max(covered[i][0] - begin, here), min(covered[i][1], end) - begin
            if b - a >= depth:
                left += words[here:a]
                here = b
            i += 1
        left += words[here:]
        if left:
            out.append(" ".join(left))
    return "\n".join(out), sum(b - a for a, b in covered)


def _extracted(depth: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            marks = (part.column(c).to_pylist() for c in ("html", "runs", "blocks"))
            found = [main_text(page, runs or (), common or (), depth) for page, runs, common in zip(*marks)]
            texts = [t for t, _ in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
                + [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], [n for _, n in found])],
                names=["page_id", "url", "text", "n_chars", "n_repeated_tokens"],
            )

    return run


def extract(pages: DataFrame, depth: int = REPEAT_TOKENS) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, n_repeated_tokens."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    clean = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.coalesce(host, F.lit("")).alias("host"),
    ).withColumn("html_key", F.xxhash64("html"))
    marks = repeats(clean.where("html != ''"), depth).toDF("m_id", "m_key", "runs", "blocks")
    same = F.col("page_id").eqNullSafe(F.col("m_id")) & (F.col("html_key") == F.col("m_key"))
    schema = "page_id long, url string, text string, n_chars long, n_repeated_tokens long"
    return clean.join(marks, same, "left").select("page_id", "url", "html", "runs", "blocks").mapInArrow(_extracted(depth), schema)
