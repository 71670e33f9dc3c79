"""Operator 9: main text by wrappers inferred without unions from same-host pages.

A page becomes a tree of blocks; inline markup folds into text slots. The pages of a host are
aligned one after another into one wrapper: equal neighbours (also runs of two or three) become
repeated groups, blocks that one side lacks become optional, and text that differs becomes an open slot.
Wrappers merge in tasks first, then by (host, salt), then by host, so a host with a third of all pages
never stands in one task. The wrapper tells where the article stands (its path) and which texts are
the same on all pages; every page is then read along its host's wrapper. Headings that stand before the
chosen block, beside it or one of its ancestors, belong to the article, and so do headings that all its pages
share where what stands with them differs.

Defined cases: a null or empty html has an empty text; a null or odd url is a host of its own;
unclosed and stray tags are repaired; blocks are left out by tag and class words unless they hold
the article or most open text; pages that don't fit their wrapper are read along their own;
repeated rows are read row by row; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import is_small, written

SALTS = 32
#: Wrappers a task holds before it hands them on; hosts whose rules may be broadcast.
HELD, SMALL = 2000, 100_000
DEPTH = 150
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|object|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CELLS = frozenset("li td th dt dd option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that keep a text of links only.
LINKED = HEADINGS | {"p", "blockquote"}
VOID = frozenset("br img wbr input hr meta link source area base col embed param track".split())
#: Share of a page's open text from which a block is kept: a form or a word within a longer name; a name by itself,
#: unless it holds what markup names as the article.
PART, MOST = 0.5, 0.9
DROPPED = frozenset("head nav aside footer form button dialog menu".split())
NAMES = frozenset(
    "nav navbar navigation menu sidebar aside footer ad ads advert adverts advertisement adv banner promo promotion sponsor sponsored cookie cookies consent gdpr"
    " notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations breadcrumb"
    " breadcrumbs pagination pager comment comments disqus replies reply respond toolbar skip masthead copyright widget widgets form search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
CONTENT = frozenset("article content post entry story articlebody maincontent".split())
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table tbody thead tfoot"), "td": ("td th", "tr"), "th": ("td th", "tr")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}


class Element:
    __slots__ = ("tag", "key", "children", "dropped", "rank", "doubt")

    def __init__(self, tag: str, key: str, dropped: bool, rank: int, doubt: float = 0.0):
        self.tag, self.key, self.dropped, self.rank, self.doubt = tag, key, dropped, rank, doubt
        self.children: list = []  # Elements and (text, characters in links)


def _signature(tag: str, attributes: str) -> tuple[str, bool, int, float]:
    """Key, whether it is left out, how surely it names the article (0: not at all), and the share of the page's
    open text from which it is kept after all (0: never)."""
    key, dropped, rank = tag, tag in DROPPED, {"article": 4, "main": 3}.get(tag, 0)
    sure, doubt = dropped and tag != "form", PART * (tag == "form")
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        words = re.split(r"[^a-z]+", value)
        if name in ("class", "id"):
            key += "." + "-".join(x for x in words if x)
            if not NAMES.isdisjoint(words):
                if tag not in ("html", "body", "article", "main"):
                    dropped, doubt = True, max(doubt, MOST if not NAMES.isdisjoint(value.split()) else PART)
                elif tag == "article":
                    doubt = max(doubt, PART)  # a comment, say: doesn't name the article to its ancestors
            if not CONTENT.isdisjoint(words) or "".join(words) in CONTENT:
                rank = max(rank, 1)
        elif name == "role":
            sure = sure or value in ROLES
            rank = max(rank, 3 * (value == "main"), 4 * (value == "article"))
        elif name == "itemprop":
            rank = max(rank, 2 * (value == "articlebody"))
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            sure = True
    return key, dropped or sure, rank, 0.0 if sure else doubt


def parse(html: str | None) -> Element:
    """The tree of blocks of a page."""
    root = Element("#page", "#page", False, 0)
    stack, parts, links, in_link, skip = [root], [], 0, False, []
    html, at, doubted, deep = html or "", 0, False, []

    def text(raw: str) -> None:
        nonlocal links
        if raw and not skip:
            raw = unescape(raw) if "&" in raw else raw
            parts.append(raw)
            links += len(raw) if in_link else 0

    def flush() -> None:
        nonlocal links, in_link
        if parts:
            whole = " ".join("".join(parts).split())
            if whole:
                stack[-1].children.append((whole, links))
            parts.clear()
        links, in_link = 0, False

    for m in TOKEN.finditer(html):
        text(html[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        closing = bool(m[2])
        if tag in INLINE:
            if tag == "br":
                text(" ")
            elif tag == "a":
                in_link = not closing
            if skip and closing and skip[-1] == tag:
                skip.pop()
            elif not closing and tag not in VOID and (skip[-1:] == [tag] or _signature(tag, m[4])[1]):
                skip.append(tag)
            continue
        flush()
        skip.clear()
        if closing:
            if tag in deep:
                del deep[len(deep) - 1 - deep[::-1].index(tag) :]
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    deep.clear()
                    break
            continue
        if tag in VOID:
            continue
        if deep:
            if deep[-1] == "p":
                deep.pop()
        elif stack[-1].tag == "p":
            stack.pop()
        if tag in CLOSES and deep:
            ends, barrier = CLOSES[tag]
            for k in range(len(deep) - 1, -1, -1):
                if deep[k] in barrier:
                    break
                if deep[k] in ends:
                    del deep[k:]
                    break
        elif tag in CLOSES:
            ends, barrier = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in barrier:
                    break
                if stack[k].tag in ends:
                    del stack[k:]
                    break
        key, dropped, rank, doubt = _signature(tag, m[4])
        if tag == "header" and not any(x.tag in ("article", "main") for x in stack):
            dropped, doubt = True, 0.0
        doubted = doubted or dropped and doubt > 0
        new = Element(tag, key, dropped, rank, doubt)
        stack[-1].children.append(new)
        if len(stack) < DEPTH and not deep:
            stack.append(new)
        else:
            deep.append(tag)  # its closing tag must not end an element around
    text(html[at:])
    flush()
    if doubted:
        sizes: dict[int, tuple[int, bool]] = {}
        whole, _ = _measure(root, sizes)
        _spare(root, sizes, whole, _named_outside(root))
    return root


def _measure(element: Element, sizes: dict[int, tuple[int, bool]]) -> tuple[int, bool]:
    """Characters outside links, and whether the article is named, in what isn't surely left out."""
    size, named = 0, False
    for child in element.children:
        if isinstance(child, tuple):
            size += max(0, len(child[0]) - child[1])
        elif not child.dropped or child.doubt:
            n, own = _measure(child, sizes)
            size, named = size + n, named or own
    named = named or element.rank > 0 and not element.doubt and size > 0
    sizes[id(element)] = size, named
    return size, named


def _kept(element: Element) -> bool:
    return any(len(c[0]) > c[1] if isinstance(c, tuple) else not c.dropped and _kept(c) for c in element.children)


def _named_outside(element: Element) -> bool:
    """Whether the article is named, with some text, outside all blocks that are left out."""
    if element.rank and not element.doubt and _kept(element):
        return True
    return any(_named_outside(c) for c in element.children if isinstance(c, Element) and not c.dropped)


def _spare(element: Element, sizes: dict[int, tuple[int, bool]], whole: int, named: bool, inside: bool = False) -> None:
    """Names are evidence only: a block that holds the article, or most open text where markup names no other, stays.

    ``whole`` is the text of the page, or of the element around that names the article (``inside``)."""
    for child in element.children:
        if isinstance(child, Element) and (not child.dropped or child.doubt):
            size, own = sizes[id(child)]
            inner = named
            if child.dropped and (inside or not named) and size > (PART if own and not inside else child.doubt) * whole:
                child.dropped = False
                inner = named or _named_outside(child)
            if not child.dropped:
                names = child.rank > 0 and size > 0
                _spare(child, sizes, size if names else whole, inner, inside or names)


# A wrapper item is [key, optional, repeated, items, rank] for a block, ["#t", optional, repeated,
# texts that all its pages have with their characters, characters, characters in links, pages] for a slot, ["#g", ...] for a group of items.


def _slot(text: str) -> str:
    """A text as a wrapper holds it: a long one as its hash."""
    return text if len(text) <= 32 else "#" + hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def wrapper(element: Element) -> list:
    items = []
    for child in element.children:
        if isinstance(child, tuple):
            items.append(["#t", False, False, {_slot(child[0]): max(0, len(child[0]) - child[1])}, len(child[0]), child[1], 1])
        elif not child.dropped:
            items.append(wrapper(child))
    return [element.key, False, False, fold(items), element.rank]


def _kind(item: list) -> str:
    return item[0] if item[0] != "#g" else "#g" + "|".join(x[0] for x in item[3])


def fold(items: list, same: int = 1) -> list:
    """Runs of equal neighbours, of one to three items, as repeated items or groups."""
    for period in (1, 2, 3):
        out, k = [], 0
        kinds = [_kind(x) for x in items]
        while k < len(items):
            unit = kinds[k : k + period]
            n = 1
            while len(unit) == period and kinds[k + n * period : k + (n + 1) * period] == unit:
                n += 1
            if n == 1 or period > 1 and len(set(unit)) == 1:
                out.append(items[k])
                k += 1
                continue
            first = items[k : k + period]
            for r in range(1, n):
                first = [merged(a, b, same) for a, b in zip(first, items[k + r * period : k + (r + 1) * period], strict=True)]
            if period == 1:
                first[0][2] = True
                out.append(first[0])
            else:
                out.append(["#g", False, True, first, 0])
            k += n * period
        items = out
    return items


def merged(a: list, b: list, same: int = 0) -> list:
    """Two items of the same kind as one; ``same``: of the same page (1), there in a list or table (2), where equal texts are data."""
    if a[0] == "#t":
        texts = a[3] | b[3] if same == 1 else {k: n for k, n in a[3].items() if k in b[3]}
        return ["#t", a[1] or b[1], a[2] or b[2], texts, a[4] + b[4], a[5] + b[5], max(a[6], b[6]) if same else a[6] + b[6]]
    inner = 2 if same and a[0].split(".")[0] in CELLS else same
    return [a[0], a[1] or b[1], a[2] or b[2], aligned(a[3], b[3], inner), max(a[4], b[4])]


def _optional(item: list) -> list:
    return [item[0], True, *item[2:]]


class Rows:
    """Lengths of the longest common sequences of the ends of two lists, in little memory: rows are sets of bits, and
    only every so manieth stays; those between are made again as they are asked for, from first to last."""

    def __init__(self, a: list, b: list):
        self.a, self.size, self.full = a, len(b), (1 << len(b)) - 1
        self.masks: dict = {}
        for j, x in enumerate(reversed(b)):
            self.masks[x] = self.masks.get(x, 0) | 1 << j
        self.every = max(1, math.isqrt(len(a)))
        self.kept, self.block = {}, {}
        row = self.full  # a bit is 0 where one more item of b makes the sequence longer
        for i in range(len(a), -1, -1):
            row = self._before(i, row)
            if i % self.every == 0 or i == len(a):
                self.kept[i] = row

    def _before(self, i: int, row: int) -> int:
        """Row i from row i + 1."""
        m = self.masks.get(self.a[i], 0) if i < len(self.a) else 0
        return ((row + (row & m)) | (row & ~m)) & self.full if m else row

    def count(self, i: int, j: int) -> int:
        """Length for a[i:] and b[j:]."""
        if i not in self.block:
            first = i // self.every * self.every
            last = min(first + self.every, len(self.a))
            row = self.kept[last]
            old, self.block = self.block, {last: row}
            for k in range(last - 1, first - 1, -1):
                row = self.block[k] = self._before(k, row)
            if first - 1 in old:
                self.block[first - 1] = old[first - 1]
        return self.size - j - (self.block[i] & ((1 << (self.size - j)) - 1)).bit_count()


def aligned(a: list, b: list, same: int = 0) -> list:
    """Item lists as one: the longest common sequence is merged, the rest becomes optional."""
    ka, kb = [_kind(x) for x in a], [_kind(x) for x in b]
    if ka == kb:
        return [merged(x, y, same) for x, y in zip(a, b, strict=True)]
    rows = Rows(ka, kb)
    out, i, j = [], 0, 0
    while i < len(ka) and j < len(kb):
        if ka[i] == kb[j]:
            out.append(merged(a[i], b[j], same))
            i, j = i + 1, j + 1
        elif rows.count(i + 1, j) >= rows.count(i, j + 1):
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    out += [_optional(x) for x in a[i:]] + [_optional(x) for x in b[j:]]
    return fold(out, same or 2)


def _open_text(item: list, pages: int) -> int:
    """Characters outside links in slots that differ between pages (in all slots if there are too few pages)."""
    if item[0] == "#t":
        return max(0, item[4] - item[5] - (item[6] * sum(item[3].values()) if pages >= 3 else 0))
    return sum(_open_text(x, pages) for x in item[3])


def _is_heading(item: list) -> bool:
    return item[0].split(".")[0] in HEADINGS


def _shared(items: list, pages: int, out: set[str], kept: set[str]) -> None:
    """Adds the texts that stand on each page; to ``kept`` those of headings beside text that differs."""
    differs = sum(_open_text(x, pages) for x in items if not _is_heading(x)) > 0
    for item in items:
        if item[0] != "#t":
            _shared(item[3], pages, kept if differs and _is_heading(item) else out, kept)
        elif item[6] >= pages:
            out.update(item[3])


def _all_heading(item: list) -> bool:
    """Whether all text of a block stands in headings, and there is some."""
    inner = [x for x in item[3] if x[0] != "#t"]
    return _is_heading(item) or len(inner) == len(item[3]) > 0 and all(_all_heading(x) for x in inner)


def rule(top: list, pages: int) -> dict:
    """Where the article stands: its path of keys, those of headings before it, whether markup names it, and texts
    that all pages share (of named articles those that no page lacks)."""
    best: tuple = (0, 0, ())
    inside: list = []
    fixed: set[str] = set()

    def walk(items: list, path: tuple) -> None:
        nonlocal best, inside
        for item in items:
            if item[0] == "#t":
                if item[6] >= 3:
                    fixed.update(item[3])
            elif item[0] == "#g":
                walk(item[3], path)
            else:
                here = (*path, item[0])
                if item[4]:
                    size = sum(_open_text(x, 0) for x in item[3])
                    if size and (item[4], size) > best[:2]:
                        best, inside = (item[4], size, here), item[3]
                walk(item[3], here)

    walk(top[3], ())
    if best[0]:
        shared: set[str] = set()
        size = sum(_open_text(x, 0) for x in inside)
        if pages >= 3 and sum(_open_text(x, pages) for x in inside) >= 0.2 * size:  # not for pages that are copies of one
            kept: set[str] = set()
            _shared(inside, pages, shared, kept)
            shared -= kept
        return {"path": best[2], "heads": [], "named": True, "fixed": sorted(shared)}
    node, path = top, ()
    heads: list[tuple] = []
    while True:
        own = _open_text(node, pages)
        inner, todo = [], list(node[3])
        while todo:
            x = todo.pop()
            if x[0] == "#g":
                todo += x[3]
            elif x[0] != "#t":
                inner.append((_open_text(x, pages), x))
        size, child = max(inner, key=lambda x: x[0], default=(0, None))
        if child is None or size < 0.7 * own or not own or child[2]:
            return {"path": path, "heads": heads, "named": False, "fixed": sorted(fixed)}
        for x in node[3]:  # in page order
            if x is child or x[0] == "#g" and any(y is child for y in x[3]):
                break
            if x[0][0] != "#" and not x[2] and x[0] != child[0] and _all_heading(x):
                heads.append((*path, x[0]))
        node, path = child, (*path, child[0])


def _blocks(element: Element, out: list[str], fixed: set[str], named: bool) -> None:
    linked = named or element.tag in LINKED
    for child in element.children:
        if isinstance(child, tuple):
            if _slot(child[0]) not in fixed and (linked or child[1] < 0.8 * len(child[0])):
                out.append(child[0])
        elif not child.dropped:
            _blocks(child, out, fixed, named)


def _found(page: Element, path: tuple) -> list[Element]:
    found = [page]
    for key in path:
        found = [c for e in found for c in e.children if isinstance(c, Element) and not c.dropped and c.key == key]
    return found


def read(page: Element, where: dict) -> str:
    """The blocks of the article, in page order; none where only headings are found."""
    fixed, out = set(where["fixed"]), []
    for element in _found(page, where["path"]):
        _blocks(element, out, fixed, where["named"])
    heads: list[str] = []
    for path in where["heads"] if out else ():
        for element in _found(page, path):
            _blocks(element, heads, fixed, where["named"])
    return "\n".join(heads + out)


def main_text(html: str | None, where: dict | None) -> str:
    page = parse(html)
    got = read(page, where) if where else ""
    if not got or where and not where["named"]:
        own = rule(wrapper(page), 1)
        if not got or own["named"]:
            got = read(page, own)
    return got


def host() -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _merge_all(wrappers: Iterator[tuple[str, int]]) -> tuple[list, int]:
    top, pages = None, 0
    for text, n in wrappers:
        one = json.loads(text)
        top, pages = one if top is None else merged(top, one), pages + n
    return top, pages


def wrappers(pages: DataFrame) -> DataFrame:
    """A written table (host, rule) of every host."""

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt, held = TaskContext.get().partitionId() % SALTS, {}

        def out() -> pa.RecordBatch:
            columns = [list(held), [salt] * len(held), [json.dumps(w) for w, _ in held.values()], [n for _, n in held.values()]]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())], names=["host", "salt", "wrapper", "pages"])

        for batch in batches:
            for name, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                one = wrapper(parse(html.as_py()))
                held[name] = (merged(held[name][0], one), held[name][1] + 1) if name in held else (one, 1)
                if len(held) >= HELD:
                    yield out()
                    held = {}
        if held:
            yield out()

    def join_salted(pdf: pd.DataFrame) -> pd.DataFrame:
        top, n = _merge_all(zip(pdf["wrapper"], pdf["pages"], strict=True))
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "wrapper": [json.dumps(top)], "pages": [n]})

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        top, n = _merge_all(zip(pdf["wrapper"], pdf["pages"], strict=True))
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "rule": [json.dumps(rule(top, n))]})

    parts = pages.select(host().alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(infer, "host string, salt int, wrapper string, pages long")
    salted = parts.groupBy("host", "salt").applyInPandas(join_salted, "host string, wrapper string, pages long")
    return written(salted.groupBy("host").applyInPandas(finish, "host string, rule string"), "wrappers")


def extracted(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text) of every page."""
    rules = wrappers(pages)
    if is_small(rules, SMALL):
        rules = F.broadcast(rules)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read_ = {r: json.loads(r) for r in set(batch.column("rule").to_pylist()) if r}
            texts = [main_text(h.as_py(), read_.get(r.as_py())) for h, r in zip(batch.column("html"), batch.column("rule"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host().alias("host"))
    return rows.join(rules, "host", "left").select("page_id", "url", "html", "rule").mapInArrow(extract, "page_id long, url string, text string")


def op9_union_free_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
