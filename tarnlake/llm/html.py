"""Main text of web pages through wrappers inferred per host.

A page becomes a stream of tags and text slots. Streams of one host are
aligned: neighbours of one kind fold into a repeated group, elements that only
some streams have become optional, texts become slots. The result is a regular
expression without unions, the host's wrapper. Pages are matched with it
element by element, by position, optional and repeated parts included, which
names the slot that every text fills. The slots and elements carry what all
pages of the host show in them (text mass, links, whether the text is the same
everywhere), from which the content element is chosen.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.llm.text import row_map
from tarnlake.llm.urls import host_and_path
from tarnlake.session import materialize, release

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
)
#: Never main text, whatever the wrapper says.
APART = frozenset(
    "head title script style noscript template svg math iframe object embed canvas audio video nav header footer aside form button select textarea input dialog menu".split()
)
MAIN = frozenset(("article", "main"))
#: Elements that no mark turns into furniture.
WHOLE = frozenset(("html", "body", "main", "article"))
#: Elements that hold a part of a text, never all of it.
PARTS = frozenset("p li td th tr ul ol dl dt dd h1 h2 h3 h4 h5 h6 pre blockquote table tbody figure figcaption".split())
#: Content even where all pages of a host show the same.
TITLES = frozenset(("h1", "h2"))
#: Marks that say how a page is laid out around an element, not what it is.
LAYOUT = re.compile(r"(?:has|with|no|without|is|wp|col|row)[-_]|[a-z]+[-_](?:has|with|no|without)[-_]")
#: Words of class, id and role values that mark page furniture, alone or within
#: a longer mark; and words that do so alone or beside a word for a place on the
#: page (``related-posts``), while ``related-work`` names a section of a text.
FURNITURE = re.compile(
    r"(?:^|[\W_])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|disqus|footer|masthead|navbar|navigation|nav|newsletter|pager|popup|"
    r"promo|sharing|sidebar|sponsored|subscribe|toolbar|widget)(?:$|[\W_])"
    r"|^(?:(?:site|page|top|main|post|entry|global)[-_])?(?:header|menu|notices?|related|replies|share|social|complementary|contentinfo|search|promo\w*|sponsor\w*|nav\w*)"
    r"(?:[-_](?:area|articles|bar|block|box|buttons?|container|form|icons|items|left|links|list|menu|nav|panel|posts?|right|stories|top|wrap|wrapper))*$"
)
#: Start tags that end an open <p>, and the closest open element they look to.
ENDS_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table select".split())

#: Elements nested deeper than this melt into their ancestor in wrappers; texts
#: are read, and furniture is told, at any depth.
WRAPPER_DEPTH = 200
#: Element lists whose lengths multiply to more are aligned greedily.
LONGEST = 1 << 22
#: Streams of one host that are aligned in one task at a time.
FOLD_AT_ONCE = 64
#: A named element holds the content only with this share of its host's text.
NAMED_SHARE = 0.2
#: A page alone shows less than a host: what is left out of it must be small.
OWN_SHARE = 0.85
#: An element whose text lies in links by more than this share is a menu.
LINK_SHARE = 0.8

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_MARKS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: A tag closed by a slash that is not the end of an unquoted value.
_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*\Z")
_PLAIN = re.compile(r"[a-z][a-z_-]*")
_WHITE = re.compile(r"\s+")


@dataclass(slots=True)
class Element:
    name: str
    key: str
    parent: Element | None
    furniture: bool = False
    depth: int = 0
    children: list = field(default_factory=list)  # Element, or str for text


def _key(name: str, marks: list[str]) -> str:
    """Tag and those class, id and role words that have no digits: a number
    in one names the page, not the template."""
    plain = sorted({m for m in marks if _PLAIN.fullmatch(m)})
    return ".".join([name, *plain])


def parse(html: str | None) -> Element:
    """Element tree of a page; broken markup is closed where it must end."""
    root = Element("", "", None)
    here, at, html = root, 0, html or ""
    is_open: Counter[str] = Counter()

    def leave(to: Element) -> Element:
        """Close all elements up to and including ``to``."""
        up = here
        while up is not to:
            is_open[up.name] -= 1
            up = up.parent
        is_open[to.name] -= 1
        return to.parent

    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            here.children.append(html[at:])
            break
        if m.start() > at:
            here.children.append(html[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if is_open[name] > 0:
                up = here
                while up.name != name:
                    up = up.parent
                here = leave(up)
            continue
        if is_open["p"] > 0 and name in ENDS_P:
            up = here
            while up.name != "p":
                up = up.parent
            here = leave(up)
        elif name in CLOSES and any(is_open[c] > 0 for c in CLOSES[name]):
            up = here
            while up is not root and up.name not in CLOSES[name] and up.name not in SCOPE:
                up = up.parent
            if up.name in CLOSES[name]:
                here = leave(up)
        marks = " ".join(a or b or c for a, b, c in _MARKS.findall(m[3] or "")).lower().split()
        spare = name not in WHOLE and any(FURNITURE.search(x) and not LAYOUT.match(x) for x in marks)
        node = Element(name, _key(name, marks), here, spare, here.depth + 1)
        here.children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            node.children.append(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
        elif name not in VOID and not _CLOSED.search(m[3] or ""):
            here = node
            is_open[name] += 1
    return root


# A wrapper is [key, optional, repeated, children]; a text slot has the key "#",
# or "@" if all of its text lies in links.
SLOTS = ("#", "@")


def tokens(node: Element) -> list[tuple[str, list]]:
    """(key, parts) of what lies in an element: a non-inline element each, and
    a slot for each run of text between them; inline markup melts into it. Parts
    of a slot are (text, whether in a link), and None where a line ends."""
    out: list[tuple[str, list]] = []
    run: list = []

    def close() -> None:
        if any(p and p[0].strip() for p in run):
            out.append(("@" if all(p is None or p[1] or not p[0].strip() for p in run) else "#", list(run)))
        run.clear()

    # (children to come, inside a link)
    todo: list[tuple] = [(iter(node.children), node.name == "a")]
    while todo:
        children, linked = todo[-1]
        c = next(children, None)
        if c is None:
            todo.pop()
        elif isinstance(c, str):
            if node.name not in RAW:
                run.append((c, linked))
        elif c.name in INLINE:
            todo.append((iter(c.children), linked or c.name == "a"))
        elif c.name == "br":
            run.append(None)
        elif c.name not in ("wbr", "img"):
            close()
            out.append((c.key, [c]))
    close()
    return out


def stream(node: Element) -> list:
    """Wrapper of one page: inline markup melts into text slots."""
    out: list[list] = []
    for key, parts in tokens(node):
        if key in SLOTS:
            out.append([key, False, False, []])
        elif parts[0].depth > WRAPPER_DEPTH:
            if not out or out[-1][0] not in SLOTS:
                out.append(["#", False, False, []])
        else:
            out.append([key, False, False, stream(parts[0])])
    return fold(out)


def _alike(x: list, y: list) -> bool:
    """Whether neighbours of one key are a repetition: parts of a text are, and
    other elements if half of the lesser's children have their like in the other."""
    if _tag(x[0]) in PARTS or not x[3] or not y[3]:
        return True
    a, b = ({c[0] for c in z[3]} for z in (x, y))
    return 2 * len(a & b) >= min(len(a), len(b))


def fold(items: list) -> list:
    """Like neighbours, one or two elements long, become a repeated group."""
    out: list[list] = []
    for x in items:
        if out and out[-1][0] == x[0] and _alike(out[-1], x):
            out[-1] = [x[0], out[-1][1] and x[1], True, align(out[-1][3], x[3])]
            continue
        out.append(x)
        if len(out) >= 4 and out[-4][0] == out[-2][0] and out[-3][0] == out[-1][0] and _alike(out[-4], out[-2]) and _alike(out[-3], out[-1]):
            b, a = out.pop(), out.pop()
            for k, y in ((-2, a), (-1, b)):
                out[k] = [y[0], out[k][1] and y[1], True, align(out[k][3], y[3])]
    return out


def _tag(key: str) -> str:
    return "#" if key == "@" else key.split(".", 1)[0]


def _likeness(x: list, y: list) -> int:
    """How well two elements match: by key and content, by key, by tag; 0: not."""
    if x[0] == y[0]:
        return 4 if _alike(x, y) else 2
    return int(_tag(x[0]) == _tag(y[0]))


def _merged(x: list, y: list) -> list:
    key = x[0] if x[0] == y[0] else _tag(x[0])
    return [key, x[1] or y[1], x[2] or y[2], align(x[3], y[3])]


def _optional(items: list) -> list:
    return [[x[0], True, *x[2:]] for x in items]


def align(a: list, b: list) -> list:
    """Align two element lists: like ones merge, others become optional.

    Elements of one key and like content match best; those of one tag whose
    marks differ also match, and the marks are dropped. Equal beginnings and ends
    match at once. Lists so long that the table of the rest would not fit are
    matched in one pass instead; that may mark more elements as optional and
    loses none.
    """
    if a == b:
        return a
    same = lambda x, y: x[0] == y[0] and _alike(x, y)
    first = 0
    while first < min(len(a), len(b)) and same(a[first], b[first]):
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and same(a[-1 - last], b[-1 - last]):
        last += 1
    if first or last:
        head = [_merged(x, y) for x, y in zip(a[:first], b[:first], strict=True)]
        tail = [_merged(x, y) for x, y in zip(a[len(a) - last :], b[len(b) - last :], strict=True)]
        return fold(head + align(a[first : len(a) - last], b[first : len(b) - last]) + tail)
    n, m = len(a), len(b)
    if n * m > LONGEST:
        return _align_greedily(a, b)
    like = [[_likeness(x, y) for y in b] for x in a]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            skip = max(best[i + 1][j], best[i][j + 1])
            best[i][j] = max(skip, best[i + 1][j + 1] + like[i][j]) if like[i][j] else skip
    i = j = 0
    out = []
    while i < n and j < m:
        if like[i][j] and best[i][j] == best[i + 1][j + 1] + like[i][j]:
            out.append(_merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out += _optional(a[i : i + 1])
            i += 1
        else:
            out += _optional(b[j : j + 1])
            j += 1
    return fold(out + _optional(a[i:]) + _optional(b[j:]))


def _align_greedily(a: list, b: list) -> list:
    """Each element of ``b`` merges with the next of its key in ``a``."""
    where: dict[str, list[int]] = {}
    for i in range(len(a) - 1, -1, -1):
        where.setdefault(a[i][0], []).append(i)
    out, i = [], 0
    for y in b:
        spots = where.get(y[0], [])
        while spots and spots[-1] < i:
            spots.pop()
        if spots:
            j = spots.pop()
            out += [*_optional(a[i:j]), _merged(a[j], y)]
            i = j + 1
        else:
            out += _optional([y])
    return fold(out + _optional(a[i:]))


def render(wrapper: list) -> str:
    """The wrapper as a regular expression text."""
    body = "".join(map(render, wrapper[3]))
    if wrapper[0] in SLOTS:
        body = wrapper[0]
    elif wrapper[0]:
        body = f"<{wrapper[0]}>{body}</>"
    return f"({body}){'+' if wrapper[2] else ''}{'?' if wrapper[1] else ''}" if wrapper[1] or wrapper[2] else body


def merge_wrappers(texts: list[str]) -> str:
    """Fold JSON wrappers of one host into one, in a fixed order."""
    out: list | None = None
    for t in sorted(set(texts), key=lambda t: (len(t), t)):
        w = json.loads(t)
        out = w if out is None else align(out, w)
    return json.dumps(out or [])


class Node:
    """An element or slot of a wrapper at its place; ``number`` counts them from
    the root, which is 0. ``run`` tells neighbours that repeat together."""

    def __init__(self, parent: Node | None, key: str, optional: bool, repeated: bool, order: list[Node]):
        self.number, self.parent, self.key, self.depth = len(order), parent, key, parent.depth + 1 if parent else 0
        self.optional, self.repeated, self.run, self.order = optional, repeated, -1, order
        self.items: list[Node] = []
        self.by_key: dict[str, list[int]] = {}
        self.by_tag: dict[str, list[int]] = {}
        self.required: list[int] = [0]
        order.append(self)

    @classmethod
    def build(cls, items: list) -> Node:
        root = cls(None, "", False, False, [])

        def add(node: Node, items: list) -> None:
            for i, (key, optional, repeated, below) in enumerate(items):
                n = cls(node, key, optional, repeated, node.order)
                n.run = node.items[-1].run if repeated and i and node.items[-1].repeated else i
                node.items.append(n)
                node.by_key.setdefault(key, []).append(i)
                node.by_tag.setdefault(_tag(key), []).append(i)
                node.required.append(node.required[-1] + (not optional))
                add(n, below)

        add(root, items)
        return root

    def match(self, keys: list[str]) -> list[Node | None]:
        """The item of this element that each of a page's tokens is an instance of.

        Items are taken in order; those that repeat together in any order among
        themselves. Of all ways the one with most tokens by key, then by tag, and
        fewest required items left out counts (ties: the earlier items).
        """
        # Best way so far by the item it ended with: (score, way), a way is (before, token, item).
        ways: dict[int, tuple[int, tuple | None]] = {-1: (0, None)}
        for i, key in enumerate(keys):
            exact = self.by_key.get(key)
            gain = 8 if exact else 3
            come: dict[int, tuple[int, tuple | None]] = {}
            for j in exact or self.by_tag.get(_tag(key), ()):
                top = None
                for k, (score, way) in ways.items():
                    if k < j:
                        score -= 2 * (self.required[j] - self.required[k + 1])
                    elif not (self.items[j].repeated and self.items[j].run == self.items[k].run):
                        continue
                    if top is None or score > top[0]:
                        top = score, way
                if top is not None:
                    come[j] = top[0] + gain, (top[1], i, j)
            for k, (score, way) in ways.items():
                if k not in come or come[k][0] < score - 4:
                    come[k] = score - 4, way
            # A way that ended later with no more to its credit is never better.
            ways, most = {}, None
            for k in sorted(come):
                even = come[k][0] + 2 * self.required[k + 1]
                if most is None or even > most:
                    ways[k], most = come[k], even
        found: list[Node | None] = [None] * len(keys)
        way = ways[max(ways)][1]
        while way:
            way, i, j = way
            found[i] = self.items[j]
        return found


@lru_cache(maxsize=256)
def _nodes(wrapper: str) -> Node:
    return Node.build(json.loads(wrapper))


def _apart(n: Element) -> bool:
    return n.name in APART or n.furniture


def own_region(root: Element) -> Element:
    """Where a page holds its text, judged from the page alone: its largest
    named element, else the deepest element with nearly all its unlinked text."""
    mass: dict[int, float] = {}
    order: list[Element] = []
    todo = [root]
    while todo:
        n = todo.pop()
        order.append(n)
        mass[id(n)] = sum(len(c.strip()) for c in n.children if isinstance(c, str)) * (-1 if n.name == "a" else 1)
        todo += [c for c in n.children if isinstance(c, Element) and not _apart(c)]
    for n in reversed(order):
        if n.parent is not None:
            mass[id(n.parent)] += max(0, mass[id(n)])
    total = mass[id(root)]
    named = [n for n in order if n.name in MAIN and mass[id(n)] > NAMED_SHARE * total]
    if named:
        return max(named, key=lambda n: (mass[id(n)], -n.depth))
    most = [n for n in order if mass[id(n)] > OWN_SHARE * total and n.name not in PARTS and n.name not in INLINE]
    return max(most, key=lambda n: n.depth, default=root)


def read_page(html: str | None, wrapper: str = "[]") -> list[tuple[int, bool, str, int, int]]:
    """(node, own, text, characters, of them in links) of every block of a page
    but those of furniture, in page order.

    The page is matched with the wrapper from the root down. ``node`` is the
    slot that the block fills, or the nearest element above it that the wrapper
    has; ``own`` tells whether it lies in what the page alone shows as its content.
    Where all text lies in elements marked as furniture, the marks do not count.
    """
    root = parse(html)
    found = _read(root, _nodes(wrapper))
    if not found:
        todo = [root]
        while todo:
            n = todo.pop()
            n.furniture = False
            todo += [c for c in n.children if isinstance(c, Element)]
        found = _read(root, _nodes(wrapper))
    return found


def _read(root: Element, nodes: Node) -> list[tuple[int, bool, str, int, int]]:
    top = own_region(root)
    out: list[tuple[int, bool, str, int, int]] = []

    def fill(node: Node, inside: bool, parts: list) -> None:
        lines: list[list] = [[]]
        for p in parts:
            lines.append([]) if p is None else lines[-1].append(p)
        for line in lines:
            text = _WHITE.sub(" ", unescape("".join(t for t, _ in line))).strip()
            if text:
                size = [sum(len(t) for t, linked in line if linked or every) for every in (True, False)]
                out.append((node.number, inside, text, *size))

    def opened(el: Element, node: Node, known: bool, inside: bool) -> tuple:
        found = tokens(el)
        places = node.match([k for k, _ in found]) if known and el.depth < WRAPPER_DEPTH else [None] * len(found)
        return iter(zip(found, places, strict=True)), node, inside or el is top

    todo = [opened(root, nodes, True, False)]
    while todo:
        children, node, inside = todo[-1]
        nxt = next(children, None)
        if nxt is None:
            todo.pop()
            continue
        (key, parts), place = nxt
        if key in SLOTS:
            fill(place or node, inside, parts)
        elif not _apart(parts[0]):
            todo.append(opened(parts[0], place or node, place is not None, inside))
    return out


def main_text(blocks: list[tuple], wrapper: str = "[]", region: int = 0, fixed: frozenset[int] = frozenset(), menus: frozenset[int] = frozenset()) -> str:
    """The blocks of a page (node, own, text) that its host's wrapper reads as content.

    Blocks at or below the region's node are content, but for those of a fixed
    slot (the same words on all pages) and those below a menu, unless nothing
    would be left. A page without the region's element is read from its own.
    """
    order = _nodes(wrapper).order

    def above(n: int) -> Iterator[int]:
        node = order[n]
        while node:
            yield node.number
            node = node.parent

    picked = [(n, text) for n, _, text in blocks if region in above(n)] if region else []
    picked = picked or [(n, text) for n, own, text in blocks if own]
    kept = [text for n, text in picked if n not in fixed and menus.isdisjoint(above(n))]
    return "\n".join(kept or [text for _, text in picked])


def page_text(html: str | None) -> str:
    """Main text of a page alone, without a wrapper of its host."""
    return main_text([b[:3] for b in read_page(html)])


def _streams(pages: DataFrame) -> DataFrame:
    """(host, stream) of all pages, each different one of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {(host, json.dumps(stream(parse(html)))) for host, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*sorted(found), strict=True)], names=["host", "stream"])

    return pages.select("host", F.coalesce("html", F.lit("")).alias("html")).mapInArrow(run, "host string, stream string").distinct()


def _host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): streams of a host aligned in rounds of groups of about
    ``FOLD_AT_ONCE``, so no task sees all streams of a host with very many."""

    def join_streams(key: tuple, t: pa.Table) -> pa.Table:
        return pa.table({"host": [key[0].as_py()], "stream": [merge_wrappers(t.column("stream").to_pylist())]})

    streams, largest = materialize(_streams(pages), "streams"), None
    while largest is None or largest > 1:
        counts = streams.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        groups = counts.select("host", F.ceil(F.col("n") / FOLD_AT_ONCE).cast("int").alias("groups"))
        parts = streams.join(groups, "host").withColumn("part", F.pmod(F.xxhash64("stream"), F.col("groups")))
        before, streams = streams, materialize(parts.groupBy("host", "part").applyInArrow(join_streams, "host string, stream string"), "streams")
        release(before)
        largest = streams.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    return streams.withColumnRenamed("stream", "wrapper")


_FIELDS = (("node", T.IntegerType()), ("own", T.BooleanType()), ("text", T.StringType()), ("chars", T.IntegerType()), ("links", T.IntegerType()))
BLOCKS = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in _FIELDS]))


def _matched(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """Pages (row, host, html) matched with their host's wrapper: (row, host,
    page, blocks), ``page`` a hash of the page."""

    def run(rows: list[tuple]) -> Iterator[tuple]:
        for html, wrapper in rows:
            names = [n for n, _ in _FIELDS]
            yield ([dict(zip(names, b, strict=True)) for b in read_page(html, wrapper or "[]")] if html else [],)

    new = T.StructType([T.StructField("blocks", BLOCKS)])
    joined = pages.join(wrappers, "host", "left").withColumn("page", F.xxhash64("html"))
    return row_map(joined, run, ["html", "wrapper"], new, ["row", "host", "page"], 256)


def _by_node(stats: DataFrame) -> DataFrame:
    """Statistics of slots summed by wrapper node: whether it is a slot of
    template text, and what lies in and below it: all characters and those in
    links, and the unlinked ones that are not template (mass)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "node", "named", "holds", "fixed", "depth", "chars", "links", "mass"]
        kinds = [pa.string(), pa.int32()] + [pa.bool_()] * 3 + [pa.int32()] + [pa.int64()] * 3
        for b in batches:
            out = []
            for host, wrapper, number, chars, links, pages, low, high, first, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                node = _nodes(wrapper).order[number]
                slot = _tag(node.key) == "#" and node.parent is not None and _tag(node.parent.key) not in TITLES
                fixed = slot and pages >= 3 and low == high and first != last
                mass = 0 if fixed else chars - 2 * links
                while node:
                    up, tag = node.parent, _tag(node.key)
                    named = tag in MAIN
                    while named and up:
                        named, up = _tag(up.key) not in MAIN, up.parent
                    out.append((host, node.number, named, tag not in PARTS and tag != "#", fixed, node.depth, chars, links, mass))
                    node, fixed = node.parent, False
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    spread = stats.mapInArrow(run, "host string, node int, named boolean, holds boolean, fixed boolean, depth int, chars long, links long, mass long")
    return spread.groupBy("host", "node", "named", "holds", "depth").agg(
        F.max("fixed").alias("fixed"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.greatest(F.sum("mass"), F.lit(0)).alias("mass")
    )


def _chosen(read: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, region, fixed, menus) out of what all pages show in each node."""
    filled = read.select("host", "page", F.explode("blocks").alias("b")).select("host", "page", "b.*", F.xxhash64("b.text").alias("hash"))
    stats = filled.groupBy("host", "node").agg(
        F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.count(F.lit(1)).alias("pages"),
        F.min("hash").alias("low"), F.max("hash").alias("high"), F.min("page").alias("first"), F.max("page").alias("last"),
    )
    stats = stats.join(wrappers, "host").select("host", "wrapper", "node", "chars", "links", "pages", "low", "high", "first", "last")
    nodes = materialize(_by_node(stats), "nodes")
    mass = F.col("mass")  # unlinked text that is not template
    whole = nodes.where("node = 0").select("host", F.col("mass").alias("whole"))
    named = F.col("named") & (mass >= NAMED_SHARE * F.col("whole")) & (mass > 0)
    most = F.col("holds") & (2 * mass > F.col("whole"))
    score = F.struct(
        F.when(named, 2).when(most, 1).otherwise(0), F.when(named, mass).when(most, F.col("depth")).otherwise(0), -F.col("node")
    )
    menu = F.col("holds") & (F.col("links") > LINK_SHARE * F.col("chars"))
    found = nodes.join(whole, "host").groupBy("host").agg(
        F.max_by(F.struct("node", named.alias("named")), score).alias("top"),
        F.array_sort(F.collect_list(F.when(F.col("fixed"), F.col("node")))).alias("fixed"),
        F.array_sort(F.collect_list(F.when(menu, F.col("node")))).alias("menus"),
    )
    # What an <article> or <main> holds is its text, links and equal words included.
    none = F.array().cast("array<int>")
    held = lambda c: F.when(F.col("top.named"), none).otherwise(F.col(c)).alias(c)
    return found.select("host", F.col("top.node").alias("region"), held("fixed"), held("menus"))


def _infer(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages (row, host, html) as matched, and what was found of every host."""
    wrappers = _host_wrappers(pages)
    read = materialize(_matched(pages, wrappers), "read")
    return read, wrappers.join(_chosen(read, wrappers), "host", "left")


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One wrapper per host: (host, wrapper, region, fixed, menus, expression).

    Every page of a host counts. Streams are folded within a page, and each
    different one of a batch counts once before any shuffle, so a host with a
    third of all pages sends a few rows. Pages are then matched with their
    host's wrapper, and texts told apart by aggregates over its slots: a slot
    filled with the same text on three different pages and more is template.
    ``region`` is the node that holds the content: an <article> or <main> with a
    fair share of the host's unlinked text, else the deepest element with most of
    it. ``fixed`` are slots of template text, ``menus`` elements with their text
    in links; both are empty where the region is an <article> or <main>.
    """
    host, _ = host_and_path(F.col(url_col))
    _, found = _infer(pages.select(F.struct(F.lit(0)).alias("row"), host.alias("host"), F.col(html_col).alias("html")))

    def express(rows: list[tuple]) -> Iterator[tuple]:
        for (text,) in rows:
            yield (render(["", False, False, json.loads(text)]),)

    shown = T.StructType([T.StructField("expression", T.StringType())])
    return row_map(found, express, ["wrapper"], shown, ["host", "wrapper", "region", "fixed", "menus"])


def extract_main_text(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """Append ``text`` (main text, blocks joined by line feeds) and ``n_chars``.

    Null html gives ''. Pages without a host share one wrapper for host ''. A
    page that lacks its host's content element is read from its own largest
    one. Repeated rows get equal texts and are one page where template text is
    told from slots; very long pages cost time in their length only. Columns of
    these names are replaced, all others kept. The wrappers join by host; Spark
    copies them to all tasks only when they measure below its broadcast limit,
    else both sides are shuffled and a hot host is split.
    """
    cols = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    host, _ = host_and_path(F.col(url_col))
    new = T.StructType([T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])
    # All of a page's own columns travel in one, so none can clash with the joined ones.
    read, found = _infer(pages.select(F.struct(*cols).alias("row"), host.alias("host"), F.col(html_col).alias("html")))
    found = materialize(found, "wrappers")

    def run(rows: list[tuple]) -> Iterator[tuple]:
        for blocks, wrapper, region, fixed, menus in rows:
            picked = [(b["node"], b["own"], b["text"]) for b in blocks]
            text = main_text(picked, wrapper or "[]", region or 0, frozenset(fixed or ()), frozenset(menus or ()))
            yield text, len(text)

    done = row_map(read.join(found, "host", "left"), run, ["blocks", "wrapper", "region", "fixed", "menus"], new, ["row"], 256)
    return done.select(*[F.col("row").getField(c).alias(c) for c in cols], "text", "n_chars")
