"""Operator 9: main text of HTML pages by union-free wrapper inference.

Pages of a host are token streams of one template.  A page is folded into an
expression without unions: elements, text slots, groups that repeat.  The
expressions of a host's pages are aligned one after the other: texts that
differ become slots, runs of different length become repeated groups and
tokens that only some pages have become optional.  The result is the host's
wrapper.  The main region is then chosen on the wrapper, once for all its
pages: a semantic article or main element, else the element that holds most of
the variable text outside boilerplate.  Every page's text is read from that
region, whole.

Boilerplate is told by the wrapper, by element names and by class words, but
never for html, body, main, article, role=main and itemprop=articleBody.

- Wrapper: an element with a class or id of its own, all of whose text is the
  same on every page of a group of at least ``DIFFERENT`` different pages, is
  boilerplate, if the main region has other text that varies.  Bare elements
  (a heading, a paragraph) stay even if all pages have them.
- Names: ``SKIP`` elements go wherever they stand, so a header, footer, nav or
  aside inside the article goes, with a heading that it holds.
- Class words: an element goes if one of its class, id or role names consists
  of ``NOISE`` words and ``PLACE`` words only (``comments-list``, ``ad-slot``).  A
  name with any other word (``related-work``, ``search-algorithms``) says nothing
  by itself.

A form with most of the text is no boilerplate; nor is another such element,
where no article or main element is outside boilerplate, if it holds one with
most of the text, or if ten times as much text as all that is outside.

Trees are at most ``DEEPEST`` levels deep: what is nested deeper is read in order
as part of the last level.  Children are aligned by equal heads and tails, then
by keys that both sides have once (longest increasing run), then in windows of
``WINDOW``, so the cost grows with the children, not with their square.

Hosts are dealt to groups of about ``GROUP`` pages by hash (a host with a
third of all pages becomes many groups, each with a wrapper of its own), so
no group grows with the input.

Cases: null or empty html gives the empty text, null urls and urls without a
host share one (split) group, unclosed tags are closed by the next block or
the end, pages of any length are read whole, a page alone in its group is its
own wrapper, repeated rows give repeated results, extra columns are ignored,
an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

GROUP = 64  # pages aligned to one wrapper
DIFFERENT = 3  # pages from which equal text is taken for the template's
DEEPEST = 100  # levels of a tree
WINDOW = 64  # children between which no key is unique, aligned at once
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+)|(<)", re.S)
MARK = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# Open elements that a start tag closes: those above the listed containers.
CLOSES = {
    **{t: frozenset(["p"]) for t in "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPE = frozenset("article aside body div dl fieldset footer form header html main nav ol section table td th ul".split())
# Elements and class words that never hold main text.
SKIP = frozenset("aside button datalist dialog footer form head header iframe input label menu nav noscript script select style svg template textarea title".split())
NOISE = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer header legal login masthead "
    "menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related reply replies search share sharing sidebar "
    "social sponsor sponsored subscribe tags toolbar widget".split()
)
# Words that only say where or what kind of box something is.
PLACE = frozenset(
    "area bar block bottom box button buttons center col column container content fixed form group icon icons inner item items label left link links list main "
    "message messages mobile narrow outer page panel post posts primary reader readers right row secondary section signup site slot sticky text thread title top unit user users "
    "wide wrap wrapper zone".split()
)
# Elements and marks that hold main text whatever their class words, and
# boilerplate that never does whatever it holds.
MAIN = frozenset("html body main article".split())
MAIN_MARKS = frozenset([("role", "main"), ("itemprop", "articlebody")])
NEVER = SKIP - frozenset("aside dialog footer form header menu nav".split())
WORDS = re.compile(r"[a-z]+")
NAMES = re.compile(r"[^\s]+")
SPACE = re.compile(r"\s+")


class Node:
    """An element of a page or wrapper; text is a child with the name '#'."""

    __slots__ = ("children", "key", "many", "name", "noise", "optional", "size", "text")

    def __init__(self, key: str, name: str, noise: bool = False, text: str | None = None):
        self.key, self.name, self.noise, self.text = key, name, noise, text
        self.children: list[Node] = []
        self.optional = self.many = False
        self.size = 0

    def expression(self) -> str:
        """The wrapper as a union-free regular expression."""
        if self.name == "#":
            body = "#PCDATA" if self.text is None else self.text
        else:
            body = f"<{self.key}>{''.join(c.expression() for c in self.children)}"
        mark = {(True, True): "*", (True, False): "+", (False, True): "?"}.get((self.many, self.optional))
        return f"({body}){mark}" if mark else body


def says_noise(name: str) -> bool:
    """Whether a class, id or role name is made of noise and place words."""
    words = WORDS.findall(name)
    return not NOISE.isdisjoint(words) and all(w in NOISE or w in PLACE for w in words)


def close(stack: list[tuple[str, Node]], i: int) -> None:
    """Close the open elements from the i-th on.  Below the deepest level an
    end is marked by an empty element, so that blocks stay apart."""
    if len(stack) > DEEPEST + 1:
        name, _ = stack[max(i, DEEPEST + 1)]
        stack[DEEPEST][1].children.append(Node(name, name))
    del stack[i:]


def parse(html: str) -> Node:
    """The element tree of a page."""
    root = Node("", "")
    # Open elements: name, and the node that takes their content.  Below the
    # deepest level that is the last one's node, or a lost one for boilerplate.
    stack: list[tuple[str, Node]] = [("", root)]
    at = 0
    while at < len(html):
        m = TOKEN.match(html, at)
        at = m.end()
        closing, name, rest, text, lone = m.groups()
        if name:
            name = name.lower()
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        close(stack, i)
                        break
                    if name not in SCOPE and stack[i][0] in SCOPE:
                        break
                continue
            shut = CLOSES.get(name)
            if shut:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in shut:
                        close(stack, i)
                        break
                    if stack[i][0] in SCOPE:
                        break
            found = [(k.lower(), (a or b or c).lower()) for k, a, b, c in MARK.findall(rest)] if rest else []
            marks = " ".join(sorted(f"{k}={v}" for k, v in found))
            held = name in MAIN or not MAIN_MARKS.isdisjoint(found)
            node = Node(f"{name} {marks}".strip(), name, name in SKIP or not held and any(says_noise(x) for _, v in found for x in NAMES.findall(v)))
            stack[-1][1].children.append(node)
            if name not in VOID and not rest.rstrip().endswith("/"):
                if name in RAW:  # its content is text up to its end tag
                    end = END[name].search(html, at)
                    stop = end.start() if end else len(html)
                    node.children.append(Node("#", "#", text=html[at:stop]))
                    at = end.end() if end else stop
                elif len(stack) <= DEEPEST:
                    stack.append((name, node))
                else:
                    stack.append((name, Node("", "") if node.noise else stack[-1][1]))
        elif text or lone:
            stack[-1][1].children.append(Node("#", "#", text=text or lone))
        elif m.group().startswith("<![CDATA["):
            stack[-1][1].children.append(Node("#", "#", text=m.group()[9:].removesuffix("]]>").replace("&", "&amp;")))
    return root


def fold(node: Node) -> Node:
    """A page as an expression: neighbouring elements with one key become a
    repeated group of their alignment, neighbouring texts one slot."""
    out = Node(node.key, node.name, node.noise, node.text)
    if node.name == "#":
        out.size = len(node.text.strip())
        return out
    for child in node.children:
        if child.name == "#" and not child.text.strip():
            continue
        new = fold(child)
        last = out.children[-1] if out.children else None
        if last is not None and last.key == new.key:
            merged = align(last, new)
            merged.many, merged.optional = True, last.optional
            out.children[-1] = merged
        else:
            out.children.append(new)
    out.size = sum(c.size for c in out.children)
    return out


def align(a: Node, b: Node) -> Node:
    """The most specific expression that covers two with the same key."""
    out = Node(a.key, a.name, a.noise, a.text if a.text == b.text else None)
    out.many, out.optional = a.many or b.many, a.optional or b.optional
    out.size = a.size + b.size
    if a.name == "#":
        return out
    x, y = a.children, b.children
    if [c.key for c in x] == [c.key for c in y]:
        out.children = [align(p, q) for p, q in zip(x, y)]
        return out
    # What only one side has is optional.
    pairs = iter([*common([c.key for c in x], [c.key for c in y]), (len(x), len(y))])
    p, q = next(pairs)
    i = j = 0
    while i < len(x) or j < len(y):
        if i == p and j == q:
            out.children.append(align(x[i], y[j]))
            i, j = i + 1, j + 1
            p, q = next(pairs)
            continue
        if i < p:
            only, i = x[i], i + 1
        else:
            only, j = y[j], j + 1
        if not only.optional:
            only = copy(only)
            only.optional = True
        last = out.children[-1] if out.children else None
        if last is not None and last.key == only.key:  # unmatched neighbours repeat
            only = align(last, only)
            only.many = True
            out.children[-1] = only
        else:
            out.children.append(only)
    return out


def common(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Positions of a common subsequence of two key lists: equal heads and
    tails, between them the longest increasing run of keys that both have once,
    between those a longest common subsequence of short windows."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(x), 0, len(y), True)]
    while todo:
        a, b, c, d, unique = todo.pop()
        while a < b and c < d and x[a] == y[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        if unique:
            run = once(x, a, b, y, c, d)
            ends = [(a - 1, c - 1), *run, (b, d)]
            out += run
            todo += [(p + 1, r, q + 1, s, False) for (p, q), (r, s) in zip(ends, ends[1:])]
            continue
        while a < b and c < d:
            out += longest(x, a, min(b, a + WINDOW), y, c, min(d, c + WINDOW))
            a, c = a + WINDOW, c + WINDOW
    return sorted(out)


def once(x: list[str], a: int, b: int, y: list[str], c: int, d: int) -> list[tuple[int, int]]:
    """Longest increasing run of the positions of keys that stand once in both
    ranges (patience sorting)."""
    place: dict[str, list[int]] = {}
    for i in range(a, b):
        place.setdefault(x[i], [0, 0, 0, 0])[0] += 1
        place[x[i]][1] = i
    for j in range(c, d):
        if y[j] in place:
            place[y[j]][2] += 1
            place[y[j]][3] = j
    pairs = sorted((i, j) for n, i, m, j in place.values() if n == m == 1)
    piles: list[int] = []  # least last position of a run of each length
    held: list[tuple[int, int]] = []  # (index in pairs, index of the one before)
    tops: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(piles, j)
        held.append((k, tops[at - 1] if at else -1))
        if at == len(piles):
            piles.append(j)
            tops.append(k)
        else:
            piles[at], tops[at] = j, k
    out, k = [], tops[-1] if tops else -1
    while k >= 0:
        out.append(pairs[k])
        k = held[k][1]
    return out[::-1]


def longest(x: list[str], a: int, b: int, y: list[str], c: int, d: int) -> list[tuple[int, int]]:
    """Longest common subsequence of two short ranges."""
    best = [[0] * (d - c + 1) for _ in range(b - a + 1)]
    for i in range(b - a - 1, -1, -1):
        for j in range(d - c - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[a + i] == y[c + j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < b - a and j < d - c:
        if x[a + i] == y[c + j]:
            out.append((a + i, c + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def copy(node: Node) -> Node:
    out = Node(node.key, node.name, node.noise, node.text)
    out.children, out.many, out.optional, out.size = node.children, node.many, node.optional, node.size
    return out


def shape(node: Node) -> tuple:
    """What an alignment sees of a folded page beside its texts."""
    return (node.key, node.many, tuple(shape(c) for c in node.children))


def merge(a: Node, b: Node) -> None:
    """Take a folded page of the same shape up into ``a``."""
    if a.text != b.text:
        a.text = None
    a.optional |= b.optional
    a.size += b.size
    for p, q in zip(a.children, b.children):
        merge(p, q)


def infer(pages: list[Node]) -> Node:
    """The wrapper of parsed pages: their folded expressions, aligned one
    after the other.  Pages of one shape need no alignment with each other:
    all their texts and sizes are merged place by place first."""
    shapes: dict[tuple, Node] = {}
    for page in pages:
        one = fold(page)
        first = shapes.setdefault(shape(one), one)
        if first is not one:
            merge(first, one)
    wrapper, *others = shapes.values()
    for one in others:
        wrapper = align(wrapper, one)
    return wrapper


def strength(node: Node) -> int:
    """How clearly an element says that it holds the article."""
    marks = node.key.split(" ")[1:]
    if "itemprop=articlebody" in marks:
        return 3
    if node.name == "article":
        return 2
    return 1 if node.name == "main" or "role=main" in marks else 0


def mass(node: Node, noise: bool = False) -> int:
    """Variable text outside links and boilerplate (``noise``: with such
    boilerplate as may hold main text)."""
    if node.name == "#":
        return node.size if node.text is None or node.size > 80 else 0
    if node.name == "a" or node.noise and (not noise or node.name in NEVER):
        return 0
    return sum(mass(c, noise) for c in node.children)


def semantic(node: Node, least: int = 0) -> bool:
    """Whether an article or main element that does not repeat, with so much
    text, is below the element, outside boilerplate of its own."""
    return any(
        not c.noise and not (least and c.many) and (strength(c) > 0 and c.size > 0 and mass(c, True) >= least or semantic(c, least)) for c in node.children
    )


def cleared(wrapper: Node) -> list[tuple[str, ...]]:
    """Boilerplate that holds the main text is none: it is marked so in the
    wrapper, and its paths, outermost first, are returned."""
    paths: list[tuple[str, ...]] = []
    whole = mass(wrapper, True)

    def holder(node: Node, path: tuple[str, ...]) -> tuple[Node, tuple[str, ...]] | None:
        for c in node.children:
            if c.name == "#" or c.name in NEVER or 2 * (m := mass(c, True)) <= whole:
                continue
            at = (*path, c.key)
            if not c.noise:
                return holder(c, at)
            if c.name == "form" or not outside and (semantic(c, whole // 2 + 1) or m > 10 * mass(wrapper)):
                return c, at
        return None

    while True:
        outside = semantic(wrapper)
        found = holder(wrapper, ())
        if found is None:
            return paths
        found[0].noise = False
        paths.append(found[1])


def fixed(wrapper: Node, path: tuple[str, ...]) -> set[tuple[str, ...]]:
    """Paths of marked elements in the region whose text is the same on every
    page, where other text of the region varies."""
    out: set[tuple[str, ...]] = set()
    nodes = [wrapper]
    for key in path:
        nodes = [c for n in nodes for c in n.children if c.key == key and not c.noise]

    def varies(node: Node) -> bool:
        if node.name == "#":
            return node.text is None
        return not node.noise and any([varies(c) for c in node.children])

    def walk(node: Node, at: tuple[str, ...]) -> None:
        for c in node.children:
            if c.name == "#" or c.noise or c.optional:  # on some pages only
                continue
            if " " in c.key and c.name in BLOCK and c.size and not c.many and not strength(c) and not varies(c):
                out.add((*at, c.key))
            else:
                walk(c, (*at, c.key))

    if any([varies(n) for n in nodes]):
        for n in nodes:
            walk(n, path)
    return out


def drop(page: Node, paths: set[tuple[str, ...]]) -> None:
    """Mark the elements at some paths as boilerplate."""
    first = {p[0] for p in paths}
    for c in page.children:
        if c.key in first:
            if (c.key,) in paths:
                c.noise = True
            else:
                drop(c, {p[1:] for p in paths if p[0] == c.key})


def clear(page: Node, path: tuple[str, ...]) -> None:
    """Mark the elements at a path as no boilerplate."""
    for c in page.children:
        if c.key == path[0]:
            if len(path) == 1:
                c.noise = False
            else:
                clear(c, path[1:])


def region(wrapper: Node, opened: list[tuple[str, ...]] = ()) -> tuple[str, ...]:
    """Path of keys to the element whose content is the main text.  Elements
    cleared of boilerplate (``opened``) are not chosen over text beside them."""
    found: list[tuple[int, int, tuple[str, ...]]] = []

    def walk(node: Node, path: tuple[str, ...]) -> None:
        if node.noise:
            return
        if (s := strength(node)) and node.size:
            found.append((s, node.size, path))
        for c in node.children:
            if c.name != "#":
                walk(c, (*path, c.key))

    walk(wrapper, ())
    if found:
        return max(found, key=lambda x: (x[0], x[1], x[2]))[2]
    node, path = wrapper, ()
    whole = mass(wrapper)
    while whole:
        inner = max((c for c in node.children if c.name != "#"), key=mass, default=None)
        if inner is None or mass(inner) < 0.6 * whole or inner.name in ("p", "h1", "h2", "h3", "li", "pre", "td", "blockquote", "span") or inner.many:
            break
        if (*path, inner.key) in opened and mass(inner) < mass(node):
            break
        node, path = inner, (*path, inner.key)
    return path


def blocks(page: Node, path: tuple[str, ...]) -> str:
    """Text of the region in a page, blocks joined by one space."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", "".join(run)).strip(" ")
        run.clear()
        if text:
            out.append(text)

    def walk(node: Node) -> None:
        if node.name == "#":
            run.append(unescape(node.text))
            return
        if node.noise:
            if node.name in BLOCK:
                flush()
            return
        edge = node.name in BLOCK
        if edge:
            flush()
        for c in node.children:
            walk(c)
        if edge:
            flush()

    def enter(node: Node, rest: tuple[str, ...]) -> bool:
        if not rest:
            walk(node)
            flush()
            return True
        return any([enter(c, rest[1:]) for c in node.children if c.key == rest[0] and not c.noise])

    if not enter(page, path) or not out:
        # The wrapper's region is optional and this page lacks it.
        one = fold(page)
        opened = cleared(one)
        for at in opened:
            clear(page, at)
        own = region(one, opened)
        if opened or own != path:
            out.clear()
            enter(page, own)
    return " ".join(out)


def host(url: str | Column = "url") -> Column:
    """Lower-case host of a URL; empty for null or no host."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def grouped(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """Pages dealt to (host, salt) groups of about ``group`` pages."""
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"), host().alias("host")
    )
    sizes = written(base.groupBy("host").count(), "hosts").select("host", F.ceil(F.col("count") / group).cast("long").alias("parts"))
    return base.join(sizes, "host").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.col("parts"))).drop("parts")


def extract(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(table: pa.Table) -> pa.Table:
        texts = table.column("html").to_pylist()
        trees = [parse(x) for x in texts]
        wrapper = infer(trees)
        opened = cleared(wrapper)
        for at in opened:
            for t in trees:
                clear(t, at)
        path = region(wrapper, opened)
        if len(set(texts)) >= DIFFERENT and (same := fixed(wrapper, path)):
            for t in trees:
                drop(t, same)
        text = [blocks(t, path) for t in trees]
        return pa.table(
            {"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(text, pa.string()), "n_chars": pa.array([len(t) for t in text], pa.int64())}
        )

    return grouped(pages, group).groupBy("host", "salt").applyInArrow(run, "page_id long, url string, text string, n_chars long")


def wrappers(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """host, salt, n_pages, wrapper (a union-free regular expression) and
    region (path of the main element) of every group."""

    def run(table: pa.Table) -> pa.Table:
        wrapper = infer([parse(x) for x in table.column("html").to_pylist()])
        opened = cleared(wrapper)
        return pa.table(
            {
                "host": table.column("host")[:1], "salt": table.column("salt")[:1], "n_pages": pa.array([table.num_rows], pa.int64()),
                "wrapper": [wrapper.expression()], "region": [" > ".join(region(wrapper, opened))],
            }
        )

    return grouped(pages, group).groupBy("host", "salt").applyInArrow(run, "host string, salt long, n_pages long, wrapper string, region string")
