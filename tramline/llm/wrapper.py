"""Main text of web pages by wrapper induction.

Every page's block elements form a tree (runs of equal siblings folded into one repeated node). The trees of a
host's pages are aligned by simple tree matching into one template. A template node whose text is the same on
pages with three or more different articles is template; the others are slots. What tells articles apart is a page's long
blocks outside of boilerplate elements, within its articles if it has some there: copies of one article under other
menus, adverts or dates are one. Slots below boilerplate elements (by element, class, id or role)
and link lists are left out; all others may be content. Each page is then aligned with its host's template, and the
blocks that fall into such slots are its text, in page order: of a page that has some within its own articles only
those, of any other page all.

Learning covers all pages: node statistics are summed by (host, page shape, node) with partial aggregation, a
host's shapes are folded one after another (never held together with its pages), and the wrappers (one small row
for each host) meet the pages by a join whose strategy Spark picks from the written table's size.

Defined results: a null url belongs to the empty host; null or empty html gives an empty text; pages that repeat
an article say nothing about what is constant (a host or branch with fewer than three articles has no template
text);
unclosed, misnested and cut-off markup is read as far as it goes; blocks nested deeper than ``DEPTH`` belong to
their ancestor at that depth; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import html as html_lib
import json
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batch, chunks, ready, same_type, stored
from .url_filter import host_and_path

DEPTH = 64
#: Share of a slot's text inside links from which it is a link list.
LINKS = 0.5
#: Blocks of at least this share of a page's longest one tell its article.
LONG = 0.25
#: Page shapes whose alignment a task remembers.
SHAPES_KEPT = 10_000

#: Elements that end the block before them.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
noscript ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup, and no text of the page.
RAW = frozenset("script style textarea title iframe noembed noframes xmp object audio video canvas math".split())
#: Elements that hold no main text.
BOILERPLATE = frozenset("""head nav footer aside form button select option optgroup noscript template dialog menu
svg legend fieldset search""".split())
#: Words of class, id and role that mark elements without main text.
BOILERPLATE_WORDS = frozenset("""ad ads advert adverts advertisement adsense banner breadcrumb breadcrumbs comment
comments consent contentinfo cookie cookies copyright disclaimer disqus footer form hidden legal login menu menubar
modal nav navbar navigation newsletter notice notification pager pagination popup promo promotion recommended related
replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar
widget""".split())
#: Marks of a page header; inside an article a header belongs to it.
HEADER = frozenset(["header", "masthead", "topbar", "complementary"])
ARTICLE = frozenset(["article", "main"])
_WHOLE = frozenset(["html", "body", "article", "main"])
#: What a start tag closes when it stands directly inside.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
          "option": {"option"}, "optgroup": {"option", "optgroup"}, "body": {"head"}}
#: Where that search ends.
SCOPE = frozenset("ul ol dl table html body article section div td th select menu".split())

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)
  |<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>=]++|=)*+)(?:>|\Z)
  |</?[A-Za-z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S | re.X)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""", re.I)
_LETTERS = re.compile(r"[a-z]+")
#: Class names that speak about something else on the page (no-sidebar, has-footer).
_ABOUT = re.compile(r"(?:no|not|has|with|without)[-_]")


class Page:
    """Block elements of a page in page order, and its text blocks.

    labels, parents: of each element; blocks: (element, text, characters inside links)."""

    def __init__(self, source: str):
        self.labels: list[str] = ["#"]
        self.parents: list[int] = [-1]
        self.blocks: list[tuple[int, str, int]] = []
        stack: list[tuple[str, int]] = [("#", 0)]
        text: list[str] = []
        linked = 0
        in_link = False

        def flush():
            nonlocal linked
            if text:
                block = " ".join("".join(text).split())
                if block:
                    self.blocks.append((stack[-1][1], block, linked))
                text.clear()
                linked = 0

        def add(piece: str):
            nonlocal linked
            piece = html_lib.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if in_link:
                linked += len(piece.strip())

        at = 0
        while True:
            found = _MARKUP.search(source, at)
            if found is None:
                if at < len(source):
                    add(source[at:])
                break
            if found.start() > at:
                add(source[at:found.start()])
            at = found.end()
            tag = found["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if found["end"]:
                if tag == "a":
                    in_link = False
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        flush()
                        del stack[k:]
                        break
                continue
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                at = close.start() if close else len(source)
                continue
            names = found["rest"]
            label = tag
            if names and "=" in names:
                words = sorted({w for m in _NAMED.findall(names) for name in "".join(m).lower().split()
                                if not _ABOUT.match(name) for w in _LETTERS.findall(name)})
                # an inline element that holds no main text is kept apart like a block
                if words and (tag in BLOCK or tag not in VOID and _boilerplate(f"{tag}.{'.'.join(words)}")):
                    label = f"{tag}.{'.'.join(words)}"
            if tag == "br" or tag == "wbr":
                text.append(" " if tag == "br" else "")
                continue
            if tag not in BLOCK and label == tag:
                if tag == "a":
                    in_link = True
                continue
            flush()
            if stack[-1][0] == "p" and tag in BLOCK:
                stack.pop()
            if tag in CLOSES:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in CLOSES[tag]:
                        del stack[k:]
                    elif stack[k][0] in SCOPE:
                        break
            if tag in VOID:
                continue
            if len(stack) < DEPTH:
                self.labels.append(label)
                self.parents.append(stack[-1][1])
                stack.append((tag, len(self.labels) - 1))
            else:
                stack.append((tag, stack[-1][1]))
        flush()

    def shape(self) -> tuple[tuple, list[int]]:
        """The folded tree (label, children), and each element's number in it (in order of their beginnings)."""
        n = len(self.labels)
        kids: list[list[int]] = [[] for _ in range(n)]
        for k in range(1, n):
            kids[self.parents[k]].append(k)
        trees: list = [None] * n
        for k in range(n - 1, -1, -1):
            folded = []
            for c in kids[k]:
                if not folded or folded[-1] != trees[c]:
                    folded.append(trees[c])
            trees[k] = (self.labels[k], tuple(folded))
        size: dict = {}
        for tree in reversed(trees):
            if tree not in size:
                size[tree] = 1 + sum(size[c] for c in tree[1])
        number = [0] * n
        for k in range(n):
            at, last = number[k] + 1, None
            for c in kids[k]:
                if last is not None and trees[c] != last:
                    at += size[last]
                number[c], last = at, trees[c]
        return trees[0], number

    def article(self) -> int:
        """Hash (32 bits) of the long blocks outside of boilerplate, of those within an article where there are such."""
        inside, out = [False] * len(self.labels), [False] * len(self.labels)
        for k, label in enumerate(self.labels):
            above = self.parents[k]
            inside[k] = label.split(".")[0] in ARTICLE or above >= 0 and inside[above]
            out[k] = _left_out(label, inside[k]) or above >= 0 and out[above]
        blocks = [b for b in self.blocks if not out[b[0]]]
        blocks = [b for b in blocks if inside[b[0]]] or blocks
        least = LONG * max((len(text) for _, text, _ in blocks), default=0)
        return _hash("\n".join(text for _, text, _ in blocks if len(text) >= least)) & 0xFFFFFFFF

    def texts(self, number: list[int]) -> dict[int, tuple[str, int]]:
        """Text and linked characters of each folded node that has some."""
        out: dict[int, tuple[str, int]] = {}
        for k, block, linked in self.blocks:
            text, links = out.get(number[k], ("", 0))
            out[number[k]] = (f"{text}\n{block}" if text else block, links + linked)
        return out


def _boilerplate(label: str) -> bool:
    tag, *words = label.split(".")
    return tag in BOILERPLATE or tag not in _WHOLE and any(w in BOILERPLATE_WORDS for w in words)


def _left_out(label: str, in_article: bool) -> bool:
    """Boilerplate, or a header that belongs to no article."""
    tag, *words = label.split(".")
    return _boilerplate(label) or not in_article and (tag in HEADER or any(w in HEADER for w in words))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


# ------------------------------------------------------------------ template
class Node:
    """Template node: children, and what its pages have there."""

    __slots__ = ("label", "kids", "low", "high", "first", "last", "total", "pages", "chars", "links", "content")

    def __init__(self, label: str):
        self.label, self.kids = label, []
        self.low = self.high = self.first = self.last = None
        self.total = self.pages = self.chars = self.links = 0
        self.content = False

    def see(self, low, high, first, last, total, pages, chars, links):
        """low, high: least and largest hash of the text; first, last, total: least, largest and sum of the articles' hashes."""
        if self.low is None:
            self.low, self.high, self.first, self.last = low, high, first, last
        else:
            self.low, self.high = min(self.low, low), max(self.high, high)
            self.first, self.last = min(self.first, first), max(self.last, last)
        self.total += total
        self.pages += pages
        self.chars += chars
        self.links += links

    def constant(self) -> bool:
        """The same text with three or more articles: if only the first and the last hash come, the sum is first * pages
        and a multiple of their difference."""
        return (self.low == self.high and self.first != self.last
                and (self.total - self.first * self.pages) % (self.last - self.first) != 0)


def _match(node: Node, tree: tuple, memo: dict) -> int:
    """Simple tree matching: size of the largest order-keeping mapping of equal labels."""
    if node.label != tree[0]:
        return 0
    key = (id(node), tree)
    if key not in memo:
        rows = [[0] * (len(tree[1]) + 1)]
        for kid in node.kids:
            above, row = rows[-1], [0]
            for j, sub in enumerate(tree[1]):
                row.append(max(above[j + 1], row[j], above[j] + _match(kid, sub, memo)))
            rows.append(row)
        memo[key] = (1 + rows[-1][-1], rows)
    return memo[key][0]


def align(node: Node, tree: tuple, grow: bool) -> list[Node | None]:
    """Template node of each node of the tree, in order of their beginnings; grow: adds nodes that have none."""
    memo: dict = {}
    out: list[Node | None] = []

    def visit(node: Node | None, tree: tuple):
        out.append(node)
        pairs: dict[int, Node] = {}
        if node is not None:
            _match(node, tree, memo)
            rows = memo[(id(node), tree)][1]
            i, j = len(node.kids), len(tree[1])
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs[j] = node.kids[i]
            if grow:
                place = 0
                for j, sub in enumerate(tree[1]):
                    if j in pairs:
                        place = node.kids.index(pairs[j]) + 1
                    else:
                        pairs[j] = Node(sub[0])
                        node.kids.insert(place, pairs[j])
                        place += 1
        for j, sub in enumerate(tree[1]):
            visit(pairs.get(j), sub)

    visit(node, tree)
    return out


def mark_content(root: Node) -> None:
    """Sets ``content`` on the slots that may hold main text."""
    def walk(node: Node, in_article: bool):
        in_article = in_article or node.label.split(".")[0] in ARTICLE
        if _left_out(node.label, in_article):
            return
        node.content = node.low is not None and not node.constant() and node.links <= LINKS * node.chars
        for kid in node.kids:
            walk(kid, in_article)

    walk(root, False)


def _dump(node: Node) -> list:
    return [node.label, int(node.content), [_dump(k) for k in node.kids]]


def _load(data: list) -> Node:
    node = Node(data[0])
    node.content, node.kids = bool(data[1]), [_load(k) for k in data[2]]
    return node


def _tree(data: list) -> tuple:
    return data[0], tuple(_tree(c) for c in data[1])


# ------------------------------------------------------------------ Spark steps
_SEEN = pa.schema([("host", pa.string()), ("shape", pa.string()), ("node", pa.int32()), ("low", pa.int64()),
                   ("high", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("total", pa.int64()),
                   ("pages", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])
_SEEN_DDL = ("host string, shape string, node int, low long, high long, first long, last long, total long, "
             "pages long, chars long, links long")


def _observe(batches):
    """(host, html) -> what the pages of a slice have in each node, by host and shape."""
    for part in chunks(batches, "html"):
        seen: dict[tuple, Node] = {}
        for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            page = Page(source or "")
            tree, number = page.shape()
            texts = page.texts(number)
            article = page.article()
            for k, (text, links) in texts.items():
                key = (host, tree, k)
                if key not in seen:
                    seen[key] = Node("")
                h = _hash(text)
                seen[key].see(h, h, article, article, article, 1, len(text), links)
        names: dict[tuple, str] = {}
        for _, tree, _ in seen:
            if tree not in names:
                names[tree] = json.dumps(tree, ensure_ascii=False)
        rows = [(host, names[tree], k, n.low, n.high, n.first, n.last, n.total, n.pages, n.chars, n.links)
                for (host, tree, k), n in seen.items()]
        if rows:
            yield arrow_batch(_SEEN, *zip(*rows))


_WRAPPERS = pa.schema([("host", pa.string()), ("wrapper", pa.string())])


def _fold(batches):
    """Rows sorted by (host, shape, node): folds the shapes of a host into its template."""
    host = shape = root = None
    places: list[Node | None] = []

    def done():
        mark_content(root)
        return arrow_batch(_WRAPPERS, [host], [json.dumps(_dump(root), ensure_ascii=False)])

    for batch in batches:
        for h, s, k, *seen in zip(*[c.to_pylist() for c in batch.columns]):
            if root is None or h != host:
                if root is not None:
                    yield done()
                host, shape, root = h, None, Node("#")
            if s != shape:
                shape = s
                places = align(root, _tree(json.loads(s)), True)
            places[k].see(*seen)
    if root is not None:
        yield done()


def wrappers(pages: DataFrame) -> DataFrame:
    """pages (host, html) -> host, wrapper: one row for each host with text."""
    seen = pages.select("host", "html").mapInArrow(_observe, _SEEN_DDL)
    seen = seen.groupBy("host", "shape", "node").agg(
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("total").alias("total"),
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    return (seen.repartition("host").sortWithinPartitions("host", "shape", "node")
            .mapInArrow(_fold, "host string, wrapper string"))


def _in_article(tree: tuple) -> list[bool]:
    """Whether each node of the tree is or stands below an article, in order of their beginnings."""
    out: list[bool] = []

    def walk(tree: tuple, inside: bool):
        inside = inside or tree[0].split(".")[0] in ARTICLE
        out.append(inside)
        for sub in tree[1]:
            walk(sub, inside)

    walk(tree, False)
    return out


class Extractor:
    """Main text by wrapper; remembers templates and alignments."""

    def __init__(self):
        self.roots: dict[str | None, Node] = {}
        self.known: dict[tuple, tuple[list[bool], list[bool]]] = {}

    def text(self, wrapper: str | None, source: str) -> str:
        page = Page(source)
        if not page.blocks:
            return ""
        tree, number = page.shape()
        key = (wrapper, tree)
        if key not in self.known:
            if len(self.known) > SHAPES_KEPT:
                self.roots, self.known = {}, {}
            if wrapper not in self.roots:
                self.roots[wrapper] = _load(json.loads(wrapper))
            content = [n is not None and n.content for n in align(self.roots[wrapper], tree, False)]
            self.known[key] = content, [a and b for a, b in zip(content, _in_article(tree))]
        content, inside = self.known[key]
        if any(inside[number[k]] for k, _, _ in page.blocks):
            content = inside
        return "\n".join(block for k, block, _ in page.blocks if content[number[k]])


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars."""
    ready(pages.sparkSession)
    pages = pages.select("page_id", "url", "html", host_and_path(F.col("url"))[0].alias("host"))
    found = stored(wrappers(pages), "wrappers")
    schema = pa.schema([("page_id", same_type(pages, "page_id")), ("url", pa.string()), ("text", pa.string()),
                        ("n_chars", pa.int64())])

    def run(batches):
        extractor = Extractor()
        for part in chunks(batches, "html"):
            texts = [extractor.text(w, h) if h and w else "" for h, w in zip(
                part.column(2).to_pylist(), part.column(3).to_pylist())]
            yield arrow_batch(schema, part.column(0), part.column(1).cast(pa.string()), texts, [len(t) for t in texts])

    kind = pages.schema["page_id"].dataType.simpleString()
    return (pages.join(found, "host", "left").select("page_id", "url", "html", "wrapper")
            .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long"))
