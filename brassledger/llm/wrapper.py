"""Main text of web pages by wrapper induction: same-host pages aligned by simple tree matching.

A page is read into a folded DOM tree: inline elements belong to the text of their block, neighbouring elements of one
label (tag and class) are one node, and so are all paragraphs, headings, lists, tables of one parent, so a tree is as
large as a page's layout and not as its text.  Trees of one host are aligned by simple tree matching (equal labels,
order kept, as many nodes as possible) and merged node by node: a node that says the same on all pages of the host is
template, one that varies is a slot.  Merging starts in the tasks that read the pages, goes on over salted parts of a
host and ends per host, so a host with a third of all pages is as many small merges as others; the template of a host
is small.  A second pass aligns each page with its host's template and keeps its text in content slots:

* never: menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and the like, known by tag, role
  or words of their class or id; they vary from page to page on many sites, so alignment cannot tell them;
* what stands in an article (or else in the main element), but containers there that say the same on all pages;
* on pages without either: the slots, but those that are mostly links, and no template.

A host with a single distinct page has no template; there all nodes count as slots.

Text is the whole text: character references decoded, white space in a block one space, blocks joined by a space.

Nulls and odd rows: null html is empty, and a page without markup is one block; pages without host (null url, no
``://``) are aligned with each other; elements nested deeper than `DEPTH` belong to the one at that depth; repeated
rows and null ids are pages of their own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brassledger.session import staged

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript noframes noembed xmp template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br img input".split()
)
FLOW = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr td th figure figcaption "
    "hr address details summary".split()
)
IN_HEAD = frozenset("title meta link script style base noscript template".split())
LEFT_OUT = frozenset("head nav aside footer form menu menuitem dialog button select option optgroup datalist fieldset object canvas audio video map".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Words of class names and ids that mark boilerplate.
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar aside footer cookie cookies consent notice notices alert newsletter subscribe "
    "popup modal overlay comment comments reply replies respond disqus share sharing social related recommended search "
    "login signup pagination pager skip toolbar widget".split()
)
HEADER_WORDS = frozenset("header masthead topbar".split())  # of the page, unless inside its article
CLOSED_BY = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "thead": frozenset({"thead", "tbody", "tr", "td", "th"}),
    "tbody": frozenset({"thead", "tbody", "tr", "td", "th"}), "tfoot": frozenset({"thead", "tbody", "tr", "td", "th"}),
}

DEPTH = 200
MERGE_PARTS = 64
DENSE = 0.5  # share of a slot's characters in links from which it is a list of links
VARIES = -1

_MARKUP = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<!(?!--)[^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A node of a folded tree; in a template it stands for its kind on all pages."""

    __slots__ = ("kids", "label", "links", "said", "size")

    def __init__(self, label: str):
        self.label, self.kids = label, []
        self.said, self.size, self.links = 0, 0, 0  # checksum of its own text, characters, characters within links

    def say(self, raw: str, linked: bool) -> None:
        self.said = zlib.crc32(raw.encode("utf-8", "replace"), self.said)
        self.size += len(raw)
        self.links += len(raw) if linked else 0

    def kid(self, label: str, tag: str) -> Node:
        if self.kids and self.kids[-1].label == label:
            return self.kids[-1]
        if tag in FLOW:
            for k in self.kids:
                if k.label == label:
                    return k
        self.kids.append(Node(label))
        return self.kids[-1]

    def dump(self) -> list:
        return [self.label, self.said, self.size, self.links, [k.dump() for k in self.kids]]


def load(dumped: list) -> Node:
    node = Node(dumped[0])
    node.said, node.size, node.links = dumped[1:4]
    node.kids = [load(k) for k in dumped[4]]
    return node


# ---------------------------------------------------------------- reading a page
def _label(tag: str, attributes: str, inside: bool) -> str:
    """``tag.class``, with a mark in front: `-` for boilerplate, `+` for an article, `*` for a main element."""
    if tag in ("html", "body"):
        return tag
    named: dict[str, str] = {}
    if attributes:
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            named.setdefault(name.lower(), a or b or c)
    kinds = " ".join(sorted(re.sub(r"\d+", "", named.get("class", "")).split()))
    words = {w.lower() for w in _WORD.findall(f"{named.get('class', '')} {named.get('id', '')}")}
    role = named.get("role", "").lower()
    hidden = named.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|$)", re.sub(r"""(["']).*?\1""", "", attributes)) if attributes else False
    mark = ""
    if tag in LEFT_OUT or role in LEFT_OUT_ROLES or words & LEFT_OUT_WORDS or hidden:
        mark = "-"
    elif not inside and (tag == "header" or words & HEADER_WORDS):
        mark = "-"
    elif tag == "article" or "articlebody" in named.get("itemprop", "").lower():
        mark = "+"
    elif tag == "main" or role == "main":
        mark = "*"
    return f"{mark}{tag}.{kinds}" if kinds else f"{mark}{tag}"


def read(html: str) -> tuple[Node, list[tuple[Node, list[str]]]]:
    """The folded tree of a page, and its blocks (node, raw pieces of text) in page order; boilerplate has no blocks."""
    root = Node("")
    stack = [(root, "", False, False)]  # node, tag, left out, inside an article or main element
    blocks: list[tuple[Node, list[str]]] = []
    pieces: list[str] = []
    linked = 0
    lower = None

    def end_block() -> None:
        nonlocal pieces
        if pieces:
            if any(not p.isspace() for p in pieces):
                blocks.append((stack[-1][0], pieces))
            pieces = []

    def text(raw: str) -> None:
        if not raw:
            return
        if stack[-1][1] == "head" and not raw.isspace():
            close("head")
        node, _, out, _ = stack[-1]
        if not out:
            pieces.append(raw)
            if not raw.isspace():
                node.say(raw, linked > 0)

    def close(tag: str) -> None:
        nonlocal linked
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][1] == tag:
                end_block()
                del stack[at:]
                linked = 0
                return
            if tag in FLOW and stack[at][1] not in FLOW and stack[at][1] not in INLINE:
                return

    at = 0
    while True:
        found = _MARKUP.search(html, at)
        if not found:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "a":
                linked = 0
            if tag not in INLINE or any(s[1] == tag for s in stack[1:]):
                close(tag)
            continue
        if not html.endswith(">", 0, at):
            break  # a tag that never ends
        if stack[-1][1] == "head" and tag not in IN_HEAD:
            close("head")
        if tag == "body":
            close("head")
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at) if len(lower) == len(html) else -2
            if end == -2:
                m = re.compile(f"</{tag}", re.I).search(html, at)
                end = m.start() if m else -1
            at = len(html) if end < 0 else end
            if tag in ("textarea", "iframe", "title"):
                end_block()
            continue
        label = None
        if tag in INLINE:
            if tag == "br":
                if pieces:
                    pieces.append("\n")
                continue
            if tag == "a":
                linked = 1
            if not found[3] or tag in VOID:
                continue
            label = _label(tag, found[3], stack[-1][3])
            if not label.startswith("-"):
                continue  # inline, part of its block
        if tag in FLOW or tag not in INLINE:
            for gone in CLOSED_BY.get(tag, ()):
                for s in reversed(stack[1:]):
                    if s[1] == gone:
                        close(gone)
                        break
                    if s[1] in ("ul", "ol", "dl", "table") or s[1] not in FLOW:
                        break
            close("p")
        end_block()
        if tag in VOID or len(stack) > DEPTH:
            continue
        parent, _, out, inside = stack[-1]
        label = label or _label(tag, found[3], inside)
        node = parent.kid(label, tag)
        stack.append((node, tag, out or label[0] == "-", inside or label[0] in "+*"))
    end_block()
    return root, blocks


def squeeze(pieces: list[str]) -> str:
    """Pieces are raw text between tags: references are decoded in each by itself, as none reaches over a tag."""
    return " ".join("".join(unescape(p) if "&" in p else p for p in pieces).split())


# ---------------------------------------------------------------- simple tree matching
def match(a: Node, b: Node) -> tuple[int, list]:
    """Nodes that can be paired under equal roots, order kept, and the pairs of children (i, j, their pairs)."""
    m, n = len(a.kids), len(b.kids)
    if not m or not n:
        return 1, []
    below = {(i, j): match(x, y) for i, x in enumerate(a.kids) for j, y in enumerate(b.kids) if x.label == y.label}
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            with_both = best[i - 1][j - 1] + below[i - 1, j - 1][0] if (i - 1, j - 1) in below else 0
            best[i][j] = max(best[i - 1][j], best[i][j - 1], with_both)
    pairs, i, j = [], m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j, below[i, j][1]))
    return 1 + best[m][n], pairs[::-1]


def merge(a: Node, b: Node, pairs: list | None = None) -> Node:
    """Both trees in one; what only one of them has is inserted where it stands."""
    pairs = match(a, b)[1] if pairs is None else pairs
    both = Node(a.label)
    both.said = a.said if a.said == b.said else VARIES
    both.size, both.links = a.size + b.size, a.links + b.links
    i = j = 0
    for x, y, sub in [*pairs, (len(a.kids), len(b.kids), None)]:
        both.kids += a.kids[i:x] + b.kids[j:y]
        if sub is not None:
            both.kids.append(merge(a.kids[x], b.kids[y], sub))
        i, j = x + 1, y + 1
    return both


def shape(node: Node) -> tuple:
    return (node.label, *[shape(k) for k in node.kids])


# ---------------------------------------------------------------- templates
def page_tree(html: str) -> Node:
    """The tree that induction sees; the root's checksum tells whole pages apart."""
    root, _ = read(html)
    root.said = zlib.crc32(html.encode("utf-8", "replace"))
    return root


def decide(template: Node) -> list:
    """[label, tier, children] of a template: 3 article, 2 main element, 1 slot elsewhere, 0 nothing to keep."""
    alone = template.said != VARIES

    def varies_elsewhere(node: Node, but: Node) -> bool:
        return node is not but and node.label[:1] != "-" and (
            (node.said == VARIES and node.size > 0) or any(varies_elsewhere(k, but) for k in node.kids)
        )

    def walk(node: Node, region: Node | None, tier: int) -> list:
        if node.label.startswith("-"):
            return [node.label, 0, []]
        if node.label.startswith("+"):
            region, tier = (region if tier == 3 else node), 3
        elif node.label.startswith("*") and tier < 2:
            region, tier = node, 2
        fixed = not alone and node.said != VARIES
        tag = node.label.lstrip("+*").split(".")[0]
        if not node.size:
            own = tier  # no text yet; if a page has some there, it varies
        elif region is not None:
            constant = fixed and tag not in FLOW and node is not region and not node.kids and varies_elsewhere(region, node)
            own = 0 if constant else tier
        else:
            own = 0 if fixed or node.links > DENSE * node.size else 1
        return [node.label, own, [walk(k, region, tier) for k in node.kids]]

    return walk(template, None, 0 if template.size else 1)


def tiers(page: Node, decided: Node) -> dict[int, int]:
    """By id() of the page's nodes: the tier of the template's node it is aligned with."""
    found = {id(page): decided.size}

    def walk(a: Node, b: Node, pairs: list) -> None:
        for i, j, sub in pairs:
            found[id(a.kids[i])] = b.kids[j].size
            walk(a.kids[i], b.kids[j], sub)

    walk(page, decided, match(page, decided)[1])
    return found


def as_nodes(decided: list) -> Node:
    node = Node(decided[0])
    node.size = decided[1]
    node.kids = [as_nodes(k) for k in decided[2]]
    return node


def content(html: str, decided: Node, known: dict | None = None) -> str:
    """The text of a page, given the template of its host; `known` keeps alignments of pages of one shape."""
    page, blocks = read(html)
    nodes: list[Node] = []

    def flat(node: Node) -> None:
        nodes.append(node)
        for k in node.kids:
            flat(k)

    flat(page)
    known = {} if known is None else known
    kind = shape(page)
    if kind not in known:
        by_id = tiers(page, decided)
        known[kind] = [by_id.get(id(n), 0) for n in nodes]
    tier = {id(n): t for n, t in zip(nodes, known[kind], strict=True)}
    best = max((tier[id(n)] for n, _ in blocks), default=0)
    return " ".join(s for n, pieces in blocks if best and tier[id(n)] == best and (s := squeeze(pieces)))


# ---------------------------------------------------------------- over the cluster
def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def _merged(trees: list[str]) -> Node:
    whole = None
    for tree in sorted(trees):
        whole = load(json.loads(tree)) if whole is None else merge(whole, load(json.loads(tree)))
    return whole


def templates(pages: DataFrame) -> DataFrame:
    """(host, decided): for every host its merged template, as JSON."""

    def read_pages(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Node] = {}
        for frame in frames:
            for host, html in zip(frame["host"], frame["html"], strict=True):
                tree = page_tree(html)
                found[host] = merge(found[host], tree) if host in found else tree
        yield pd.DataFrame([(h, json.dumps(t.dump())) for h, t in found.items()], columns=["host", "tree"])

    def some(key, frame):
        return pd.DataFrame({"host": [key[0]], "tree": [json.dumps(_merged(list(frame["tree"])).dump())]})

    def all_(key, frame):
        return pd.DataFrame({"host": [key[0]], "decided": [json.dumps(decide(_merged(list(frame["tree"]))))]})

    parts = pages.select("host", "html").mapInPandas(read_pages, "host string, tree string")
    parts = parts.withColumn("part", F.spark_partition_id() % MERGE_PARTS)
    fewer = parts.groupBy("host", "part").applyInPandas(some, "host string, tree string")
    return fewer.groupBy("host").applyInPandas(all_, "host string, decided string")


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    rows = pages.select(
        F.col("page_id").cast("long").cast("string").alias("page_id"),  # as text: pandas would make floats beside nulls
        "url",
        host_of(F.col("url")).alias("host"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    known = staged(templates(rows), "templates")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, tuple[Node, dict]] = {}
        for frame in frames:
            texts = []
            for html, decided in zip(frame["html"], frame["decided"], strict=True):
                if decided not in seen:
                    if len(seen) >= 1000:
                        seen.clear()  # a memory of the task, not a limit: it fills again
                    seen[decided] = (as_nodes(json.loads(decided)), {})
                template, shapes = seen[decided]
                if len(shapes) >= 1000:
                    shapes.clear()
                texts.append(content(html, template, shapes))
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts})

    found = rows.join(known, "host").select("page_id", "url", "html", "decided").mapInPandas(run, "page_id string, url string, text string")
    return found.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
