"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import arrow_rows, in_batches, take

# ----------------------------------------------------------- fixed values: HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body caption head html legend optgroup option tbody td tfoot th thead tr".split())
# An opening tag ends an open element of these names, looked for up to the stops.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup"])),
}
# ------------------------------------------- fixed values: what is not the article
NOT_TEXT = RAW | frozenset("head nav footer svg button select menu dialog object canvas".split())
# Dropped too, but for one that holds nearly all text: some sites wrap every page in a form.
MOSTLY_NOT_TEXT = frozenset(["form", "aside"])
NOT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
NOT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs pagination pager sidebar aside footer header masthead banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
    "disqus respond reply replies share sharing social related recommended toolbar skip".split()
)
# Names of what readers wrote, and words that turn a name into its absence or into a trait of a wrapper.
READER_NAMES = frozenset("comment comments disqus respond reply replies".split())
QUALIFIERS = frozenset("no has have with without hide hides hidden".split())
# A named element is the page itself if it holds more than this share of the text outside links.
WRAPPER, READER_WRAPPER = 0.5, 0.9
# The density of an element called article counts so many times beside another one.
RAISED = 2.0
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD = frozenset("base link meta title style script noscript template".split())
CONTENT = frozenset(["article", "main", "body", "html"])

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTR = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = (
        "tag", "parent", "children", "named", "dropped", "inside", "beside",
        "chars", "tags", "link_chars", "link_tags", "density", "total",
    )

    def __init__(self, tag: str, parent: Node | None, named: float = 0.0, dropped: bool = False):
        self.tag, self.parent, self.children, self.named, self.dropped = tag, parent, [], named, dropped
        # Whether its children are in an article or main, and whether they are in an aside.
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.beside = tag == "aside" or parent is not None and parent.beside
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(text)}


def _never_text(tag: str, found: dict[str, str], in_article: bool) -> bool:
    """Dropped for its tag, its role or because it is hidden."""
    if tag in NOT_TEXT or tag == "header" and not in_article:
        return True
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none", found.get("style", "")):
        return True
    return found.get("role", "").lower() in NOT_ROLES


def _named_aside(found: dict[str, str], in_article: bool) -> float:
    """0.0 unless named like a menu, an advert and so on by the words of its class or id.

    Otherwise the share of the text above which it is a wrapper all the same.
    Words after a qualifier (``has-sidebar``, ``no-nav``) do not count.
    """
    words = set()
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        for word in NAME_PARTS.findall(name):
            if word.lower() in QUALIFIERS:
                break
            words.add(word.lower())
    words &= NOT_NAMES - {"header"} if in_article else NOT_NAMES
    return (READER_WRAPPER if words & READER_NAMES else WRAPPER) if words else 0.0


def _plain_chars(nodes: list[Node]) -> dict[int, int]:
    """Characters outside links and dropped elements by ``id`` of the node; ``nodes`` are in page order."""
    chars: dict[int, int] = {}
    for node in reversed(nodes):
        own = sum(len("".join(c.split())) if isinstance(c, str) else chars[id(c)] for c in node.children)
        chars[id(node)] = 0 if node.dropped or node.tag == "a" else own
    return chars


class _Open:
    """The open elements, outermost first, and where those of each tag and the blocks are among them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        """Close the elements from place ``at`` on."""
        while len(self.nodes) > at:
            tag = self.nodes.pop().tag
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def last(self, tags: frozenset[str]) -> int:
        """Place of the innermost open element of these tags, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def end(self, tags: frozenset[str], stops: frozenset[str]) -> None:
        """Close the innermost element of these tags unless it holds an open one of ``stops``."""
        at = self.last(tags)
        if at > self.last(stops - tags):
            self.cut(at)

    def close(self, tag: str) -> None:
        """An end tag: of an element inside a block, or of a block; else it is a stray one."""
        at = self.last(frozenset([tag]))
        if at and (tag in BLOCKS or not self.blocks or self.blocks[-1] < at):
            self.cut(at)


def parse(page: str) -> Node:
    """The page as a tree; text is a ``str`` child. Unclosed and stray tags are mended as browsers do.

    The work grows with the page, however deep its elements are nested.
    """
    root = Node("html", None)
    opened, at, nodes, first = _Open(root), 0, [], None
    while at < len(page):
        tag = TAG.search(page, at)
        text = page[at : tag.start() if tag else len(page)]
        if text:
            opened.nodes[-1].children.append(html.unescape(text))
        if not tag:
            break
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name or name == "html" or name == "body" and tag["end"]:
            continue
        if tag["end"] and name != "br":
            opened.close(name)
            continue
        if opened.nodes[-1].tag == "head" and name not in HEAD:
            opened.cut(len(opened.nodes) - 1)
        if name == "body":
            if opened.places.get("body"):
                continue
            opened.cut(1)
        if name in ENDS:
            opened.end(*ENDS[name])
        if name in CLOSES_P:
            opened.end(frozenset(["p"]), CONTENT | frozenset(["td", "th", "button", "table"]))
        found = _attributes(tag["attrs"]) if tag["attrs"].strip("/ ") else {}
        parent = opened.nodes[-1]
        named = 0.0 if name in ("body", "main") else _named_aside(found, parent.inside)
        if name in MOSTLY_NOT_TEXT:
            named = READER_WRAPPER
        node = Node(name, parent, named, name != "body" and _never_text(name, found, parent.inside))
        parent.children.append(node)
        nodes.append(node)
        if not first and name in ("article", "main") and not named and not node.beside:
            first = node
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else len(page)
        elif name not in VOID:
            opened.push(node)
    holders, whole = set(), first or root
    while first:
        holders.add(id(first))
        first = first.parent
    if any(n.named and id(n) not in holders for n in nodes):
        chars = _plain_chars([root, *nodes])
        # What holds most of the text, of the article's if there is one, is a wrapper, whatever its name.
        inside = {id(whole)}
        for node in nodes:
            if id(node.parent) in inside:
                inside.add(id(node))
                if node.named and chars[id(node)] > node.named * chars[id(whole)]:
                    holders.add(id(node))
    for node in nodes:
        node.dropped |= node.parent.dropped or bool(node.named) and id(node) not in holders
    return root


def _walk(root: Node) -> list[Node]:
    """The nodes that are not dropped, parents first."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        found.append(node)
        waiting += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
    return found


def _density(node: Node, ratio: float) -> float:
    plain = max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + ratio * node.chars + math.e)
    share = node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1)
    return node.chars / max(node.tags, 1) * math.log(max(share, 1.0) + 1.0) / max(math.log(base + 1.0), 1e-9)


def measure(root: Node) -> list[Node]:
    """Set density and density sum of every node; the nodes, parents first.

    The density of a node is its characters per tag, lowered by the share of
    its characters and tags that are links, against the link share of the
    whole body. A run of text directly in a node counts as a child of one tag.
    """
    nodes = _walk(root)
    for node in reversed(nodes):
        own = sum(len(re.sub(r"\s+", "", c)) for c in node.children if isinstance(c, str))
        node.chars += own
        if node.tag == "a":
            node.link_chars = node.chars
        if node.parent:
            node.parent.chars += node.chars
            node.parent.tags += node.tags + 1
            node.parent.link_chars += node.link_chars
            node.parent.link_tags += node.link_tags + (node.tag == "a")
    ratio = root.link_chars / max(root.chars, 1)
    for node in nodes:
        if node.chars:
            node.density = _density(node, ratio)
    for node in nodes:
        runs = sum(len(re.sub(r"\s+", "", c)) for c in node.children if isinstance(c, str))
        node.total = runs + sum(c.density for c in node.children if isinstance(c, Node) and not c.dropped)
    return nodes


def main_nodes(root: Node) -> list[Node]:
    """The parts of the page that are its article, in page order.

    The article is the enclosing ``article`` or ``main`` of the subtree with
    the largest density sum; other articles of the same ``main`` are part of it
    if their density, raised for the tag, reaches that of the path from there
    to it, and so are headings directly before. Without one, the lowest density on the path from
    that subtree to the body is the threshold: the choice moves up while a
    block beside it reaches the threshold, and every other block of the page
    that reaches it is part of the article too, as is a heading that directly
    precedes such a part.
    """
    nodes = [n for n in measure(root) if n.chars and n.tag not in ("p", "a", "b", "i", "em", "strong", "span")]
    if not nodes:
        return [root]
    best = max(nodes, key=lambda n: n.total)
    path = [best]
    while path[-1].parent:
        path.append(path[-1].parent)
    main = next((n for n in path if n.tag == "main"), None)
    article = next((n for n in path if n.tag == "article"), None) or main
    if article:
        return _in_main(main, article, path) if main and main is not article else [article]
    threshold = min(n.density for n in path)
    while best.parent and best.parent.tag not in ("body", "html"):
        beside = [c for c in best.parent.children if isinstance(c, Node) and c is not best and not c.dropped]
        if not any(c.density >= threshold and c.chars for c in beside):
            break
        best = best.parent
    return _reaching(root, best, {id(n) for n in path}, threshold)


def _in_main(main: Node, article: Node, path: list[Node]) -> list[Node]:
    """``article``, the other articles of ``main`` as dense as the path between them, and the headings before any of them."""
    threshold = min(n.density for n in path[: path.index(main) + 1])
    seen, waiting = [], [main]
    while waiting:
        node = waiting.pop()
        if node is article or node.tag == "article" and RAISED * node.density >= threshold:
            seen.append((node, True))
        elif node.tag in HEADINGS:
            seen.append((node, False))
        else:
            inner = [c for c in node.children if isinstance(c, Node) and not c.dropped and c.chars]
            if not inner and node.chars and node.tag in BLOCKS:
                seen.append((node, None))
            waiting += reversed(inner)
    found, follows = [], False
    for node, reaches in reversed(seen):
        follows = bool(reaches) or reaches is False and follows
        if follows:
            found.append(node)
    return found[::-1]


def _parts(node: Node, path: set[int], ratio: float) -> list[Node]:
    """The blocks in a node; what stands between them is a paragraph each."""
    parts, run = [], None
    for child in node.children:
        if isinstance(child, Node) and child.dropped:
            continue
        if isinstance(child, Node) and (child.tag in BLOCKS or id(child) in path):
            parts.append(child)
            run = None
            continue
        if run is None:
            run = Node("p", node)
            parts.append(run)
        run.children.append(child)
        if isinstance(child, str):
            run.chars += len(re.sub(r"\s+", "", child))
        else:
            run.chars, run.link_chars = run.chars + child.chars, run.link_chars + child.link_chars
            run.tags, run.link_tags = run.tags + child.tags + 1, run.link_tags + child.link_tags + (child.tag == "a")
        run.density = _density(run, ratio) if run.chars else 0.0
    return [p for p in parts if p.chars]


def _reaching(root: Node, best: Node, path: set[int], threshold: float) -> list[Node]:
    """``best``, all blocks outside it that reach the threshold, and the headings before these."""
    ratio = root.link_chars / max(root.chars, 1)
    seen: list[tuple[Node, bool]] = []
    waiting = [root]
    while waiting:
        node = waiting.pop()
        above = id(node) in path and node is not best
        if node is best or not above and node.density >= threshold and not _is_link_list(node):
            seen.append((node, True))
        elif node.tag not in HEADINGS and (above or any(isinstance(c, Node) and c.tag in BLOCKS for c in node.children)):
            waiting += reversed(_parts(node, path, ratio))
        else:
            seen.append((node, False))
    found, follows = [], False
    for node, reaches in reversed(seen):
        follows = reaches or follows and node.tag in HEADINGS
        if follows:
            found.append(node)
    return found[::-1]


def _is_link_list(node: Node) -> bool:
    return node.tag in ("ul", "ol", "div", "table", "section") and node.link_tags > 1 and node.link_chars > 0.8 * node.chars


def main_text(page: str | None) -> str:
    """The article of a page, one line per block, in page order."""
    if not page:
        return ""
    root = parse(page)
    tops = main_nodes(root)
    blocks, current, chosen = [], [], {id(n) for n in tops}

    def flush() -> None:
        line = " ".join("".join(current).split())
        current.clear()
        if line:
            blocks.append(line)

    waiting: list[Node | str | None] = tops[::-1]
    while waiting:
        item = waiting.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            current.append(item)
        elif item.tag == "br":
            current.append(" ")
        elif not item.dropped and not (id(item) not in chosen and _is_link_list(item)):
            inner: list[Node | str | None] = list(reversed(item.children))
            if item.tag in BLOCKS:
                flush()
                inner.insert(0, None)
            waiting += inner
    flush()
    return "\n".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def rows():
        for page_id, url, page in arrow_rows(batches, "page_id", "url", "html"):
            text = main_text(page)
            yield page_id, url, text, len(text)

    yield from in_batches(rows(), schema, 512)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    Each page is parsed whole, in the task that reads it; nothing shuffles.
    Menus, headers and footers of the page, sidebars, notices, adverts, forms,
    scripts, styles and reader comments are dropped by tag, role and by the
    words of ``class`` and ``id``, unless an element that is only so named
    holds most of the text; of what is left the subtree with the largest
    sum of link-adjusted characters per tag is the article, with every block
    of the page that is as dense as the path from there to the body. Character
    references are decoded, white space becomes one space, blocks are joined by
    a line break and nothing is cut.

    A null or empty page, or one without text, gives an empty text. Null ids
    and urls pass through, repeated rows give repeated results, an empty table
    an empty one.
    """
    rows = take(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
