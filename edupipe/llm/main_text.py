"""The main text of pages by composite text density.

A page is parsed into a tree of elements.  Elements that are never article text (scripts, menus,
forms and the like, by tag, role or class) are taken out.  Every other node gets its
characters per tag, adjusted by how many of both belong to links, and the sum of its
block children's densities.  The subtree with the greatest sum is the article's core; the least
density on its path up to the body is the threshold: beside that path, every block that
reaches it is searched for its own subtree of greatest sum, and those subtrees are the main text.
Headings directly before them belong to it.  Where the core stands in an ``article`` or ``main``
element, that element is the main text.  Lists of links below the threshold are left out.

Inside the main text each block element is a line.  Character references are decoded, runs of
white space become one space, lines are trimmed and empty ones left out; ``br`` is white space.

Defined results.  A null or empty page, and one without text, gives the empty text.  Unclosed and
misplaced tags are closed as browsers do for paragraphs, items, rows and cells; a page without
body is its own body.  Every row gives one row, repeated rows too; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.llm.common import small_batches

# Names of HTML elements by what they mean for the text.
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg math object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset("head nav footer aside form button select option input label fieldset menu dialog audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_PARAGRAPH = BLOCKS - frozenset("html body caption tbody td tfoot th thead tr legend".split())
#: tag -> (open tags that it closes, tags beyond which it does not look)
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tbody": (frozenset("thead tbody tfoot tr td th".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: words of class, id or role that mark what is not the article
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion promoted banner banners "
    "nav navbar navigation menu menus menubar breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets complementary toc "
    "header masthead topbar footer foot bottombar colophon contentinfo "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay paywall newsletter subscribe subscription signup login "
    "search searchbox form toolbar share sharing social related recommended recommendations more-like trending pagination pager "
    "comment comments commentlist respond reply replies disqus discussion feedback reviews skip".split()
)
#: words beside a mark that make it a matter of layout, as in "has-sidebar"
LAYOUT = frozenset("has no with without layout".split())
#: marks that count on an article element too, and those that do not count inside an article
OF_ARTICLES = frozenset("ad ads advert sponsored promo related comment comments reply replies".split())
IN_ARTICLES = frozenset("header masthead".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
PARTS = re.compile(r"[a-z0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = ("tag", "parent", "parts", "noise", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, noise: bool) -> None:
        self.tag, self.parent, self.noise = tag, parent, noise
        self.parts: list[Node | str] = []  # elements and texts in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def _is_noise(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in NEVER or (tag == "header" and not inside_article):
        return True
    if not attributes:
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value.strip() in ROLES:
            return True
        if name in ("class", "id") and tag != "main" and not (inside_article and tag in HEADINGS):
            marks = OF_ARTICLES if tag == "article" else NOISE - IN_ARTICLES if inside_article else NOISE
            for word in value.split():
                parts = PARTS.findall(word)
                if word in marks or (not marks.isdisjoint(parts) and LAYOUT.isdisjoint(parts)):
                    return True
        if (name == "aria-hidden" and value == "true") or (name == "style" and HIDDEN.search(value)):
            return True
    return "hidden" in attributes.lower().split()


def parse(page: str) -> Node:
    """The body of a page as a tree without what is never text."""
    root = here = Node("body", None, False)
    at, open_article = 0, 0

    def close(node: Node) -> Node:
        nonlocal open_article
        open_article -= node.tag in ("article", "main")
        return node.parent

    while at < len(page):
        start = page.find("<", at)
        token = TOKEN.match(page, start) if start >= 0 else None
        if token is None:  # text up to here; a "<" that begins no tag is text
            end = len(page) if start < 0 else start + 1
            here.parts.append(page[at:end])
            at = end
            continue
        if start > at:
            here.parts.append(page[at:start])
        at = token.end()
        closing, tag, attributes = token.group(1, 2, 3) if token[2] else token.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:  # an end tag without a start is left out
                while here is not node:
                    here = close(here)
                here = close(here)
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in ("html", "body"):
            continue
        node, ends = None, here
        if tag in ENDS_PARAGRAPH:
            while ends is not root and ends.tag not in ("td", "th", "table", "button", "caption"):
                node = ends if ends.tag == "p" else node
                if node:
                    break
                ends = ends.parent
        elif tag not in CLOSES and tag != "head":
            node = None
        if tag in CLOSES:
            closed, limits = CLOSES[tag]
            ends = here
            while ends is not root and ends.tag not in limits:
                node = ends if ends.tag in closed else node
                ends = ends.parent
        if node is None and here.tag == "head" and tag in BLOCKS:
            node = here
        if node is not None:
            while here is not node:
                here = close(here)
            here = close(here)
        made = Node(tag, here, _is_noise(tag, attributes, open_article > 0))
        here.parts.append(made)
        if tag in ("article", "main") and not made.noise:  # what holds the article is no sidebar, whatever its class says
            above = here
            while above is not None:
                if above.tag in ("div", "section", "span", "form"):
                    above.noise = False
                above = above.parent
        if tag not in VOID and not attributes.endswith("/"):
            open_article += tag in ("article", "main")
            here = made
        elif tag not in VOID and tag in BLOCKS:  # a slash does not close a block
            open_article += tag in ("article", "main")
            here = made
    return root


def _order(root: Node) -> list[Node]:
    """The nodes above noise, parents before children."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.noise]
    return found


def _links(root: Node) -> tuple[int, int]:
    """Characters in links and all characters of the whole body, menus included."""
    linked = total = 0
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag == "a"
        for part in node.parts:
            if isinstance(part, Node):
                stack.append((part, inside))
            else:
                n = len("".join(part.split()))
                total += n
                linked += n * inside
    return linked, total


def measure(root: Node) -> list[Node]:
    """Densities of all nodes; the nodes, parents before children."""
    linked, total = _links(root)
    share = linked / max(1, total)
    nodes = _order(root)
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(" ".join(html.unescape(part).split()))
            elif not part.noise:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags
                node.sum += part.density * (part.tag in BLOCKS)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.chars:
            tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
            plain = max(1, node.chars - node.link_chars)
            base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
            # the base exceeds e as long as anything on the page is a link; the floor holds for the rest
            adjusted = math.log(max(1.0, node.chars / links * tags / link_tags)) / max(0.5, math.log(base))
            node.density = node.chars / tags * adjusted
    return nodes


def _free_forms(root: Node) -> None:
    """A form around most of the page's text is how the page was made, not a form to fill in."""
    texts: list[tuple[Node, int]] = []
    stack = [root]
    while stack:
        node = stack.pop()
        texts.append((node, sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))))
        stack += [p for p in node.parts if isinstance(p, Node)]
    inside = {id(node): own for node, own in texts}
    for node, _ in reversed(texts):  # children before parents
        if node.parent is not None:
            inside[id(node.parent)] += inside[id(node)]
    for node, _ in texts:
        if node.tag == "form" and 2 * inside[id(node)] > inside[id(root)]:
            node.noise = False


def select(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in page order."""
    if any(isinstance(p, Node) and p.noise and p.tag == "form" for n in _order(root) for p in n.parts):
        _free_forms(root)
    nodes = measure(root)
    if not root.chars:
        return []
    core = _core(nodes) or root  # the first of equals is the outermost
    threshold, node = core.density, core
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    for node in nodes:  # lists of links are dense in tags and links, whatever they are called
        if node.tag in BLOCKS and node.link_tags > 1 and 2 * node.link_chars > node.chars and node.density < threshold:
            node.noise = not _holds(node, core)
    chosen: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node is core:
            chosen.append(node)
        elif _holds(node, core):
            stack += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.noise]
        elif node.tag in BLOCKS and node.density >= threshold and node.chars:
            chosen.append(_core(_order(node)) or node)
    return _with_headings(chosen)


def _core(nodes: list[Node]) -> Node | None:
    """The node with the greatest sum among those that are made of blocks."""
    made = [n for n in nodes if any(isinstance(p, Node) and p.tag in BLOCKS and p.chars and not p.noise for p in n.parts)]
    return max(made, key=lambda n: n.sum, default=None)


def _holds(node: Node, core: Node) -> bool:
    while core is not None:
        if core is node:
            return True
        core = core.parent
    return False


def _with_headings(chosen: list[Node]) -> list[Node]:
    """A heading that stands directly before a chosen subtree introduces it."""
    found: list[Node] = []
    for node in chosen:
        if node.parent is not None:
            before = [p for p in node.parent.parts[: node.parent.parts.index(node)] if not (isinstance(p, str) and not p.strip())]
            heads = []
            while before and isinstance(before[-1], Node) and (before[-1].tag in HEADINGS or before[-1].noise):
                part = before.pop()
                if not part.noise:
                    heads.append(part)
            found += [h for h in reversed(heads) if h not in chosen]
        found.append(node)
    return found


def lines(node: Node) -> list[str]:
    """The blocks of a subtree, white space collapsed, empty ones left out."""
    done: list[str] = []
    held: list[str] = []

    def end() -> None:
        line = " ".join("".join(held).split())
        held.clear()
        if line:
            done.append(line)

    stack: list[Node | str | None] = [node]
    while stack:
        part = stack.pop()
        if part is None:
            end()
        elif isinstance(part, str):
            held.append(html.unescape(part))
        elif part.noise:
            if part.tag in BLOCKS:
                end()
        elif part.tag == "br":
            held.append(" ")
        else:
            if part.tag in BLOCKS:
                end()
                stack.append(None)
            stack += reversed(part.parts)
    end()
    return done


def main_text(page: str | None) -> str:
    found: list[str] = []
    for node in select(parse(page or "")):
        found += lines(node)
    return "\n".join(found)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    known = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return known.mapInArrow(read, "page_id long, url string, text string, n_chars long")
