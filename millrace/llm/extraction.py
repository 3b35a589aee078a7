"""Main text of web pages by composite text density.

A page becomes a tree. For every node the characters per tag are adjusted by
how much of them is link text (the composite text density), and the densities
of a node's children are summed. The node with the largest sum holds the
article; the smallest density on its path to the body is the threshold for
what else on the page belongs to it.

What a page's own markup says is heeded first: scripts, styles, navigation,
the like are no text. Forms, and elements whose class or id names an advert, a
sidebar, a notice or comments, are none if their text is sparse or links; what
holds most of the page's text is its frame, whatever its name. An element that the page marks as an
article is taken whole if it holds more text than what the densities find
outside of all articles; else articles are teasers or comments beside the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices

# Elements of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
NOISE = set("head nav footer aside button select dialog menu object canvas audio video".split()) | RAW
FORMS = {"form", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Elements whose id is often made from a heading or an entry of the text.
SLUGGED = {"section", "p", "li", "dt", "dd", "td", "th", "tr", "figure", "blockquote", "pre", "a"} | HEADINGS
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
CLOSED_BY_BLOCK = {"p"}
# An element on the left ends at the start of one on the right, up to the scope.
ENDS_AT = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# Words in a class, id or role that name what is not the article.
NOISE_WORDS = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pagination pager popup promo promotion recommended related "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets "
    "complementary contentinfo alert replies reply respond responses".split()
)
# Those that name what others wrote, or other articles, often marked as articles.
BOX_WORDS = set("comment comments disqus related recommended replies reply respond responses".split())
# Words that say of which form a box is, not what is in it.
FORM_WORDS = set(
    "area bar block body bottom box btn button buttons col column container content footer form group header holder "
    "icon icons inner item items js left link links list main module outer panel posts right row section side slot "
    "stories text title top unit wrap wrapper".split()
)
ARTICLE = {"article", "main"}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)|([^\s=/>\"']+)")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    """An element; ``parts`` are its texts and children in page order."""

    __slots__ = ("tag", "parent", "parts", "noise", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, noise: str = ""):
        self.tag, self.parent, self.noise = tag, parent, noise
        self.parts: list[Node | str] = []

    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node) and not p.noise]


def parse(page: str) -> Node:
    """The page's tree; markup that is not well formed is closed where HTML closes it."""
    root = Node("#root", None)
    open_nodes, at = [root], 0
    for found in iter(lambda: TOKEN.search(page, at), None):
        if found.start() > at:
            open_nodes[-1].parts.append(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            _close(open_nodes, tag)
            continue
        _make_room(open_nodes, tag)
        node = Node(tag, open_nodes[-1], _noise(tag, found[3]))
        open_nodes[-1].parts.append(node)
        if tag in VOID or found[3].endswith("/") and tag in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        open_nodes.append(node)
    if at < len(page):
        open_nodes[-1].parts.append(page[at:])
    return root


def _close(open_nodes: list[Node], tag: str) -> None:
    for k in range(len(open_nodes) - 1, 0, -1):
        if open_nodes[k].tag == tag:
            del open_nodes[k:]
            return
        # An inline end tag does not reach out of its block.
        if tag in INLINE and open_nodes[k].tag not in INLINE:
            return


def _make_room(open_nodes: list[Node], tag: str) -> None:
    """Closes what ends where ``tag`` begins."""
    if tag not in INLINE and tag not in VOID and tag not in RAW:
        for k in range(len(open_nodes) - 1, 0, -1):
            if open_nodes[k].tag in CLOSED_BY_BLOCK:
                del open_nodes[k:]
                break
            if open_nodes[k].tag not in INLINE:
                break
    if tag in ENDS_AT:
        ended, scope = ENDS_AT[tag]
        for k in range(len(open_nodes) - 1, 0, -1):
            if open_nodes[k].tag in scope and open_nodes[k].tag not in ended:
                break
            if open_nodes[k].tag in ended:
                del open_nodes[k:]
                if tag != "tr":
                    break


def _noise(tag: str, attributes: str) -> str:
    """Why the element may be no text: ``tag``, ``header``, a suspicion that ``_settle`` looks into, or nothing.

    Suspicions are ``form``, ``box`` (comments, other articles), ``name`` (named
    as nothing but noise), ``part`` (a name with a word of noise) and ``slug``
    (an id that may be made from the text).
    """
    if tag in NOISE:
        return "tag"
    if tag == "header":
        return "header"
    found = {"form"} if tag in FORMS else set()
    if not attributes.strip() or tag in ("html", "body"):
        return "".join(found)
    for name, value, bare in ATTRIBUTE.findall(attributes):
        name, value = (name or bare).lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return "tag"
        if name == "style" and HIDDEN.search(value):
            return "tag"
        if name in ("class", "id", "role") and tag not in ARTICLE:
            found |= {_suspicion(tag, name, one) for one in value.split()}
    return next((kind for kind in ("box", "name", "form", "part", "slug") if kind in found), "")


def _suspicion(tag: str, attribute: str, name: str) -> str:
    words = set(re.split(r"[^a-z]+", name)) - {""}
    noise = words & NOISE_WORDS
    if not noise or attribute == "id" and tag in HEADINGS:
        return ""
    if words <= NOISE_WORDS | FORM_WORDS:
        if noise & BOX_WORDS:
            return "box"
        if attribute != "id" or tag not in SLUGGED:
            return "name"
    return "slug" if attribute == "id" and tag in SLUGGED else "part"


def main_text(page: str | None) -> str:
    """The article's text; empty if there is none, and for NULL.

    Character references are decoded, white space in a block becomes one space,
    and blocks are joined by one space in page order.
    """
    root = parse(page or "")
    _settle(root)
    body = next((n for n in _walk(root) if n.tag == "body"), root)
    if _marks(root, ARTICLE) > _marks(body, ARTICLE):
        body = root
    _measure(body)
    return " ".join(_text(root, _chosen(body), False).split())


def _chosen(body: Node) -> set[int]:
    """What is dense; an element the page marks as the article bounds it if it holds most of that."""
    dense = _dense(body)
    articles = _outermost(body, "article")
    whole = sum(map(_plain, dense))
    for marked in [*articles, *_outermost(body, "main")]:
        inside = {id(n) for n in _walk(marked)}
        if 2 * sum(_plain(n) for n in dense if id(n) in inside) > whole:
            dense = [marked]
            break
    if any(n.tag == "article" for n in dense) and len(dense) == 1:
        return {id(dense[0])}
    # Beside or within a text that is no marked article, articles are other texts.
    held = {id(n) for node in dense for n in _walk(node)}
    for article in articles:
        if id(article) in held and 2 * _plain(article) < sum(map(_plain, dense)):
            article.noise = "article"
    return {id(n) for n in dense}


def _plain(node: Node) -> int:
    return node.chars - node.link_chars


def _outermost(body: Node, tag: str) -> list[Node]:
    """The elements of this tag that are inside no other."""
    found, stack = [], [body]
    while stack:
        one = stack.pop()
        if one.tag == tag:
            found.append(one)
        else:
            stack += reversed(one.children())
    return found


def _settle(root: Node) -> None:
    """Takes back what a name, a form or a place wrongly calls noise.

    An element that holds all the page's main headings is its frame. So is one
    of several blocks with most of the page's text and all its articles, unless it is a
    box of comments or of other articles; and if nothing else has text, these
    are the text. Others are text
    if they are not mostly links and as dense as the page, where the name alone
    tells of noise in two paragraphs at least; half as dense where only a part of
    the name does. What an id made from the text may name needs no density.
    """
    suspects, nodes = [], list(_walk(root, noise=True))
    for node in nodes:
        if node.noise == "header":
            above = node.parent
            while above and above.tag not in ARTICLE:
                above = above.parent
            if above:
                node.noise = ""
        elif node.noise and node.noise != "tag":
            suspects.append((node, node.noise))
            node.noise = ""
    if not suspects:
        return
    # Suspects count as text here, but are not text beside which others are sparse.
    seen = list(_walk(root))
    _measure(root)
    headings = _held(nodes, [n.tag == "h1" for n in nodes])
    articles = _held(nodes, [n.tag in ARTICLE for n in nodes])
    whole, measured = root.chars, set(map(id, seen))
    body = next((n for n in seen if n.tag == "body"), root)
    density = _per_tag(body)
    paragraphs = _held(seen, [n.tag == "p" and _per_tag(n) >= density for n in seen])
    for node, kind in suspects:
        if id(node) not in measured or headings[id(root)] and headings[id(node)] == headings[id(root)]:
            continue
        most = 2 * node.chars > whole and articles[id(node)] == articles[id(root)]
        frame = most and any(n.tag not in INLINE for n in node.children())
        if not _is_text(node, kind, frame, density, paragraphs[id(node)]):
            node.noise = kind
    if whole and not any(p.strip() for n in _walk(root) for p in n.parts if isinstance(p, str)):
        for node, kind in suspects:
            if kind == "box":
                node.noise = ""


def _held(nodes: list[Node], counted: list[bool]) -> dict[int, int]:
    """How many of the counted nodes each holds, of a page's nodes in their order."""
    held = {id(node): int(one) for node, one in zip(nodes, counted, strict=True)}
    for node in reversed(nodes):
        if node.parent:
            held[id(node.parent)] += held[id(node)]
    return held


def _is_text(node: Node, kind: str, frame: bool, density: float, paragraphs: int) -> bool:
    if kind == "box" or 2 * node.link_chars > node.chars:
        return False
    if kind == "slug" or frame:
        return True
    if kind == "part":
        return 2 * _per_tag(node) >= density
    return _per_tag(node) >= density and paragraphs >= 2


def _per_tag(node: Node) -> float:
    """Characters outside of links per tag; unlike the composite density, equal for a text and its parts."""
    return _plain(node) / max(1, node.tags)


def _marks(node: Node, tags: set[str]) -> int:
    return sum(n.tag in tags for n in _walk(node, noise=True))


def _walk(node: Node, noise: bool = False) -> Iterator[Node]:
    """The node and all below it in page order."""
    stack = [node]
    while stack:
        one = stack.pop()
        yield one
        stack += [p for p in reversed(one.parts) if isinstance(p, Node) and (noise or not p.noise)]


def _measure(body: Node) -> None:
    """Counts, densities and their sums for the body and all nodes below it."""
    order = list(_walk(body))
    for node in reversed(order):
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        below = node.children()
        node.chars = own + sum(c.chars for c in below)
        node.tags = len(below) + sum(c.tags for c in below)
        link = node.tag == "a"
        node.link_chars = node.chars if link else sum(c.link_chars for c in below)
        node.link_tags = link + sum(c.link_tags for c in below)
    share = body.link_chars / max(1, body.chars)
    for node in reversed(order):
        node.density = _density(node, share)
        # Text formatting is no part of the page's structure. Articles side by
        # side are several texts, of which one counts.
        densities = [c.density for c in node.children() if c.tag not in INLINE and c.tag != "article"]
        articles = [c.density for c in node.children() if c.tag == "article"]
        node.total = sum(densities) + max(articles, default=0.0)


def _density(node: Node, link_share: float) -> float:
    """Characters per tag, the less the more of them are links."""
    if not node.chars:
        return 0.0
    tags = max(1, node.tags)
    plain = max(1, node.chars - node.link_chars)
    links, link_tags = max(1, node.link_chars), max(1, node.link_tags)
    base = math.log(node.chars / plain * node.link_chars + link_share * node.chars + math.e)
    value = max(1.0, node.chars / links * tags / link_tags)
    return node.chars / tags * math.log(value) / math.log(base) if base > 1 else node.chars / tags * math.log(value)


def _dense(body: Node) -> list[Node]:
    """The node with the largest sum, and what beside its path is as dense as the path."""
    order = list(_walk(body))
    best = max(order, key=lambda n: n.total)
    if not best.total:
        return [body]
    path, node = [best], best
    while node is not body:
        node = node.parent
        path.append(node)
    threshold = min(n.density for n in path)
    # Composite densities grow with a text's length; short blocks in one box with
    # the best are compared by characters per tag.
    alike = _per_tag(best)
    chosen = [best]
    for above, on_path in zip(path[1:], path, strict=False):
        taken = None
        # From the last to the first: a heading belongs to what it stands before.
        for child in reversed([c for c in above.children() if c.chars]):
            if child is on_path:
                taken = child
                continue
            heads = child.tag in HEADINGS and taken is not None
            dense = child.density >= threshold or above is not body and 2 * _per_tag(child) >= alike
            taken = child if (dense or heads) and child.link_chars * 2 <= child.chars else None
            if taken is not None:
                chosen.append(child)
    return chosen


def _text(root: Node, chosen: set[int], inside: bool) -> str:
    """Texts below the chosen nodes, a space where a block begins or ends."""
    out: list[str] = []
    stack: list[tuple[Node | str, bool]] = [(root, inside)]
    while stack:
        part, within = stack.pop()
        if isinstance(part, str):
            if within:
                out.append(entities.unescape(part) if "&" in part else part)
            continue
        if part.noise:
            out.append(" ")
            continue
        within = within or id(part) in chosen
        block = part.tag not in INLINE
        if block:
            out.append(" ")
            stack.append((" ", True))
        stack += [(p, within) for p in reversed(part.parts)]
    return "".join(out)


def extract(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    NULL or empty html, and html without text, give an empty text. A NULL id or
    url stays; repeated rows are rows like others; an empty table gives no
    rows. Other columns of the input are not looked at, whatever their names.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            columns = [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ]
            yield pa.record_batch(columns, ["page_id", "url", "text", "n_chars"])

    chosen = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.col(f"`{html_col}`").alias("html"),
    )
    return chosen.mapInArrow(read, "page_id long, url string, text string, n_chars long")
