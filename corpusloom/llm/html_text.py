"""Main text of web pages by scoring the element tree.

Paragraphs pass points for length and commas to their ancestors, an ancestor's points are
discounted by its share of link text, and the best container and its like siblings are
kept.  Pages are independent, so the work is one narrow pass.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements of HTML by how they are read; fixed names of the standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
# Start tags that end an open paragraph.
ENDS_PARAGRAPH = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "dd", "dt", "li"}
# Elements that end when a like one starts, unless a container between them is open.
ENDS_LIKE = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
# Elements that are never part of the main text.
NEVER = frozenset(
    "nav footer header aside form button select option input textarea menu dialog head script style template "
    "noscript iframe object embed svg math canvas audio video map".split()
)
PARAGRAPH = frozenset("p pre blockquote li dd td h1 h2 h3 h4 h5 h6 figcaption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)

# A quote opens a value only after the sign of its attribute; elsewhere it is a character.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)>?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|$)")
# Names in class and id that mark what surrounds an article.
_AROUND = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|adsense|banner|promo\w*|sponsor\w*|nav|navbar|navigation|menu|breadcrumbs?|"
    r"sidebar|side-bar|widget\w*|footer|foot|masthead|header|comments?|disqus\w*|respond|reply|replies|"
    r"cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|signup|share|sharing|social|related|"
    r"recommend\w*|toolbar|pagination|pager|login|alert|disclaimer|hidden|tags?|byline-share)(?:$|[^a-z])"
)
_MAIN = re.compile(r"(?:^|[^a-z])(?:article|body|content|entry|main|post|text|story|blog|page)(?:$|[^a-z])")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "never", "weight", "points", "length", "linked", "commas")

    def __init__(self, tag: str, parent: "Node | None", never: bool = False, weight: float = 0.0):
        self.tag, self.parent, self.never, self.weight = tag, parent, never, weight
        self.children: list = []
        self.points = 0.0
        self.length = self.linked = self.commas = 0


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), a or b or c)
    return found


def _judge(tag: str, rest: str) -> tuple[bool, float]:
    """Whether an element is never main text, and points for its names."""
    never = tag in NEVER
    if not rest or tag in ("html", "body"):
        return never, 0.0
    found = _attributes(rest)
    names = re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{found.get('class', '')} {found.get('id', '')}").lower()
    around, main = bool(_AROUND.search(names)), bool(_MAIN.search(names))
    role = found.get("role", "").lower()
    hidden = (
        _BARE_HIDDEN.search(_ATTRIBUTE.sub(" ", rest)) is not None or "hidden" in found
        or found.get("aria-hidden", "").lower() == "true" or _HIDDEN_STYLE.search(found.get("style", "").lower())
    )
    never = never or bool(hidden) or role in NEVER_ROLES or (around and tag not in ("article", "main"))
    # A header of the article itself, named as such, would be read; its heading is enough.
    return never, (25.0 if main and not around else 0.0) - (25.0 if around else 0.0)


def parse(page: str) -> Node:
    """The element tree of a page; text is decoded, end tags that fit nothing are ignored."""
    root = Node("#root", None)
    at, node, size = 0, root, len(page)
    # How many elements of each name are open: an end tag of none is not looked for.
    opened: dict[str, int] = {}

    def leave(inner: Node, outer: Node) -> Node:
        while inner is not outer:
            opened[inner.tag] -= 1
            inner = inner.parent
        return outer

    while at < size:
        start = page.find("<", at)
        if start < 0:
            node.children.append(html.unescape(page[at:]))
            break
        match = _TOKEN.match(page, start)
        if match is None:  # a bare "<" is text
            end = page.find("<", start + 1)
            end = size if end < 0 else end
            node.children.append(html.unescape(page[at:end]))
            at = end
            continue
        if start > at:
            node.children.append(html.unescape(page[at:start]))
        at = match.end()
        name = match.group(2)
        if name is None:
            continue
        tag = name.lower()
        if match.group(1):
            if opened.get(tag):
                node = leave(node, _close(node, tag))
            continue
        node = leave(node, _imply(node, tag))
        never, weight = _judge(tag, match.group(3))
        child = Node(tag, node, never or node.never, weight)
        node.children.append(child)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            child.never = True
            if end is None:
                at = size
            else:
                close = page.find(">", end.end())
                at = size if close < 0 else close + 1
            continue
        node = child
        opened[tag] = opened.get(tag, 0) + 1
    return root


def _imply(node: Node, tag: str) -> Node:
    """The element that a start tag goes into, after the ends it implies."""
    if tag in ENDS_PARAGRAPH:
        above = node
        while above is not None and above.tag not in ("#root", "td", "th", "button", "object", "caption"):
            if above.tag == "p":
                return above.parent
            if above.tag in BLOCK:
                break
            above = above.parent
    if tag in ENDS_LIKE:
        like, stop = ENDS_LIKE[tag]
        above, last = node, None
        while above is not None and above.tag not in stop and above.tag != "#root":
            if above.tag in like:
                last = above
            above = above.parent
        if last is not None:
            return last.parent
    return node


def _close(node: Node, tag: str) -> Node:
    """The open element after an end tag."""
    above = node
    while above.parent is not None:
        if above.tag == tag:
            return above.parent
        # An inline end tag does not reach over blocks.
        if tag not in BLOCK and above.tag in BLOCK:
            return node
        above = above.parent
    return node


def _measure(root: Node) -> None:
    """Text length, link text length and commas of every element, and paragraph points."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node) and not c.never)
    for node in reversed(order):
        own = linked = commas = 0
        for child in node.children:
            if isinstance(child, str):
                text = _SPACE.sub(" ", child).strip()
                own += len(text)
                commas += sum(text.count(c) for c in ",،、，")
            elif not child.never:
                own += child.length
                linked += child.linked
                commas += child.commas
        node.length, node.commas = own, commas
        node.linked = own if node.tag == "a" else linked
    for node in order:
        if node.tag not in PARAGRAPH:
            # Text that stands in a container by itself counts as a paragraph.
            loose = [c for c in node.children if isinstance(c, str) and not c.isspace()]
            length, commas, linked = sum(len(c.strip()) for c in loose), sum(c.count(",") for c in loose), 0
            if node.tag not in BLOCK or not length:
                continue
        else:
            length, commas, linked = node.length, node.commas, node.linked
        points = 1.0 + commas + min(length // 100, 3) if length >= 25 else length / 100.0
        points *= 1.0 - (linked / length if length else 0.0)
        above, level = (node.parent if node.tag in PARAGRAPH else node), 0
        while above is not None and level < 5:
            above.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above, level = above.parent, level + 1


def _link_density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _final(node: Node) -> float:
    tag = 15.0 if node.tag in ("article", "main") else 5.0 if node.tag in ("div", "section") else 0.0
    return (node.points + tag * (node.points > 0) + (node.weight if node.points > 0 else 0.0)) * (1.0 - _link_density(node))


def _containers(root: Node) -> list[Node]:
    """Elements that may hold the article, in page order."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in BLOCK and node.tag not in PARAGRAPH or node.tag == "#root":
            found.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.never)
    return found


def choose(root: Node) -> list[Node]:
    """The best container and those of its siblings that belong to it, in page order."""
    best, top = None, 0.0
    for node in _containers(root):
        score = _final(node)
        if score > top:
            best, top = node, score
    if best is None or best.parent is None:
        return [best or root]
    # An article element holds the whole article even if a part of it scores best.
    above = best
    while above is not None:
        if above.tag in ("article", "main") and above.points > 0:
            best = above
            break
        above = above.parent
    if best.tag == "main" or best.parent is None:
        return [best]
    least = max(10.0, 0.2 * top)
    kept = []
    for child in best.parent.children:
        if child is best:
            kept.append(child)
        elif isinstance(child, Node) and not child.never:
            density = _link_density(child)
            full = child.tag in BLOCK and _final(child) >= least and density < 0.25
            prose = child.tag == "p" and (child.length > 80 and density < 0.25 or 0 < child.length and not child.linked)
            heading = child.tag in HEADING and not child.linked
            if full or prose or heading:
                kept.append(child)
    return kept


def _lists_of_links(node: Node) -> bool:
    """A list or table of links within the article: not its text."""
    return node.tag in ("ul", "ol", "dl", "table") and node.length > 0 and _link_density(node) > 0.6


def block_texts(chosen: list[Node]) -> list[str]:
    """Texts of the blocks in page order, white space collapsed, empty ones left out."""
    blocks, parts = [], []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(parts)).strip()
        if text:
            blocks.append(text)
        parts.clear()

    for top in chosen:
        # Depth first without recursion: pages may nest without bound.
        stack: list = [("open", top)]
        while stack:
            step, node = stack.pop()
            if step == "close":
                flush()
            elif isinstance(node, str):
                parts.append(node)
            elif node.never and node is not top or _lists_of_links(node):
                if node.tag in BLOCK:
                    flush()
            elif node.tag == "br":
                parts.append(" ")
            else:
                if node.tag in BLOCK:
                    flush()
                    stack.append(("close", node))
                stack.extend(("open", c) for c in reversed(node.children))
        flush()
    return blocks


def main_text(page: str | None) -> str:
    """The article of a page, one block per line; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    _measure(root)
    return "\n".join(block_texts(choose(root)))


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """`pages` with `text` and `n_chars`, columns of these names being replaced.

    Null and empty pages, and pages without text, give an empty text.  Character
    references are decoded, white space inside a block is one space.  Repeated rows and
    null keys are extracted like all others; a long page is read whole.
    """
    kept = [c for c in pages.columns if c not in ("text", "n_chars")]
    place = kept.index(source)
    frame = pages.select(*kept)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(place)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*kept, "text", "n_chars"],
            )

    return frame.mapInArrow(read, f"{head}, text string, n_chars long")


def page_texts(pages: DataFrame) -> DataFrame:
    """Per page: `page_id, url, text, n_chars`."""
    return extract(pages.select("page_id", "url", "html")).select(
        F.col("page_id"), "url", "text", F.col("n_chars")
    )
