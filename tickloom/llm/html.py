"""HTML extraction by tree scoring.

A tolerant reader turns a page into a tree of elements and pieces of text.  Elements
that are never article text (scripts, styles, menus, controls) are left out.  So are forms,
articles within an article, and containers whose class, id or role says advert, sidebar,
comment and the like, unless ``MOST`` of the page's text outside links is in them: then the
name tells of the page's layout.  Readers' comments by their own name are left out in any case.  Where nothing else has text, names count for nothing.  Every paragraph gives
points to its ancestors: one, one for each comma and one for each hundred characters (at
most three of those), in full to its parent and halved with each step up.  A container's
points are discounted by its share of linked text.  The best container is kept, with those of its
siblings that score well against it or are text, of any length, and not mainly links.  Where a page marks
an article or a main part, scoring is done within these.

Text is read in page order: character references are decoded, white space within a block
becomes one space, blocks are trimmed and joined by one space.  Null or empty html, or a page
without text: the empty string.  Unclosed and stray tags, and comments without an end, are
read as browsers do; an element nested deeper than ``DEPTH`` is a sibling.  The time for a page grows
with its length.  Null and repeated page_ids are extracted row by row.  Extra columns stay.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickloom.llm.store import to_arrow

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag, and never read.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
DROPPED = RAW | frozenset("head nav header footer aside button select option input label dialog menu svg canvas object audio video map".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd dt".split()) | HEADINGS
#: What an opening tag ends if it is open in the same container.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_CLOSES_P = BLOCKS - {"br", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary"}
#: Containers whose class or id has one of these words are not article text.
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:isement|s)?|banner|breadcrumbs?|comments?|respond|replies|cookies?|consent|disclaimer|footer|gdpr|header|masthead|menu|nav(?:bar|igation)?|newsletter|notices?|alert|popup|modal|promo(?:tion)?|related|recommended|share|sharing|sidebar|social|sponsor(?:ed)?|subscribe|toolbar|widget|pagination|pager|skip)(?:$|[\s_-])",
    re.I,
)
_ROLES = re.compile(r"navigation|banner|contentinfo|complementary|search|form|dialog|alert|menu", re.I)
#: A quote opens a value only right after "="; elsewhere, or without an end, it is an ordinary character.
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?+)?+")
_UNNAMED = re.sub(r"\((?!\?)", "(?:", _ATTRIBUTE.pattern)
_TAG = re.compile(rf"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_UNNAMED})*+)>|([!?/][^>]*)>)")
_SPACE = re.compile(r"\s+")
#: Ancestors that get points of a paragraph.
HEIGHT = 6
SIBLING_SHARE = 0.2
DEPTH = 512
#: Tags without an end that are looked for, each to the end of the page, before the rest is text.
UNENDED = 16
MOST = 0.8
#: A class or id of this very name is a reader's comment, however long.
_COMMENTS = frozenset("comment comments commentlist comment-list comments-list comments-area comments-section comment-section user-comments replies respond".split())
KEPT, UNLIKELY, COMMENT, LEFT_OUT = range(4)


class Node:
    """An element; children are nodes and texts, in page order.

    ``mark`` is why it may be left out; ``text`` and ``linked`` count the characters of all text in it, and of that in links.
    """

    __slots__ = ("children", "depth", "dropped", "linked", "mark", "name", "parent", "score", "text")

    def __init__(self, name: str, parent: Node | None, mark: int = KEPT):
        self.name, self.parent, self.mark, self.children, self.score = name, parent, mark, [], 0.0
        self.depth = parent.depth + 1 if parent else 0
        self.dropped, self.text, self.linked = False, 0, 0


def _mark(name: str, attributes: str) -> int:
    if name in DROPPED:
        return LEFT_OUT
    mark = UNLIKELY if name == "form" else KEPT
    if not attributes:
        return mark
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), references.unescape(a or b or c)
        if name in ("body", "html", "article", "main"):
            if key in ("class", "id") and name == "article" and not _COMMENTS.isdisjoint(value.lower().split()):
                mark = COMMENT
            continue
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return LEFT_OUT
        if key in ("class", "id"):
            if not _COMMENTS.isdisjoint(value.lower().split()):
                mark = COMMENT
            elif _UNLIKELY.search(value):
                mark = max(mark, UNLIKELY)
        if key == "role" and _ROLES.fullmatch(value):
            mark = max(mark, UNLIKELY)
    return mark


def tree(page: str) -> Node:
    """The elements of a page."""
    root = here = Node("html", None)
    opened = Counter(("html",))
    at, look, end, unended = 0, 0, len(page), 0

    def leave(node: Node) -> Node:
        """The parent of an open element, which ends with all that is open in it."""
        nonlocal here
        while here is not node.parent:
            opened[here.name] -= 1
            here = here.parent
        return here

    while at < end:
        start = page.find("<", look) if unended < UNENDED else -1
        if start < 0:
            here.children.append(page[at:])
            break
        found = _TAG.match(page, start)
        if not found:
            look = start + 1
            unended += page[look : look + 1].isalpha() or page[look : look + 1] in ("/", "!", "?")
            continue
        if start > at:
            here.children.append(page[at:start])
        at = look = found.end()
        comment, closing, name, attributes, _ = found.groups()
        if comment:
            stop = page.find("-->", at)
            at = look = end if stop < 0 else stop + 3
            continue
        if not name:
            continue
        name = name.lower()
        if closing:
            node = here if opened[name] else None
            while node and node.name != name:
                # A stray end tag of a phrase does not end the block around it.
                node = None if node.name in BLOCKS and name not in BLOCKS else node.parent
            if node and node.parent:
                leave(node)
            continue
        if name in ("html", "body", "head") and name == here.name:
            continue
        if name in _CLOSES_P or name in _CLOSES:
            ends = _CLOSES.get(name, set()) | ({"p"} if name in _CLOSES_P else set())
            node = here if any(opened[e] for e in ends) else root
            while node.parent and (node.name not in BLOCKS or node.name in ends):
                above = node.parent
                if node.name in ends:
                    leave(node)
                    if node.name == "p" or name in ends:
                        break
                node = above
        mark = _mark(name, attributes)
        if name == "article" and opened["article"]:
            mark = max(mark, UNLIKELY)
        child = Node(name, here, mark)
        here.children.append(child)
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            close = page.find(">", stop.end()) if stop else -1
            at = look = close + 1 if close >= 0 else end
        elif name not in VOID and here.depth < DEPTH:
            here = child
            opened[name] += 1
    _measure(root)
    return root


def _order(top: Node) -> list[Node]:
    """All elements under ``top``, each before those in it."""
    found, stack = [], [top]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    return found


def _measure(root: Node, by_name: bool = True) -> None:
    """Lengths of the text in each element, and which elements are left out."""
    order = _order(root)

    def sums() -> None:
        for node in reversed(order):
            node.text = node.linked = 0
            if node.dropped:
                continue
            for c in node.children:
                if isinstance(c, str):
                    node.text += len(" ".join(references.unescape(c).split()))
                else:
                    node.text += c.text
                    node.linked += c.linked
            if node.name == "a":
                node.linked = node.text

    for node in order:
        node.dropped = node.mark >= (COMMENT if by_name else LEFT_OUT) or bool(node.parent and node.parent.dropped)
    sums()
    if not by_name:
        return
    most = MOST * (root.text - root.linked)
    for node in order:
        unlikely = node.mark == UNLIKELY and node.text - node.linked <= most
        node.dropped = node.dropped or unlikely or bool(node.parent and node.parent.dropped)
    sums()


def _nodes(top: Node) -> Iterator[Node]:
    """Elements under ``top`` in page order, without those left out."""
    stack = [top]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        yield node
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))


def blocks(tops: list[Node]) -> list[str]:
    """Texts of the blocks under some elements."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", references.unescape("".join(run))).strip()
        run.clear()
        if text:
            out.append(text)

    for top in tops:
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                close()
            elif isinstance(item, str):
                run.append(item)
            elif not item.dropped:
                if item.name in BLOCKS:
                    close()
                    stack.append(None)
                stack.extend(reversed(item.children))
        close()
    return out


def main_text(page: str | None) -> str:
    """The article's text."""
    if not page:
        return ""
    root = tree(page.replace("\0", "�"))
    text = _article(root)
    if not text:
        _measure(root, by_name=False)
        for node in _order(root):
            node.score = 0.0
        text = _article(root)
    return text


def _marked(root: Node) -> list[Node]:
    """The outermost elements that the page marks as an article or its main part."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        if node.name in ("article", "main"):
            found.append(node)
        else:
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found


def _article(root: Node) -> str:
    # Several articles of one page are scored like containers.
    tops = _marked(root) or [root]
    scored: list[Node] = []
    for top in tops:
        for node in _nodes(top):
            if node.name not in PARAGRAPHS and not (node.name == "div" and _has_own_text(node)):
                continue
            text = " ".join(blocks([_own(node)]))
            if not text:
                continue
            points = 1 + text.count(",") + min(len(text) / 100, 3)
            above, share = node if node is top else node.parent, 1.0
            for _ in range(HEIGHT):
                if above is None:
                    break
                if above.name not in PARAGRAPHS or above.name == "td":
                    if not above.score:
                        scored.append(above)
                    above.score += points * share
                    share /= 2
                if above is top:
                    break
                above = above.parent
    if not scored:
        return " ".join(blocks(tops))
    for node in scored:
        node.score *= 1 - node.linked / max(node.text, 1)
    best = max(scored, key=lambda n: n.score)
    # A container of the page's mark goes in whole: what is not article in it has been left out by name.
    for top in tops:
        if top is not root and _within_or_same(best, top):
            best = top
    kept = [best]
    if root in tops and best.parent is not None:
        kept = _with_siblings(best)
    elif best.parent is not None:
        kept = [c for c in best.parent.children if isinstance(c, Node) and not c.dropped and (c is best or _joins(c, best))]
    return " ".join(blocks(kept))


def _with_siblings(best: Node) -> list[Node]:
    """The best container and what joins it; text and phrases between two blocks are one sibling."""
    siblings: list[Node] = []
    phrase: Node | None = None
    for c in best.parent.children:
        if isinstance(c, Node) and (c is best or (c.name in BLOCKS and c.name != "br")):
            siblings.append(c)
            phrase = None
            continue
        if phrase is None:
            phrase = Node("p", None)
            siblings.append(phrase)
        phrase.children.append(c)
        if isinstance(c, str):
            phrase.text += len(" ".join(references.unescape(c).split()))
        else:
            phrase.text += c.text
            phrase.linked += c.linked
    return [c for c in siblings if not c.dropped and (c is best or _joins(c, best) or _is_text(c))]


def _is_text(node: Node) -> bool:
    """Whether an element has text that is not mainly links."""
    return node.text > 0 and node.linked < 0.25 * node.text


def _joins(node: Node, best: Node) -> bool:
    """Whether a sibling of the best container belongs to it."""
    if node.score and node.score >= max(3.0, SIBLING_SHARE * best.score):
        return True
    if node.name not in PARAGRAPHS:
        return False
    return _is_text(node) and (node.text > 80 or node.name in HEADINGS)


def _own(node: Node) -> Node:
    """A node without the paragraphs inside it, which score for themselves."""
    own = Node(node.name, None)
    own.children = [c for c in node.children if isinstance(c, str) or c.name not in BLOCKS or c.name == "br"]
    return own


def _has_own_text(node: Node) -> bool:
    return any(isinstance(c, str) and not c.isspace() for c in node.children)


def _within_or_same(node: Node | None, other: Node) -> bool:
    while node is not None:
        if node is other:
            return True
        node = node.parent
    return False


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points) instead of html."""
    kept = [f for f in pages.schema.fields if f.name not in ("html", "text", "n_chars")]
    schema = StructType([*kept, StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow(schema)
        for whole in batches:
            for lo in range(0, whole.num_rows, 200):
                batch = whole.slice(lo, 200)
                texts = [main_text(p.as_py()) for p in batch.column("html")]
                columns = [batch.column(f.name).cast(types.field(f.name).type) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=types)

    return pages.mapInArrow(run, schema)
