"""Main text of HTML pages by minimum-cut labelling.

A page is read into text blocks; consecutive blocks of one container and kind form a node. A
linear classifier (place in the document tree, names of classes and ids, links, length) gives
each node a cost of being dropped (its capacity from the source) or of being kept (its
capacity to the sink). Neighbouring nodes, and nodes that follow one another in the same
container, are tied by smoothness edges. The minimum cut, found by maximum flow, separates
content from boilerplate.

Classes, ids and roles named like boilerplate, and forms, mark what they hold. A mark is a finite
cost of its blocks, paid once, and is lifted where it stands on a wrapper: on an element with more
than half of the page's text, or with articles that have at least as much text as is unmarked. Marks
of readers' comments are not lifted unless the page has no other text.

Defined cases: NULL and empty pages have an empty text. Unclosed and unmatched tags are
closed as browsers would or ignored. Scripts, styles, comments and markup never give text;
line breaks count as white space. Repeated pages are pages of their own, a NULL id or URL
stays NULL. A very long page is read whole by one task, in time linear in its length. Columns other than id, URL and HTML are not read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a "<" can open: a comment, a declaration or instruction, an end tag or a start tag.
TOKEN = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
# One attribute of a tag. Quotes delimit a value only right after its "=".
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*([^\s>]?))?")
UNQUOTED = re.compile(r"[^\s>]*")
TAG_END = re.compile(r"[\s/]*>")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in ("script", "style")}
NAMING = frozenset("class id role".split())
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
Attributes = list[tuple[str, str]]
NAME_PART = re.compile(r"[a-z]+")

# Elements that start a block; all others are inline and do not end one.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe "
    "legend li main menu nav noscript ol option p pre section select summary svg table tbody td "
    "template textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text is no part of an article.
NEVER = frozenset(
    "aside button dialog footer head header iframe menu nav noscript option select svg "
    "template textarea title".split()
)
ARTICLE = frozenset("article main".split())
# Names that tell what a page has or is about, not what the element is.
ABOUT = re.compile(r"(?:has|with|without|no|not|tag|category|cat)[-_]")
# What an open element of this kind is closed by, besides its own end tag.
CLOSED_BY = {
    "p": BLOCKS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "head": frozenset(["body"]),
}
LEAVES = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 pre blockquote td th tr figcaption".split())
# Words in classes, ids and roles that tell boilerplate and content.
BOILERPLATE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs "
    "complementary comment comments consent contentinfo cookie cookies copyright dialog discussion "
    "disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification overlay pagination pager paywall popup promo promoted promotion "
    "related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription tags toolbar widget".split()
)
# Those that tell readers' comments, which can be longer than the article.
COMMENT_NAMES = frozenset("comment comments discussion disqus replies reply respond".split())
CONTENT_NAMES = frozenset("article articlebody body content entry main post story text".split())

SURE = 30.0  # capacity of what is boilerplate by its place
NAMED = 9.0  # cost of a mark, above all that speaks for a block
TIE = 1.0  # edge between nodes in sequence within one container
NEAR = 0.4  # edge between neighbours


@dataclass
class Element:
    name: str
    never: bool = False
    article: bool = False
    content: bool = False
    number: int = 0
    marked: bool = False
    comments: bool = False
    articles: int = 0  # open elements of ARTICLE, this one not counted
    first: int = 0  # its blocks: from here
    last: int = 0  # to before here


@dataclass
class Block:
    text: str
    container: int
    leaf: str
    never: bool
    article: bool
    content: bool
    link_share: float
    articles: int
    marks: int = 0


@dataclass
class Reader:
    """Collects the blocks of one page."""

    stack: list[Element] = field(default_factory=lambda: [Element("")])
    blocks: list[Block] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    links: int = 0
    elements: int = 0
    marked: list[Element] = field(default_factory=list)

    def text(self, raw: str) -> None:
        if raw:
            piece = unescape(raw) if "&" in raw else raw
            self.pieces.append(piece)
            if self.links:
                self.linked += len(piece)

    def end_block(self) -> None:
        if not self.pieces:
            return
        whole = "".join(self.pieces)
        text = " ".join(whole.split())
        if text:
            top = self.stack[-1]
            leaf = top.name if top.name in LEAVES else ""
            holder = next((e for e in reversed(self.stack) if e.name not in LEAVES), top)
            self.blocks.append(
                Block(text, holder.number, leaf, top.never, top.article, top.content, self.linked / len(whole), top.articles + (top.name in ARTICLE))
            )
        self.pieces, self.linked = [], 0

    def start(self, name: str, attributes: Attributes) -> None:
        if name == "br":
            self.pieces.append("\n")
            return
        if name == "a":
            self.links = 1
        if name not in BLOCKS:
            return
        self.end_block()
        while len(self.stack) > 1 and name in CLOSED_BY.get(self.stack[-1].name, ()):
            self.close(len(self.stack) - 1)
        if name in VOID:
            return
        self.links = 0
        self.elements += 1
        above = self.stack[-1]
        boilerplate, content = name in NEVER, name in ARTICLE
        marked = name == "form"
        if name == "header" and above.article:
            boilerplate = False  # the heading of the article itself
        comments = named_content = False
        for key, value in attributes:
            if key in NAMING:
                words = value.lower().split()
                names = {part for w in words if not ABOUT.match(w) for part in NAME_PART.findall(w)}
                marked = marked or not names.isdisjoint(BOILERPLATE_NAMES)
                comments = comments or not names.isdisjoint(COMMENT_NAMES)
                named_content = named_content or not names.isdisjoint(CONTENT_NAMES)
            elif (
                key == "hidden"
                or (key == "aria-hidden" and value.strip().lower() == "true")
                or (key == "style" and NOT_SHOWN.search(value))
            ):
                boilerplate = True
        content = content or named_content
        if name in ("body", "html"):
            boilerplate = content = marked = False
        element = Element(
            name,
            above.never or boilerplate,
            above.article or (name in ARTICLE and not boilerplate),
            above.content or (content and not boilerplate),
            self.elements,
            marked,
            comments and not named_content,
            above.articles + (above.name in ARTICLE),
            len(self.blocks),
        )
        self.stack.append(element)
        if marked:
            self.marked.append(element)

    def close(self, place: int) -> None:
        """Closes the elements of the stack from ``place`` on."""
        for element in self.stack[place:]:
            element.last = len(self.blocks)
        del self.stack[place:]

    def end(self, name: str) -> None:
        if name == "a":
            self.links = 0
        if name not in BLOCKS:
            return
        self.end_block()
        for place in range(len(self.stack) - 1, 0, -1):
            if self.stack[place].name == name:
                self.close(place)
                return

    def lift_marks(self) -> None:
        """Counts the marks of each block, without those that stand on wrappers.

        Text is what is neither in links nor in elements without text of an article. From the
        outside in, so that what is inside a lifted mark counts as unmarked.
        """
        own = [0.0 if b.never else len(b.text) * (1 - b.link_share) for b in self.blocks]
        for element in self.marked:
            for block in self.blocks[element.first : element.last]:
                block.marks += 1
        whole = sum(own)
        unmarked = sum(n for n, b in zip(own, self.blocks, strict=True) if not b.marks)
        alone = unmarked == 0
        for element in self.marked:
            if element.comments and not alone:
                continue
            places = range(element.first, element.last)
            held = sum(own[i] for i in places)
            articles = sum(own[i] for i in places if self.blocks[i].articles > element.articles)
            if 2 * held > whole or (articles > 0 and articles >= unmarked):
                for i in places:
                    self.blocks[i].marks -= 1
                    if not self.blocks[i].marks:
                        unmarked += own[i]


def end_of_tag(page: str, place: int, last: dict[str, int]) -> tuple[int, Attributes] | None:
    """Where the tag ends whose name ends at ``place``, and its attributes; None if it never does.

    ``last`` has the last place of each kind of quote: one that nothing closes is part of a value.
    """
    attributes: Attributes = []
    while True:
        if end := TAG_END.match(page, place):
            return end.end(), attributes
        found = ATTRIBUTE.match(page, place)
        if not found:
            return None
        place, value = found.end(), found[2]
        if value in ("'", '"') and place <= last[value]:
            close = page.index(value, place)
            value, place = page[place:close], close + 1
        elif value:
            place = UNQUOTED.match(page, place).end()
            value = page[found.start(2) : place]
        attributes.append((found[1].lower(), value or ""))


def after(page: str, what: str, place: int) -> int:
    found = page.find(what, place)
    return len(page) if found < 0 else found + len(what)


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page, in time linear in its length.

    Should the page end inside of a tag, then that tag and later ones end at the next ">", wherever
    it is, and a last one without any is text.
    """
    reader = Reader()
    last = {quote: page.rfind(quote) for quote in ("'", '"')}
    whole = True
    done = 0
    while token := TOKEN.search(page, done):
        reader.text(page[done : token.start()])
        done = token.end()
        if not token[2]:
            done = after(page, "-->" if token[0] == "<!--" else ">", done)
            continue
        tag = end_of_tag(page, done, last) if whole else None
        if tag is None:
            whole = False
            tag = after(page, ">", done), []
            if page[tag[0] - 1] != ">":
                done = token.start()
                break
        done, name = tag[0], token[2].lower()
        if token[1]:
            reader.end(name)
        elif name in RAW_END:
            close = RAW_END[name].search(page, done)
            done = after(page, ">", close.end()) if close else len(page)
        else:
            reader.start(name, tag[1])
    reader.text(page[done:])
    reader.end_block()
    reader.close(0)
    reader.lift_marks()
    return reader.blocks


def content_score(block: Block, has_article: bool) -> float:
    """Above 0 for content, below for boilerplate."""
    if block.never:
        return -SURE
    # An article may list links; a menu in it is told by its element or its name.
    linked = 1 if block.article and not block.marks else 4
    score = -0.5 - linked * block.link_share + min(len(block.text) / 80, 2.5)
    if block.leaf == "p":
        score += 1
    elif block.leaf.startswith("h"):
        score += 0.75
    if block.article:
        score += 4
    elif block.content:
        score += 3
    elif has_article:
        score -= 4
    else:
        score += 1
    return score - NAMED if block.marks else score


def source_side(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes a minimum cut leaves with the source, by Dinic's maximum flow."""
    n = len(scores)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    left: list[float] = []

    def add(a: int, b: int, forth: float, back: float) -> None:
        heads[a].append(len(to))
        heads[b].append(len(to) + 1)
        to.extend((b, a))
        left.extend((forth, back))

    for node, score in enumerate(scores):
        if score > 0:
            add(source, node, score, 0.0)
        else:
            add(node, sink, -score, 0.0)
    for a, b, weight in edges:
        add(a, b, weight, weight)

    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for e in heads[node]:
                if left[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[node] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[node] >= 0 for node in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(left[e] for e in path)
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow
                path, node = [], source
                continue
            while following[node] < len(heads[node]):
                e = heads[node][following[node]]
                if left[e] > 1e-9 and level[to[e]] == level[node] + 1:
                    break
                following[node] += 1
            else:
                if not path:
                    break
                e = path.pop()
                node = to[e ^ 1]
                following[node] += 1
                continue
            path.append(e)
            node = to[e]


def main_blocks(page: str | None) -> list[str]:
    """The texts of the content blocks, in page order."""
    blocks = blocks_of(page) if page else []
    has_article = any(b.article and not b.never and not b.marks for b in blocks)
    nodes: list[list[int]] = []
    scores: list[float] = []
    containers: list[int] = []
    for place, block in enumerate(blocks):
        score = content_score(block, has_article)
        if nodes and containers[-1] == block.container and (scores[-1] > 0) == (score > 0):
            nodes[-1].append(place)
            scores[-1] += score
        else:
            nodes.append([place])
            scores.append(score)
            containers.append(block.container)
    edges = [(i, i + 1, NEAR) for i in range(len(nodes) - 1)]
    latest: dict[int, int] = {}
    for node, container in enumerate(containers):
        if container in latest:
            edges.append((latest[container], node, TIE))
        latest[container] = node
    kept = source_side(scores, edges) if any(s > 0 for s in scores) else [False] * len(nodes)
    return [blocks[place].text for node, keep in zip(nodes, kept, strict=True) if keep for place in node]


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``id``, ``url`` and ``text`` of every page: its content blocks joined by line feeds."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n".join(main_blocks(page.as_py())) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["id", "url", "text"],
            )

    rows = pages.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(url_column).cast("string").alias("url"),
        F.col(html_column).alias("html"),
    )
    return rows.mapInArrow(each, "id long, url string, text string")
