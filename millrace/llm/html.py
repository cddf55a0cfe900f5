"""Main text of HTML pages by minimum-cut labelling.

A page is cut into text blocks. A linear classifier over a block's place and look gives it a cost for either label; the
costs are the capacities to the two terminals. Edges between neighbouring blocks, heavier the nearer they stand in
the DOM, make a change of label cost too. An element whose class or id names boilerplate is a node of its own with a
cost that is paid once for the content in it, so enough text outweighs a name. A maximum flow finds the cheapest
labelling; blocks on the content side of the minimum cut, in page order, are the text.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches

# Elements and names of the HTML standard, and words that sites use in class and id.
UNSEEN = frozenset("script style noscript template head title iframe object embed svg annotation annotation-xml canvas audio video select option datalist textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("table td th ul ol dl menu div section article main aside nav header footer form body html blockquote figure details".split())
ASIDE = frozenset("nav header footer aside menu dialog search fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form status".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay sidebar aside rail menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar share sharing social related recommended recommendations newsletter subscribe subscription signup login form search pagination pager tags widget widgets toolbar copyright legal disclaimer skip".split()
)
#: Words after these say how an element is laid out or filed, not what it is: with-sidebar, tag-legal, format-aside.
MODIFIERS = frozenset("with without has have no not tag category cat topic type format status layout theme".split())
REMARKS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
#: A name with one of these says something about remarks (comments-open, discussion-page), it does not hold them.
STATES = frozenset("open opened closed close enabled disabled allowed on off page pages post count number link links".split())
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo".split())
CONTENT = frozenset("article main".split())
#: A form around one of these is a page, not a form.
LANDMARKS = frozenset("article main nav header footer h1".split())

# The classifier's weights, in the unit of one edge between adjacent siblings.
BIAS, IN_ARTICLE, OUTSIDE, APART, PER_WORD, MOST_WORDS, LINKS, SENTENCE, HEADING, NAMED, ADVERT = -0.5, 3.0, -4.0, -16.0, 0.1, 2.0, -4.0, 0.5, 0.5, -10.0, -40.0


def name_words(names: str) -> set[str]:
    """The words of class and id names, each name up to its first modifier."""
    out: set[str] = set()
    for name in names.split():
        for word in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()):
            if word in MODIFIERS:
                break
            out.add(word)
    return out


def holds_remarks(names: str) -> bool:
    """Whether a class or id name says that the element holds remarks."""
    return any(words & REMARKS and not words & STATES for words in map(name_words, names.split()))


@dataclass
class Block:
    text: str
    element: int  # the innermost block element around it
    article: bool
    form: int  # the outermost form around it; 0 is none
    apart: bool
    heading: bool
    linked: int
    named: int  # the nearest element around it that is named as boilerplate; 0 is none


@dataclass
class _Open:
    tag: str
    number: int
    article: bool
    aside: bool  # set apart by element, role or remarks: also for articles inside
    named: int  # the nearest element that class or id name as boilerplate: an article inside starts anew
    unseen: bool
    link: bool
    heading: bool
    form: int
    block: int


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Open("", 0, False, False, 0, False, False, False, 0, 0)]
        self.blocks: list[Block] = []
        self.around: dict[int, int] = {}  # from each named element to the next one around it
        self.cost: dict[int, float] = {}  # of each named element
        self.parent: dict[int, tuple[int, int]] = {0: (0, 0)}  # the next block element around each, and its depth
        self.pages: set[int] = set()  # forms around a whole page
        self.open: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.linked, self.count = 0, 0

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.stack[-1]
            self.blocks.append(Block(text, top.block, top.article, top.form, top.aside, top.heading, min(self.linked, len(text)), top.named))
        self.pieces, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            self._imply("p")
        if tag in CLOSES and tag != "p":
            self._imply(*CLOSES[tag])
        if tag in VOID:
            if tag == "br":
                self.pieces.append(" ")
            return
        top, have = self.stack[-1], {k: v or "" for k, v in attrs}
        said = f"{have.get('class', '')} {have.get('id', '')}"
        words = name_words(said)
        hidden = "hidden" in have or have.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", have.get("style", "").lower()) is not None
        aside = (tag in ASIDE and not (tag == "header" and top.article)) or bool(set(have.get("role", "").lower().split()) & ASIDE_ROLES) or hidden
        content = tag in CONTENT or have.get("role", "").lower() in CONTENT
        aside = aside or (bool(words & {"comment", "reply"}) and not words & STATES if content else holds_remarks(said))
        if top.article:  # there a header holds the title, and a heading's id repeats its text
            words = set() if re.fullmatch(r"h[1-6]", tag) else words - {"header"}
        named = 0 if content else top.named
        self.count += 1
        if tag not in ("html", "body") and not content and words & ASIDE_WORDS:
            self.around[self.count], self.cost[self.count] = named, ADVERT if words & ADVERTS else NAMED
            named = self.count
        if top.form and tag in LANDMARKS:
            self.pages.add(top.form)
        form = top.form or (self.count if tag == "form" else 0)
        block = top.block
        if tag in BLOCKS:
            self.parent[self.count], block = (top.block, self.parent[top.block][1] + 1), self.count
        # A button that stands in running text belongs to it.
        unseen = top.unseen or tag in UNSEEN or (tag == "button" and not "".join(self.pieces).strip())
        self.open[tag] += 1
        self.stack.append(
            _Open(
                tag, self.count, top.article or content, top.aside or (aside and tag not in ("html", "body")),
                named, unseen, top.link or tag == "a", top.heading or re.fullmatch(r"h[1-6]", tag) is not None, form, block,
            )
        )

    def _close(self, i: int) -> None:
        """Close the open elements from place i on."""
        for o in self.stack[i:]:
            self.open[o.tag] -= 1
        del self.stack[i:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._close(i)
                return
            if tag not in BLOCKS and self.stack[i].tag in BLOCKS:
                return  # an inline end tag does not close blocks

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in UNSEEN and not self.stack[-1].unseen:  # there, as in <svg/>, the slash ends the element
            self.handle_starttag(tag, attrs)

    def _imply(self, *tags: str) -> None:
        """Close an open element that the next one ends."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self._close(i)
                return
            if self.stack[i].tag in SCOPES:
                return

    def handle_data(self, data: str) -> None:
        if not self.stack[-1].unseen:
            self.pieces.append(data)
            if self.stack[-1].link:
                self.linked += len(data.strip())


def _parsed(html: str) -> _Blocks:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser


def blocks(html: str) -> list[Block]:
    return _parsed(html).blocks


def score(b: Block, has_article: bool) -> float:
    """How much more the block looks like content than like boilerplate. Articles hold lists of links, too; on a page
    without an article, short lines have nothing else to speak for them."""
    out = (BIAS if has_article else -BIAS) + min(PER_WORD * len(b.text.split()), MOST_WORDS)
    out += LINKS * b.linked / len(b.text) / (2 if b.article else 1)
    out += SENTENCE * (b.text[-1] in ".!?") + HEADING * b.heading + APART * b.apart
    return out + (IN_ARTICLE if b.article else OUTSIDE if has_article else 0)


def _apart(a: int, b: int, parent: dict[int, tuple[int, int]]) -> int:
    """Steps between two block elements over the nearest one around both."""
    steps = 0
    while a != b:
        if parent[a][1] < parent[b][1]:
            a, b = b, a
        a = parent[a][0]
        steps += 1
    return steps


def edges(found: list[Block], parent: dict[int, tuple[int, int]]) -> list[tuple[int, int, float]]:
    """Adjacent blocks, and consecutive blocks of one parent, with weights that fall with the distance in the DOM."""
    out, last = {}, {}
    for i, b in enumerate(found):
        above = parent[b.element][0]
        for j in {i - 1, last.get(above, -1)} - {-1}:
            out[j, i] = 1.0 / (1 + max(0, _apart(found[j].element, b.element, parent) - 2))
        last[above] = i
    return [(i, j, w) for (i, j), w in out.items()]


def names(found: list[Block], around: dict[int, int], cost: dict[int, float]) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Scores of the nodes of named elements, which follow the blocks', and what implies them.

    Content in a named element implies its node, whose cost is paid once, and a node the next one around it.
    """
    place: dict[int, int] = {}
    implied = []
    for i, b in enumerate(found):
        at, element = i, b.named
        while element:
            seen = element in place
            node = place.setdefault(element, len(found) + len(place))
            implied.append((at, node, -cost[element]))
            if seen:
                break
            at, element = node, around[element]
    return [cost[element] for element in place], implied


def source_side(scores: list[float], links: list[tuple[int, int, float]], implied: list[tuple[int, int, float]] = []) -> list[bool]:
    """Which nodes the source reaches after a maximum flow: the content side of the minimum cut.

    Shortest augmenting paths by levels. A positive score is the capacity from the source, a negative one
    that to the sink. A link costs its weight if its ends differ, an implied pair only if the first alone is content.
    """
    left = list(scores)  # what is left of each terminal's capacity
    to: list[list[list]] = [[] for _ in scores]  # [neighbour, residual, index of the reverse]
    for i, j, w in links:
        to[i].append([j, w, len(to[j])])
        to[j].append([i, w, len(to[i]) - 1])
    for i, j, w in implied:
        to[i].append([j, w, len(to[j])])
        to[j].append([i, 0.0, len(to[i]) - 1])
    while True:
        level = [-1] * len(left)
        queue = deque(i for i, x in enumerate(left) if x > 1e-12)
        for i in queue:
            level[i] = 0
        while queue:
            i = queue.popleft()
            for j, r, _ in to[i]:
                if r > 1e-12 and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not any(level[i] >= 0 and x < -1e-12 for i, x in enumerate(left)):
            return [x >= 0 for x in level]
        tried = [0] * len(left)
        for start in [i for i, x in enumerate(left) if x > 1e-12]:
            path: list[tuple[int, int]] = []
            at = start
            while left[start] > 1e-12:
                if left[at] < -1e-12 and at != start:
                    push = min([left[start], -left[at], *(to[i][k][1] for i, k in path)])
                    for i, k in path:
                        j, _, back = to[i][k]
                        to[i][k][1] -= push
                        to[j][back][1] += push
                    left[start] -= push
                    left[at] += push
                    at, path = start, []
                    continue
                k = tried[at]
                while k < len(to[at]) and not (to[at][k][1] > 1e-12 and level[to[at][k][0]] == level[at] + 1):
                    k += 1
                tried[at] = k
                if k < len(to[at]):
                    path.append((at, k))
                    at = to[at][k][0]
                elif path:
                    at, k = path.pop()
                    tried[at] = k + 1
                else:
                    break


def main_text(html: str) -> str:
    parser = _parsed(html)
    found = parser.blocks
    has_article = any(b.article for b in found)
    for b in found:
        b.apart = b.apart or bool(b.form and b.form not in parser.pages)
    costs, implied = names(found, parser.around, parser.cost)
    side = source_side([*(score(b, has_article) for b in found), *costs], edges(found, parser.parent), implied)
    return "\n".join(b.text for b, content in zip(found, side) if content)


def extract_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every page.

    White space inside a block becomes one space, blocks are joined by a line feed, character references are decoded.
    A null or empty page, and one without content, has an empty text. Broken markup is read as far as it goes. Repeated
    rows give a row each; null ids and urls stay. An empty table gives no rows; further columns are ignored.
    """
    rows = pages.select(F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [main_text(h or "") for h in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_batches(rows, step, "page_id long, url string, text string, n_chars long")
