"""Main text of web pages by a minimum cut.

A page becomes a small graph. Its nodes are the text blocks and the elements
that hold them. A classifier gives each node a cost of being called content
and one of being called boilerplate, from the element's name, its class, id and
role, from the share of link text, length and punctuation of a block: these are
the capacities from the source and to the sink. Smoothness edges join an
element with what stands right in it (DOM proximity) and a block with the next
one in the page (adjacency, the weaker the more levels of the tree lie
between). The maximum flow gives the cheapest labelling; the blocks
on the source side, in page order, are the main text.

Pages carry no labels to learn from, so the costs are stated, in
:class:`Costs`, and are a parameter. Each page is settled by itself, in one
pass of Arrow batches without a shuffle, so cost grows with the bytes of HTML
and a host of any size is no hot key.

Defined cases: null and empty html, and pages without content, give ''. White
space inside a block (whatever Unicode calls so) becomes one space; character
references are decoded once. Unclosed and misnested tags are closed as browsers
close them, as far as blocks depend on it; what follows an unclosed script,
style, comment or tag is not text. Nothing is cut from long pages, and tags are
read in time linear in the page. Repeated rows and ties get equal
results (of equally cheap labellings the one with least content is taken). An
empty table gives an empty one; extra columns pass through, and one that bears
an output name is replaced.
"""

from __future__ import annotations

import html as _html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.llm import vec

# Element names of HTML and what they mean here.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head template noscript svg math canvas object audio video select datalist map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
NEVER = frozenset("nav aside form menu dialog button footer fieldset".split())
WRAPS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre figcaption caption summary address".split())
MAIN = frozenset("article main".split())
CLOSED_BY_BLOCK = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                            "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: Elements that end an open one of the same family, up to the holder named.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}), "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}),
           "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
#: Words in class, id and role that mark what is never the article ...
HARD_WORDS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsors sponsored nav navbar "
                       "navigation navi menu menus menubar submenu breadcrumb breadcrumbs sidebar sidebars sidenav aside cookie "
                       "cookies consent gdpr popup modal overlay subscribe subscription newsletter signup login signin comment comments "
                       "commentlist disqus respond reply replies pagination pager copyright masthead topbar footer colophon "
                       "notice notices alert complementary contentinfo dialog search toolbar skiplink".split())
#: ... and what is seldom part of it.
SOFT_WORDS = frozenset("header banner share sharing social related recommended recommendations recommendation trending popular promo promos "
                       "promoted promotion widget widgets teaser teasers outbrain taboola tags tagcloud legal disclaimer meta byline rail side more links "
                       "hidden print".split())
MAIN_WORDS = frozenset("article articlebody content entry story post main maincontent bodytext body text".split())
_NEGATED = frozenset("has with no without not non is".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_MARKS = re.compile(r"""(?:^|[\s/])(class|id|role|style|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SENTENCE = re.compile(r"[.!?…。！？](?=[\s\"'”’)\]]|$)")
_BOILER_TEXT = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b|all rights reserved|advertis(?:ement|ing)\b|sponsored\b|share (?:this|on)\b|"
                          r"(?:read|see|show) more\b|sign (?:in|up)\b|log ?in\b|subscribe\b|skip to\b|(?:this|our) (?:web)?site uses cookies|"
                          r"we use cookies|accept (?:all )?cookies|leave a (?:comment|reply)\b)|all rights reserved\.?\s*$", re.I)
ROOT, BLOCK = -1, ""


@dataclass(frozen=True)
class Costs:
    """What calling a node wrong costs, in whole numbers."""
    main_element: int = 30     # article, main and the like called boilerplate
    main_word: int = 6         # an element whose class or id says so
    soft: int = 12             # an element of SOFT_WORDS, or a page's header, called content
    prose: int = 3             # p, pre, blockquote called boilerplate
    heading: int = 2           # h1 ... h6
    per_word: float = 0.5      # each word outside links, up to most_words
    most_words: int = 40
    sentence: int = 2          # a block with an end of sentence
    links: int = 10            # a block of link text only, called content (half as much in prose)
    stub: int = 2              # up to three words without an end of sentence
    boiler_text: int = 10      # text that says what it is
    outside: int = 30          # any block outside the article or main element, if that holds a good part of the words
    held: int = 6              # content right in a boilerplate element
    held_soft: int = 20        # the same anywhere in an element of SOFT_WORDS
    holding: int = 1           # boilerplate right in a content element
    holding_main: int = 3      # the same anywhere in article or main
    wrapped: int = 60          # a block unlike the paragraph, heading, list item or cell it stands in
    near: int = 6              # neighbours in the page with unlike labels, over their distance in levels
    never: int = 10**9         # anything in an element that is never the article


DEFAULT = Costs()


@dataclass
class _Node:
    """An element, or a block of text (``name`` '')."""
    name: str
    parent: int
    depth: int
    hard: bool = False
    soft: bool = False
    main: int = 0
    text: list[str] = field(default_factory=list)
    link_chars: int = 0


def _meaning(name: str, attributes: str, node: _Node) -> None:
    """Read class, id, role and the like of an element into ``node``."""
    hard = name in NEVER
    soft = name == "header"
    main = 2 if name in MAIN else 0
    if attributes:
        for m in _MARKS.finditer(attributes):
            key, value = m[1].lower(), _html.unescape((m[2] or "").strip("\"'"))
            if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _UNSEEN_STYLE.search(value)):
                hard = True
            elif key == "itemprop" and value.lower() == "articlebody" or key == "role" and value.lower() in ("main", "article"):
                main = 2
            elif key in ("class", "id", "role") and name not in ("html", "body"):
                for item in value.split():
                    words = _WORD.findall(_CAMEL.sub("-", item).lower())
                    if not words or words[0] in _NEGATED:
                        continue
                    if not HARD_WORDS.isdisjoint(words):
                        hard = True
                    elif not SOFT_WORDS.isdisjoint(words):
                        soft = True
                    elif not MAIN_WORDS.isdisjoint(words):
                        main = max(main, 1)
    node.hard, node.soft, node.main = hard, soft and main < 2, main


def read_blocks(page: str) -> list[_Node]:
    """The nodes of a page in page order, node 0 its root."""
    nodes = [_Node("", ROOT, 0)]
    stack = [0]
    block: _Node | None = None
    in_link = False
    unseen = 0  # how deep in elements whose text is never shown
    at, last = 0, page.rfind(">") + 1

    def text(piece: str) -> None:
        nonlocal block
        if unseen or not piece:
            return
        if block is None:
            if piece.isspace():
                return
            top = stack[-1]
            block = _Node(BLOCK, top, nodes[top].depth + 1)
            nodes.append(block)
        block.text.append(piece)
        if in_link:
            block.link_chars += len(piece)

    def pop(to: int) -> None:
        nonlocal block, unseen, in_link
        while len(stack) > to:
            if nodes[stack.pop()].name in UNSEEN:
                unseen -= 1
        block, in_link = None, False

    def close(names, holders) -> None:
        for i in range(len(stack) - 1, 0, -1):
            name = nodes[stack[i]].name
            if name in names:
                pop(i)
            elif name in holders:
                break

    while at < len(page):
        m = _TAG.search(page, at, last) if at < last else None
        end = m.start() if m else len(page)
        if end > at:
            piece = page[at:end]
            if not m and (cut := re.search(r"<[/a-zA-Z!?]", piece)):  # a tag that the page ends in
                piece = piece[:cut.start()]
            text(_html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        ends, attributes = m[1] or m[4], m[3] or m[6] or ""
        if ends:
            if name == "a":
                in_link = False
            if name == "p" or name not in INLINE:
                for i in range(len(stack) - 1, 0, -1):
                    if nodes[stack[i]].name == name:
                        pop(i)
                        break
                else:
                    if name not in VOID and name not in ("html", "body"):
                        block = None
            elif any(nodes[i].name == name for i in stack[-3:]):  # an inline element that was taken for a holder
                pop(max(i for i in range(len(stack)) if nodes[stack[i]].name == name))
            continue
        if name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            if name == "textarea":
                block = None
            if stop is None:
                break
            gone = page.find(">", stop.end())
            at = gone + 1 if gone >= 0 else len(page)
            continue
        if name == "br":
            text("\n")
            continue
        if name in VOID:
            if name == "hr":
                block = None
            continue
        if name == "body" and nodes[stack[-1]].name == "head":
            pop(len(stack) - 1)
        made = None
        if name in INLINE:
            if name == "a":
                in_link = True
            if attributes:
                made = _Node(name, stack[-1], nodes[stack[-1]].depth + 1)
                _meaning(name, attributes, made)
                if not made.hard or name == "a":
                    made = None
            if made is None:
                continue
        if name in CLOSED_BY_BLOCK:
            close({"p"}, {"td", "th", "button", "table"})
        if name in IMPLIED:
            close(*IMPLIED[name])
        block = None
        if made is None:
            made = _Node(name, stack[-1], nodes[stack[-1]].depth + 1)
            _meaning(name, attributes, made)
            if name == "header" and any(nodes[i].main == 2 for i in stack):
                made.soft = False  # an article's own header holds its title
        nodes.append(made)
        stack.append(len(nodes) - 1)
        if name in UNSEEN:
            unseen += 1
    return nodes


class Flow:
    """Maximum flow by shortest augmenting paths in levels, on whole numbers."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []

    def edge(self, u: int, v: int, there: int, back: int = 0) -> None:
        self.out[u].append(len(self.to))
        self.out[v].append(len(self.to) + 1)
        self.to += (v, u)
        self.room += (there, back)

    def _levels(self, s: int) -> list[int]:
        level = [-1] * len(self.out)
        level[s] = 0
        queue = deque((s,))
        while queue:
            u = queue.popleft()
            for e in self.out[u]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[u] + 1
                    queue.append(self.to[e])
        return level

    def run(self, s: int, t: int) -> tuple[int, list[bool]]:
        """The flow, and which nodes are on the source's side of the smallest cut."""
        total = 0
        while (level := self._levels(s))[t] >= 0:
            nth = [0] * len(self.out)
            path: list[int] = []
            u = s
            while True:
                if u == t:
                    least = min(self.room[e] for e in path)
                    total += least
                    for k, e in enumerate(path):
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    k = next(k for k, e in enumerate(path) if not self.room[e])
                    u = self.to[path[k] ^ 1]
                    del path[k:]
                    continue
                for i in range(nth[u], len(self.out[u])):
                    e = self.out[u][i]
                    if self.room[e] and level[self.to[e]] == level[u] + 1:
                        nth[u] = i
                        path.append(e)
                        u = self.to[e]
                        break
                else:
                    if u == s:
                        break
                    level[u] = -1
                    u = self.to[path.pop() ^ 1]
        return total, [x >= 0 for x in level]


def _block_costs(node: _Node, words: list[str], holder: str, outside: bool, c: Costs) -> tuple[int, int]:
    """(cost of calling a block boilerplate, cost of calling it content)."""
    text = " ".join(words)
    share = min(1.0, node.link_chars / max(1, sum(map(len, node.text))))
    n = len(words)
    prose = holder in ("p", "pre", "blockquote")
    as_boiler = 1 + min(c.most_words, n * (1 - share)) * c.per_word
    as_content = share * share * c.links * (0.5 if prose else 1)
    if prose:
        as_boiler += c.prose
    elif len(holder) == 2 and holder[0] == "h" and holder[1].isdigit():
        as_boiler += c.heading
    if _SENTENCE.search(text):
        as_boiler += c.sentence
    elif n <= 3 and not prose:
        as_content += c.stub
    if n <= 40 and _BOILER_TEXT.search(text):
        as_content += c.boiler_text
    if outside:
        as_content += c.outside
    return round(as_boiler), round(as_content)


def _distance(nodes: list[_Node], a: _Node, b: _Node) -> int:
    """Levels up from two blocks to their common holder, together."""
    d, i, j = 0, a.parent, b.parent
    while i != j:
        if nodes[i].depth >= nodes[j].depth:
            i = nodes[i].parent
        else:
            j = nodes[j].parent
        d += 1
    return d


def graph(nodes: list[_Node], c: Costs = DEFAULT) -> tuple[Flow, int, int, dict[int, list[str]]]:
    """(graph, source, sink, words of each block): nodes have their own numbers."""
    blocks = {i: w for i, x in enumerate(nodes) if x.text and (w := "".join(x.text).split())}
    n = len(nodes)
    used, gone, soft, in_main = [False] * n, [False] * n, [False] * n, [False] * n
    for i, x in enumerate(nodes):  # holders stand before what they hold
        gone[i], soft[i], in_main[i] = x.hard, x.soft, x.main == 2
        if x.parent >= 0:
            gone[i] |= gone[x.parent]
            soft[i] |= soft[x.parent]
            in_main[i] |= in_main[x.parent]
    for i in blocks:
        while i >= 0 and not used[i]:
            used[i] = True
            i = nodes[i].parent
    seen = [(in_main[i], len(w)) for i, w in blocks.items() if not gone[i]]
    within = sum(k for m, k in seen if m)
    has_main = 4 * within >= sum(k for _, k in seen) > 0
    s, t = len(nodes), len(nodes) + 1
    flow = Flow(len(nodes) + 2)
    before = None
    for i, x in enumerate(nodes):
        if not used[i]:
            continue
        if i in blocks:
            holder = nodes[x.parent]
            to_boiler, to_content = _block_costs(x, blocks[i], holder.name, has_main and not in_main[i], c)
            if before is not None and not gone[i] and not gone[before]:
                w = c.near // (1 + _distance(nodes, nodes[before], x))
                if w:
                    flow.edge(before, i, w, w)
            before = i
        else:
            to_boiler = c.main_element if x.main == 2 else c.main_word if x.main else 0
            to_content = c.soft if x.soft else 0
        if gone[i]:
            to_content += c.never
        both = min(to_boiler, to_content)
        if to_boiler > both:
            flow.edge(s, i, to_boiler - both)
        if to_content > both:
            flow.edge(i, t, to_content - both)
        if x.parent > 0:
            if i in blocks and nodes[x.parent].name in WRAPS:
                flow.edge(i, x.parent, c.wrapped, c.wrapped)
            else:
                flow.edge(i, x.parent, c.held_soft if soft[x.parent] else c.held, c.holding_main if in_main[x.parent] else c.holding)
    return flow, s, t, blocks


def main_text(page: str | None, costs: Costs = DEFAULT) -> str:
    if not page:
        return ""
    flow, s, t, blocks = graph(read_blocks(page), costs)
    if not blocks:
        return ""
    _, content = flow.run(s, t)
    return " ".join(w for i, words in blocks.items() if content[i] for w in words)


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars",
            costs: Costs = DEFAULT) -> DataFrame:
    """All columns of ``df`` but the html, plus the main text and its length in code points."""
    kept = [f for f in df.schema.fields if f.name not in (html_col, text_col, chars_col)]
    cols = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField(text_col, T.StringType()), T.StructField(chars_col, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, html_col, 4 << 20):
            texts = [main_text(p, costs) for p in part.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in cols] + [pa.array(texts, type=pa.string()), pa.array(map(len, texts), type=pa.int64())],
                names=cols + [text_col, chars_col])

    return df.select(*cols, html_col).mapInArrow(vec.trimmed(run), schema)
