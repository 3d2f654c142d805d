"""Main text of web pages by minimum-cut labelling of their text blocks.

A tolerant scan of the html gives the text blocks with what their ancestors say about
them. A linear classifier turns that into a cost of calling a block content or
boilerplate: the terminal capacities. Blocks that follow each other, and blocks of the
same parent, are tied by capacities that shrink with their distance in the tree. A
maximum flow then separates content from boilerplate. Pages are independent, so the
operator is one pass without a shuffle.
"""

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by what they mean for text, and the words of class, id and role.
RAW = {"script", "style", "noscript", "title", "textarea", "iframe"}
SKIPPED = {"svg", "select", "datalist", "object", "template"}
BREAKS_OUT = re.compile(r"<(?:p|div|h[1-6]|ul|ol|dl|table|article|section|main|blockquote|pre)[\s/>]", re.I)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "output", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp",
    "math", "mi", "mn", "mo", "mrow", "msub", "msup", "msubsup", "mfrac", "msqrt", "mroot", "mtext", "mspace", "mstyle", "munder", "mover", "munderover", "semantics",
}
CLOSED_BY_BLOCK = {"p"}
ITEMS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "legend"}
CONTENT_TAGS = {"article", "main"}
BOILERPLATE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|sidebars?|side-?bar|"
    r"menus?|nav|navbar|navigation|topnav|breadcrumbs?|toolbar|footers?|headers?|masthead|comments?|commentlist|replies|reply|respond|disqus|"
    r"discussion|share|sharing|social|related|recommend(?:ed|ations)?|newsletter|subscribe|subscription|signup|login|notices?|notification|alerts?|"
    r"popup|modal|overlay|pager|pagination|widgets?|copyright|legal|disclaimer|skip|search|searchbox|contentinfo|complementary|form|tags|toc)(?:$|[\s_-])"
)
MODIFIERS = set(
    "left right top bottom center centre upper lower first last main primary secondary global local site page web blog post article content entry story "
    "block blocks box boxes area areas section sections container wrapper wrap list lists item items inner outer bar bars panel group row col column "
    "link links button btn title text body head icon icons image img small large big mobile desktop sticky fixed floating inline slot unit region zone "
    "module component holder header footer the and of in to by for form user new js ui".split()
)
CONTENT_WORDS = re.compile(r"(?:^|[\s_-])(?:content|article|articlebody|post|entry|main|story|body|text|prose)(?:$|[\s_-])")
BOILERPLATE_TEXT = re.compile(r"\bcookies?\b|\bsubscribe\b|\bsign up\b|\bnewsletter\b|\badvertisement\b|\ball rights reserved\b|©|\bprivacy policy\b|\blog in\b", re.I)
# End of fixed values.

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

# Costs are in hundredths, so that capacities are whole numbers. One is about an odds factor of e.
IN_BOILERPLATE, IN_CONTENT, CONTENT_CLASS, OUTSIDE, HEADER_INSIDE = -800, 400, 200, -250, -200
SHORT, PER_CHARACTER, LONG, PER_LINK, HEADING, SENTENCE, CUE = -100, 2, 300, -400, 150, 50, -250
ADJACENT, SIBLINGS = 150, 100
# A class name that has a word of boilerplate among words that are no page furniture.
HALF_MARKED = -100


class _Element:
    __slots__ = ("tag", "depth", "parent", "bad", "good", "inside")

    def __init__(self, tag, parent, rest):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.bad, self.good = (parent.bad, parent.good) if parent else (0, 0)
        self.inside = bool(parent and parent.inside) or tag in CONTENT_TAGS
        if tag in BOILERPLATE_TAGS:
            self.bad = IN_BOILERPLATE
        elif tag == "header":
            self.bad = min(self.bad, HEADER_INSIDE if self.inside else IN_BOILERPLATE)
        elif tag in CONTENT_TAGS:
            self.good = IN_CONTENT
        if rest and tag not in ("html", "body"):
            said = " ".join(b or c or d for _, b, c, d in ATTRIBUTE.findall(rest)).lower()
            if said and BOILERPLATE_WORDS.search(said) and tag not in CONTENT_TAGS | {"h1"} or said and re.search(r"(?:^|[\s_-])comments?(?:$|[\s_-])", said):
                self.bad = min(self.bad, _mark(said))
            if self.bad > IN_BOILERPLATE and said and CONTENT_WORDS.search(said):
                self.good = max(self.good, CONTENT_CLASS)
            if HIDDEN.search(rest):
                self.bad = IN_BOILERPLATE


def _mark(said):
    """How much a class, id or role that has a word of boilerplate speaks against an element.

    All of it if some name consists of such words and of page furniture, and no other name says content; else a part.
    """
    names = said.split()
    whole = [n for n in names if BOILERPLATE_WORDS.search(n) and all(BOILERPLATE_WORDS.search(w) or w in MODIFIERS or w.isdigit() for w in re.split("[_-]+", n) if w)]
    content = any(CONTENT_WORDS.search(n) and not BOILERPLATE_WORDS.search(n) for n in names)
    telling = [n for n in whole if not content or n in ("comments", "comment", "sidebar", "footer", "header", "nav", "menu")]
    return IN_BOILERPLATE if telling else HALF_MARKED


class _Block:
    __slots__ = ("text", "element", "linked", "heading")

    def __init__(self, text, element, linked, heading):
        self.text, self.element, self.linked, self.heading = text, element, linked, heading


def _closed(page, name):
    """{end of an opening tag: (start, end) of the closing tag that belongs to it} of all elements of a name."""
    found, open_ = {}, []
    for tag in re.finditer(f"<(/?){re.escape(name)}(?=[\\s/>])[^>]*>", page, re.I):
        if not tag[1]:
            open_.append(tag.end())
        elif open_:
            found[open_.pop()] = tag.span()
    return found


def blocks_of(page):
    """The text blocks of an html text in order, outside of scripts, styles and the like."""
    root = _Element("", None, "")
    # Elements but inline ones; of those only an open link matters, and the height of the stack it was opened at.
    stack, blocks, parts, linked, link, closed = [root], [], [], 0, None, {}

    def flush():
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            heading = any(e.tag in ("h1", "h2", "h3") for e in stack[-4:])
            blocks.append(_Block(text, stack[-1], min(1.0, linked / len(text)), heading))
        parts.clear()
        linked = 0

    def add(text):
        nonlocal linked
        if text:
            parts.append(text)
            if link is not None:
                linked += len(text)

    def pop_to(i):
        nonlocal link
        flush()
        del stack[i:]
        if link is not None and link > len(stack):
            link = None

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at:found.start()])
        at = found.end()
        name = found["name"]
        if not name:
            continue
        name = name.lower()
        if found["end"]:
            if name == "br":
                parts.append(" ")
            elif name == "a":
                link = None
            elif name not in INLINE and name not in SKIPPED:
                i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), 0)
                if i:
                    pop_to(i)
                else:
                    flush()
            continue
        if name in RAW or name in SKIPPED:
            if name not in ("title", "svg") and name not in INLINE:
                flush()
            if found["rest"].endswith("/") and name in SKIPPED:
                continue
            if name in SKIPPED:
                if name not in closed:
                    closed[name] = _closed(page, name)
                start, after = closed[name].get(at, (0, 0))
                # Without an end of its own, or with paragraphs before it where they cannot be, the tag alone goes.
                if after and not (name in ("svg", "select", "datalist") and BREAKS_OUT.search(page, at, start)):
                    at = after
                continue
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            if not close:
                break
            shut = page.find(">", close.end())
            at = end if shut < 0 else shut + 1
            continue
        if name in VOID:
            if name == "br":
                parts.append(" ")
            elif name == "hr":
                flush()
            continue
        if name in INLINE:
            if name == "a" and not found["rest"].endswith("/"):
                link = len(stack)
            continue
        flush()
        if stack[-1].tag in CLOSED_BY_BLOCK:
            pop_to(len(stack) - 1)
        if name in ITEMS:
            i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name or stack[i].tag in ITEMS[name]), 0)
            if i and stack[i].tag == name:
                pop_to(i)
        stack.append(_Element(name, stack[-1], found["rest"]))
    flush()
    return blocks


def cost(block, has_content):
    """How much rather content than boilerplate a block is by itself."""
    e, n = block.element, len(block.text)
    value = e.bad + e.good + SHORT + min(LONG, PER_CHARACTER * n) + int(PER_LINK * block.linked)
    value += HEADING * block.heading + SENTENCE * (block.text[-1] in ".!?…")
    if has_content and not e.inside:
        value += OUTSIDE
    if not e.inside and n < 300 and BOILERPLATE_TEXT.search(block.text):
        value += CUE
    return value


def ties(blocks):
    """(i, j, capacity): neighbours by their distance in the tree, and the next block of the same parent.

    A block inside an element of boilerplate is not tied to one outside.
    """
    found, last = [], {}
    for j, block in enumerate(blocks):
        parent = (id(block.element.parent), _marked(block))
        if j and _marked(blocks[j - 1]) == _marked(block):
            steps = _distance(blocks[j - 1].element, block.element)
            if strength := ADJACENT >> max(0, steps - 2):
                found.append((j - 1, j, strength))
        i = last.get(parent)
        if i is not None and i != j - 1:
            found.append((i, j, SIBLINGS))
        last[parent] = j
    return found


def _marked(block):
    return block.element.bad <= IN_BOILERPLATE


def _distance(a, b):
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def content_side(costs, tied):
    """For each node, whether it is on the content side of a minimum cut.

    ``costs`` above zero are capacities from the source, below zero to the sink; ``tied``
    (i, j, capacity) hold both ways. Shortest augmenting paths, phase by phase.
    """
    n = len(costs)
    source, sink = n, n + 1
    edges, to, room = [[] for _ in range(n + 2)], [], []

    def add(a, b, there, back):
        edges[a].append(len(to))
        to.append(b)
        room.append(there)
        edges[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(costs):
        if c > 0:
            add(source, i, c, 0)
        elif c < 0:
            add(i, sink, -c, 0)
    for i, j, c in tied:
        add(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source], wave = 0, [source]
        while wave and level[sink] < 0:
            following = []
            for a in wave:
                for e in edges[a]:
                    if room[e] and level[to[e]] < 0:
                        level[to[e]] = level[a] + 1
                        following.append(to[e])
            wave = following
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                cut = None
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if cut is None and not room[e]:
                        cut = k
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[a] < len(edges[a]):
                e = edges[a][turn[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_blocks(page):
    """(text, kept) of every block of an html text; null has none."""
    blocks = blocks_of(page or "")
    has_content = any(b.element.inside for b in blocks)
    kept = content_side([cost(b, has_content) for b in blocks], ties(blocks))
    return [(b.text, k) for b, k in zip(blocks, kept)]


def extract(pages: DataFrame, ids="page_id", url="url", page="html") -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept) for every row.

    Null and empty html, and pages without content, give an empty text. Repeated and null ids and
    urls stay as they are; other columns do not matter; an empty table gives an empty table.
    """

    def run(batches):
        for batch in batches:
            texts, sizes, kept = [], [], []
            for value in batch.column(2):
                blocks = main_blocks(value.as_py())
                good = [text for text, keep in blocks if keep]
                texts.append(" ".join(good))
                sizes.append(len(blocks))
                kept.append(len(good))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(kept, pa.int32())],
                names=["page_id", "url", "text", "n_blocks", "n_kept"],
            )

    chosen = pages.select(pages[ids].cast("bigint"), pages[url].cast("string"), pages[page])
    found = chosen.mapInArrow(run, "page_id bigint, url string, text string, n_blocks int, n_kept int")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")
