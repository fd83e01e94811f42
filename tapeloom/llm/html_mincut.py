"""Main text of web pages by minimum cut: blocks are content or boilerplate."""

from __future__ import annotations

import html as html_lib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tapeloom.llm.bpe import slices

# Fixed values of HTML: elements whose inside is no text, that stand alone, that
# begin a block, and that close themselves when a block begins.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "textarea", "select")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BLOCK = (
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
)
#: What a tag says about the blocks inside it: cost of calling them content.
TAG_COST = {
    "nav": 9.0, "footer": 9.0, "aside": 8.0, "form": 8.0, "header": 6.0, "menu": 8.0, "button": 8.0, "dialog": 8.0, "fieldset": 6.0,
    "label": 4.0, "address": 3.0,
}
#: And cost of calling them boilerplate.
TAG_GAIN = {"article": 7.0, "main": 5.0, "h1": 1.5, "p": 1.0, "blockquote": 1.0, "pre": 1.0, "figcaption": 0.5}
#: Words in class, id and role that mark boilerplate or content.
BAD_HINT = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|copyright|disqus|footer|footnav|gdpr|"
    r"login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|paywall|popup|promo\w*|related|recommend\w*|replies|reply|"
    r"respond|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|tags?|toolbar|widget|complementary|contentinfo|"
    r"search|alert|feedback|reactions|discussion)(?:$|[\s_-])"
)
GOOD_HINT = re.compile(r"(?i)(?:^|[\s_-])(?:article|articlebody|body-?text|content|entry|main|post|story|text)(?:$|[\s_-])")
HINT_COST, HINT_GAIN = 9.0, 3.0
#: Class tokens that tell what a page has or does not have; they name no part of it.
STATE = re.compile(r"(?i)(?:(?:no|not|non|without|with|has|have|is|hide|hides|show|shows|enable|disable)[_-].*|.*[_-](?:no|not|non|without|with|has|have)[_-].*|.*[_-](?:enabled?|disabled?|on|off|open|opened))")
#: Elements whose hints are about the page as a whole, and the hints of an article that do not just describe it.
WHOLE = ("html", "body", "main")
ARTICLE_HINT = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|comments?|commentlist|disqus|promo\w*|related|recommend\w*|replies|reply|respond|sponsor\w*|teaser)(?:$|[\s_-])")
#: Readers' words: never an article, however long.
COMMENT_HINT = re.compile(r"(?i)(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|reply|respond|reactions|discussion)(?:$|[\s_-])")
HIDING_STYLE = re.compile(r"(?i)(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b")
#: An element that names itself an article is one if it holds so much of the plain text of the largest such
#: element, and of the page; one that names itself boilerplate too, so much of the page.
OF_LARGEST, OF_PAGE, OF_PAGE_AGAINST_HINT = 0.3, 0.25, 0.6
#: Where none names itself: the innermost element with most of the plain text, if that is so many characters.
MOST, LEAST_CHARS = 0.6, 300
FRAME = ("nav", "footer", "header", "aside", "menu", "dialog", "button")
#: Weights of the classifier on a block's own words.
LINK_COST, SHORT_COST, TEXT_GAIN, PRIOR = 6.0, 0.6, 2.5, 0.3
#: Smoothness: neighbours in the page, and neighbours below one parent.
NEXT_EDGE, PARENT_EDGE = 0.8, 0.6

# a quoted value counts only behind an equals sign; nothing is read twice
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+(?:>|\Z)", re.S
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_RAW, _VOID, _BLOCK = frozenset(RAW), frozenset(VOID), frozenset(BLOCK)
_RAW_END = {t: re.compile(rf"(?is)</{t}\s*>") for t in RAW}
#: Where text goes on behind an element that never ends.
_RESUME = re.compile(r"(?i)<(?:body|article|main|section|div|p|h[1-6]|ul|ol|dl|table|blockquote|pre|header|footer|nav|aside)[\s/>]")
_ARTICLE = re.compile(r"(?i)<(?:article|main)[\s>]")
#: Elements that an article does not lie in, where they have no end tag behind its start.
_UNCLOSED = ("nav", "aside", "header", "footer", "form", "menu", "dialog")


@dataclass
class Element:
    name: str
    parent: int
    cost: float
    gain: float
    hidden: bool
    hint: float = 0.0
    comment: bool = False


@dataclass
class Block:
    """One run of text between block borders."""

    element: int
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    chars: int = 0


def _hints(tag: str, start: int, bad: re.Pattern) -> tuple[float, float, bool, bool]:
    cost = gain = 0.0
    hidden = comment = False
    for m in _ATTRIBUTE.finditer(tag, start):
        name = m[1].lower()
        if name == "hidden":
            hidden = True
        elif name == "style":
            hidden |= HIDING_STYLE.search(m[2] or m[3] or m[4] or "") is not None
        elif name in ("class", "id", "role", "aria-hidden"):
            value = m[2] or m[3] or m[4] or ""
            if name == "aria-hidden":
                hidden |= value.strip().lower() == "true"
                continue
            tokens = [t for t in value.split() if not STATE.fullmatch(t)]
            comment |= any(map(COMMENT_HINT.search, tokens))
            if any(map(bad.search, tokens)):
                cost = HINT_COST
            elif any(map(GOOD_HINT.search, tokens)):
                gain = HINT_GAIN
    return cost, gain, hidden, comment


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """Text blocks in page order and the elements they lie in; broken markup is read as far as it goes."""
    elements = [Element("#root", -1, 0.0, 0.0, False)]
    stack, links = [0], 0
    # depths at which each name and any block is open, so that end tags are matched without a search
    open_at: dict[str, list[int]] = {}
    open_blocks: list[int] = []
    endless: set[str] = set()
    out: list[Block] = []
    current: Block | None = None

    def text(piece: str) -> None:
        nonlocal current
        if not piece:
            return
        if current is None:
            if piece.isspace():
                return
            home = stack[-1]
            current = Block(home)
            out.append(current)
        current.parts.append(piece)
        n = len(piece.strip())
        current.chars += n
        if links:
            current.link_chars += n

    def close_from(depth: int) -> None:
        nonlocal links
        for e in reversed(stack[depth:]):
            name = elements[e].name
            open_at[name].pop()
            if name in _BLOCK:
                open_blocks.pop()
            links -= name == "a"
        del stack[depth:]

    lower = page.lower()
    last_end = {name: lower.rfind(f"</{name}") for name in _UNCLOSED}
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(html_lib.unescape(page[at:]))
            break
        if m.start() > at:
            text(html_lib.unescape(page[at : m.start()]))
        at = m.end()
        tag = m[0]
        name_match = _NAME.match(tag)
        if name_match is None:
            if tag.startswith("<![CDATA["):
                text(tag[9:-3] if tag.endswith("]]>") else tag[9:])
            continue
        name = name_match[1].lower()
        block = name in _BLOCK
        if tag[1] == "/":
            if block:
                current = None
            if name in _RAW:
                continue
            if open_at.get(name):
                depth = open_at[name][-1]
                # an inline end tag closes nothing beyond its block
                if block or not open_blocks or open_blocks[-1] < depth:
                    close_from(depth)
            continue
        if name in _RAW and not tag.endswith("/>"):
            close = None if name in endless else _RAW_END[name].search(page, at)
            if close is None:
                endless.add(name)
            if name == "noscript" and close and _ARTICLE.search(page, at, close.start()):
                continue  # what is read without scripts is the article itself
            if name == "head":
                body = re.compile(r"(?i)<body[\s>]").search(page, at)
                if body and (close is None or body.start() < close.start()):
                    at = body.start()
                    continue
            if close is None:
                # what never ends must not swallow the page
                close = _RESUME.search(page, at)
                at = close.start() if close else end
            else:
                at = close.end()
            continue
        if name == "br":
            text(" ")
            continue
        if name == "a" and links and (not open_blocks or open_blocks[-1] < open_at["a"][-1]):
            close_from(open_at["a"][-1])  # a link ends where another one begins
        if name in ("article", "main"):
            # it lies in no link, and in nothing around that never ends
            depths = [open_at[x][0] for x in _UNCLOSED if open_at.get(x) and last_end[x] < at] + open_at.get("a", [])[:1]
            if depths:
                close_from(min(depths))
        if block:
            current = None
            if name in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "div", "section", "article", "footer", "nav", "aside", "ul", "ol", "table", "form", "header", "main"):
                # an open paragraph ends where a block begins, and inline marks with it
                if open_blocks:
                    inner = elements[stack[open_blocks[-1]]].name
                    if inner == "p" or (inner == name and name in ("li", "dt", "dd", "td", "th", "tr")):
                        close_from(open_blocks[-1])
        if name in _VOID or tag.endswith("/>"):
            continue
        cost, gain, hidden, comment = _hints(tag, name_match.end(), ARTICLE_HINT if name == "article" else BAD_HINT) if len(tag) > len(name) + 2 else (0.0, 0.0, False, False)
        elements.append(Element(name, stack[-1], TAG_COST.get(name, 0.0), gain + TAG_GAIN.get(name, 0.0), hidden, 0.0 if name in WHOLE else cost, comment and name not in WHOLE))
        open_at.setdefault(name, []).append(len(stack))
        if block:
            open_blocks.append(len(stack))
        stack.append(len(elements) - 1)
        links += name == "a"
    return out, elements


def min_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the source's side of a minimum cut (Dinic's maximum flow).

    ``source[i]`` is paid when node i is cut from the source, ``sink[i]`` when it
    stays, and an edge's weight when its ends are parted. Of several minimum
    cuts the one with fewest nodes on the source's side is taken.
    """
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        direct = min(source[i], sink[i])  # this much flows straight through
        if source[i] > direct:
            link(s, i, source[i] - direct, 0.0)
        elif sink[i] > direct:
            link(i, t, sink[i] - direct, 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            v = queue.popleft()
            for e in out[v]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        v = s
        while True:
            if v == t:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(i for i, e in enumerate(path) if room[e] <= tiny)
                v = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[v] < len(out[v]):
                e = out[v][turn[v]]
                if room[e] > tiny and level[to[e]] == level[v] + 1:
                    break
                turn[v] += 1
            else:
                if v == s:
                    break
                level[v] = -1
                v = to[path.pop() ^ 1]
                continue
            path.append(out[v][turn[v]])
            v = to[path[-1]]


def articles_in(blocks: list[Block], elements: list[Element]) -> dict[int, bool]:
    """Elements that hold an article, and whether their own hint is to be passed over.

    What is said around such an element is said about the rest of the page. They
    are told by their share of the plain text: characters outside of links that
    are neither hidden nor readers' comments.
    """
    plain = [0] * len(elements)
    aside = [False] * len(elements)
    for e in range(1, len(elements)):
        aside[e] = aside[elements[e].parent] or elements[e].hidden or elements[e].comment
    for b in blocks:
        if not aside[b.element]:
            plain[b.element] += max(0, b.chars - b.link_chars)
    for e in range(len(elements) - 1, 0, -1):
        plain[elements[e].parent] += plain[e]
    total = plain[0]
    if not total:
        return {}
    named = [e for e in range(1, len(elements)) if plain[e] and (elements[e].name in ("article", "main") or elements[e].gain >= HINT_GAIN)]
    free = [e for e in named if not elements[e].hint]
    largest = max((plain[e] for e in free), default=0)
    found = {e: False for e in free if plain[e] >= OF_LARGEST * largest and plain[e] >= OF_PAGE * total}
    if not found:
        found = {e: True for e in named if elements[e].hint and plain[e] >= OF_PAGE_AGAINST_HINT * total}
    if not found and not named and total >= LEAST_CHARS:
        inner = max((e for e in range(1, len(elements)) if plain[e] >= MOST * total), default=0)
        if inner and not any(elements[e].name in FRAME for e in (inner, *_ancestors(inner, elements))):
            found = {inner: False}
    return found


def extract(page: str | None) -> str:
    """The article's blocks, joined by an empty line; empty where there are none."""
    blocks, elements = blocks_of(page or "")
    texts = [_SPACE.sub(" ", "".join(b.parts)).strip() for b in blocks]
    nodes = [i for i, t in enumerate(texts) if t]
    if not nodes:
        return ""
    articles = articles_in(blocks, elements)
    # costs gather along the way down, beginning anew where an article begins; inside an article only what its own parts say cancels its gain, and hints
    # around it weigh no more than its tag, so that its words decide
    memo: dict[int, tuple[float, float, float, bool, bool, bool]] = {}

    def context(e: int) -> tuple[float, float, float, bool, bool, bool]:
        chain = []
        while e >= 0 and e not in memo:
            chain.append(e)
            e = elements[e].parent
        cost, around, gain, hidden, inside, comment = memo[e] if e >= 0 else (0.0, 0.0, 0.0, False, False, False)
        for e in reversed(chain):
            one = elements[e]
            mine, hint = one.cost, one.hint
            if e in articles:
                cost = around = 0.0
                hint = 0.0 if articles[e] else hint
            comment |= bool(articles) and one.comment and e not in articles
            if one.name == "header" and any(elements[x].name in ("article", "main") for x in _ancestors(e, elements)):
                mine = hint = 0.0  # an article's own heading
            if hint and (inside or one.name == "article"):
                cost = max(cost, mine + hint)
            else:
                cost, around = max(cost, mine), max(around, mine + hint if hint else 0.0)
            inside |= one.name == "article"
            gain, hidden = max(gain, one.gain), hidden or one.hidden
            memo[e] = cost, around, gain, hidden, inside, comment
        return cost, around, gain, hidden, inside, comment

    source, sink = [], []
    for i in nodes:
        b, t = blocks[i], texts[i]
        cost, around, gain, hidden, inside, comment = context(b.element)
        if comment:
            gain = 0.0  # a reader's words, though they may call themselves an article
        if not inside or comment:
            cost = max(cost, around)
        if cost and gain >= TAG_GAIN["article"]:
            gain = 0.0  # boilerplate set inside the article
        if inside:
            cost = max(cost, min(around, TAG_GAIN["article"]))
        words = len(t) / (len(t) + 60.0)
        share = min(1.0, b.link_chars / max(b.chars, 1))
        source.append(gain + TEXT_GAIN * words * (1 - share))
        sink.append(PRIOR + cost + LINK_COST * share * share + SHORT_COST * (1 - words) * (0.2 if gain else 1.0) + (50.0 if hidden else 0.0))
    edges, by_parent = [], {}
    for k, i in enumerate(nodes):
        if k:
            edges.append((k - 1, k, NEXT_EDGE))
        parent = _block_parent(blocks[i].element, elements)
        if parent in by_parent:
            edges.append((by_parent[parent], k, PARENT_EDGE))
        by_parent[parent] = k
    keep = min_cut(source, sink, edges)
    return "\n\n".join(texts[i] for i, good in zip(nodes, keep, strict=True) if good)


def _ancestors(e: int, elements: list[Element]) -> Iterator[int]:
    e = elements[e].parent
    while e >= 0:
        yield e
        e = elements[e].parent


def _block_parent(e: int, elements: list[Element]) -> int:
    """The element around the block element that holds a text."""
    while e > 0 and elements[e].name not in _BLOCK:
        e = elements[e].parent
    return elements[e].parent if e > 0 else 0


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page, from its whole html.

    Null and empty pages, and pages without content, have an empty text. Null
    and repeated ids are kept; other columns are not read; markup that breaks
    off is read as far as it goes; an empty table gives no rows.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = [extract(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    return df.select(id_col, url_col, html_col).mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
