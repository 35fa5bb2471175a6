"""Main text of web pages, by a minimum cut between content and boilerplate.

A page is read into blocks (text between tags that start or end a block) and the containers
around them. A linear classifier gives each block the log odds z of being content, from its
words, links, tag and the names of the containers it lies in. No table labels blocks, so its
weights are fixed values.

Labels minimise the sum of all blocks' costs plus that of all edges whose ends differ. Calling
a block boilerplate costs softplus(z), calling it content softplus(-z): the capacities of its
arcs from the source and to the sink. Smoothness edges join blocks that follow each other, the
stronger the fewer steps lie between them in the tree, and blocks and containers with the
container they lie in. The source side of a minimum cut is the content.

A node whose terminal capacity exceeds all its edges together lies on that side of every
minimum cut; such nodes are settled first and their edges become capacities of their
neighbours. Max-flow (shortest augmenting levels) divides the rest. Capacities are whole
thousandths, so the result is exact and the same everywhere.

Pages are independent: nothing is shuffled, and memory is a few times the longest page.

Odd cases: a null or empty page, and one without any block of content, gives an empty text.
Unclosed tags end with their container, an unclosed comment, script or style with the page.
Repeated rows give repeated results. Further columns are dropped. An empty table gives an
empty result.
"""

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:(?P<rest>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<loose>[^>]*)>)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Kinds of elements.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER_SHOWN = frozenset("noscript template svg math canvas object audio video select button datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary
    table tbody td tfoot th thead tr ul""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# an opening tag ends an open element of these names, up to the given border
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}

# The classifier's weights.
MAIN_ELEMENT, GOOD_WORD, BAD_ELEMENT, BAD_WORD = 3.0, 1.5, -6.0, -6.0
LOWEST, HIGHEST, BAD_REGION_TEXT = -10.0, 4.5, 1.5
PER_LOG_WORD, SENTENCE_END, LINK_SHARE, SHORT_LABEL, NOTICE_PHRASE = 0.35, 0.8, -3.5, -0.8, -3.0
TAG_WEIGHT = {"p": 0.8, "li": -0.5, "td": -0.3, "th": -0.3, "blockquote": 0.4, "pre": 0.4} | dict.fromkeys(HEADINGS, 0.4)
ADJACENT, NEARBY, NESTED = 1.0, 0.5, 0.25  # smoothness

# Names of regions in elements, roles, classes and ids.
MAIN_ELEMENTS = frozenset(("article", "main"))
BAD_ELEMENTS = frozenset(("nav", "footer", "aside", "form", "menu", "fieldset", "dialog", "search", "label", "legend"))
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
GOOD_WORDS = frozenset("article content post entry story main body text prose".split())
BAD_WORDS = frozenset(
    """ad ads adv advert adverts advertisement adsense banner breadcrumb breadcrumbs byline captcha comment comments
    commentlist consent contact cookie cookies copyright disclaimer disqus feedback footer gdpr infobox legal login
    masthead menu meta modal nav navbar navigation newsletter notice notices notification overlay pager pagination
    paywall popup popups promo promoted promotion recommended register related replies reply respond responses rss
    search share sharing shoutbox sidebar signin signup social sponsor sponsored sponsors subscribe subscription tags
    teaser toc toolbar topbar widget widgets""".split()
)
BAD_STEMS = ("comment", "sidebar", "advert", "footer", "cookie", "breadcrumb", "paginat", "navig", "sponsor", "newslett")
COMMENT_WORDS = frozenset("comment comments commentlist disqus feedback replies reply respond responses".split())
NOTICE = re.compile(r"©|\(c\) ?\d{4}|all rights reserved|accept cookies|enable javascript", re.I)


class _Container:
    __slots__ = ("about", "depth", "has_main", "main", "number", "own", "parent", "plain_chars", "tag")

    def __init__(self, number: int, tag: str, parent: "_Container | None", own: float, about: str, main: bool):
        self.number, self.tag, self.parent, self.own, self.about, self.main = number, tag, parent, own, about, main
        self.depth = parent.depth + 1 if parent else 0
        self.plain_chars, self.has_main = 0, False


def _region(name: str, attributes: str, inside_main: bool) -> tuple[float, str, bool]:
    """What an element's name, role, class and id say about its content: weight, kind, main or not."""
    words, role, unseen = set(), "", False
    if attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id"):
                words.update(w.lower() for w in _WORD.findall(unescape(value)))
            elif key == "role":
                role = value.lower()
            elif key == "hidden" or (key == "style" and _UNSEEN.search(value)):
                unseen = True
    if name in ("html", "body"):
        return 0.0, "", False
    good = not words.isdisjoint(GOOD_WORDS)
    main = name in MAIN_ELEMENTS or role in MAIN_ELEMENTS
    if unseen:
        return BAD_WORD, "unseen", False
    if not words.isdisjoint(COMMENT_WORDS) or any(w.startswith("comment") for w in words):
        return BAD_WORD, "comments", False
    header = name == "header" or "header" in words
    if name in BAD_ELEMENTS or role in BAD_ROLES or (header and not (good or inside_main)):
        return BAD_ELEMENT, "layout", False
    if not words.isdisjoint(BAD_WORDS) or any(w.startswith(BAD_STEMS) for w in words):
        return BAD_WORD, "layout", False
    return (MAIN_ELEMENT if main else GOOD_WORD if good else 0.0), "", main


def _steps(a: _Container, b: _Container) -> int:
    n = 0
    while a is not b:
        if a.depth < b.depth:
            a, b = b, a
        a, n = a.parent, n + 1
    return n


def read_blocks(html: str) -> tuple[list[tuple[str, _Container, float, str]], list[_Container]]:
    """Blocks (text, container, share of text in links, tag) in page order, and all containers."""
    root = _Container(0, "body", None, 0.0, "", False)
    containers, blocks = [root], []
    stack: list[tuple[str, _Container | None, bool]] = [("#", root, False)]  # (name, container if a block, hidden)
    open_names: dict[str, int] = {}
    current, links, mains = root, 0, 0
    pieces: list[str] = []
    linked, plain = 0, 0

    def flush() -> None:
        nonlocal linked, plain
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append((text, current, linked / max(1, linked + plain), current.tag))
                current.plain_chars += plain
            pieces.clear()
            linked = plain = 0

    def pop() -> None:
        nonlocal current, links, mains
        name, container, _ = stack.pop()
        open_names[name] -= 1
        links -= name == "a"
        if container is not None:
            mains -= container.main
            current = container.parent

    def close(names: tuple[str, ...], borders: tuple[str, ...] = ()) -> None:
        """End the innermost open element of these names, and all inside it."""
        if not any(open_names.get(n) for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                if any(part[1] is not None for part in stack[k:]):
                    flush()
                while len(stack) > k:
                    pop()
                return
            if stack[k][0] in borders:
                return

    def say(raw: str) -> None:
        nonlocal linked, plain
        if not stack[-1][2]:
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            size = len(text) - text.count(" ")
            if links:
                linked += size
            else:
                plain += size

    at, end = 0, len(html)
    while at < end:
        found = _TOKEN.search(html, at)
        if found is None:
            say(html[at:])
            break
        if found.start() > at:
            say(html[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if found["end"]:
            if name in VOID or not open_names.get(name):
                if name in ("br", "p"):
                    pieces.append(" ")
                continue
            close((name,), () if name in BLOCK else ("td", "th", "table", "article", "main", "body"))
            continue
        if name in RAW:
            closing = re.compile(rf"</{name}[\s/>]", re.I).search(html, at)
            at = html.find(">", closing.start()) + 1 or end if closing else end
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name == "br":
                pieces.append(" ")
            continue
        attributes = found["rest"] if found["rest"] is not None else found["loose"]
        is_block = name in BLOCK or "-" in name
        if is_block:
            flush()
            close(("p",), ("td", "th", "table"))
            if name in ENDS:
                close(*ENDS[name])
        hidden = stack[-1][2] or name in NEVER_SHOWN
        if attributes.endswith("/") and name in NEVER_SHOWN:
            continue
        container = None
        if is_block:
            own, about, main = _region(name, attributes, mains > 0)
            container = _Container(len(containers), name, current, own, about, main)
            containers.append(container)
            current = container
            mains += main
        stack.append((name, container, hidden))
        open_names[name] = open_names.get(name, 0) + 1
        links += name == "a"
    flush()
    return blocks, containers


def _priors(containers: list[_Container]) -> list[float]:
    """What the regions around a container say together.

    A layout name counts for nothing on a container of the page's main element: some pages
    wrap everything in a form or name their frame after its sidebar.
    """
    chars = [c.plain_chars for c in containers]
    for c in reversed(containers[1:]):  # children come after their parents
        chars[c.parent.number] += chars[c.number]
    mains = [c for c in containers if c.main]
    if mains:
        largest = max(mains, key=lambda c: (chars[c.number], -c.number)).parent
        while largest is not None:
            largest.has_main, largest = True, largest.parent
    priors = [0.0] * len(containers)
    for c in containers[1:]:
        before = priors[c.parent.number]
        own = 0.0 if c.has_main and c.about == "layout" else c.own
        if own > 0 and before < 0:
            own = 0.0
        priors[c.number] = min(HIGHEST, max(LOWEST, before + own))
    return priors


def log_odds(text: str, link_share: float, tag: str, prior: float) -> float:
    """The classifier: log odds that a block is content."""
    words = text.count(" ") + 1
    sentence = text.rstrip("\"'”’»)")[-1:] in ".!?…:;。"
    z = PER_LOG_WORD * math.log1p(words) + TAG_WEIGHT.get(tag, 0.0) + LINK_SHARE * link_share
    if sentence:
        z += SENTENCE_END
    elif words <= 4 and tag != "p" and tag not in HEADINGS:
        z += SHORT_LABEL
    if words <= 40 and NOTICE.search(text):
        z += NOTICE_PHRASE
    return prior + (z if prior >= 0 else min(z, BAD_REGION_TEXT))


def minimum_cut(terminal: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """Whether each node is on the source side of a minimum cut.

    ``terminal`` is the capacity from the source less that to the sink; ``edges`` join two nodes
    with the capacity of both directions.
    """
    near: list[dict[int, int]] = [{} for _ in terminal]
    for (a, b), weight in edges.items():
        if a != b and weight > 0:
            near[a][b] = near[a].get(b, 0) + weight
            near[b][a] = near[b].get(a, 0) + weight
    net, side = list(terminal), [None] * len(terminal)
    pull = [sum(n.values()) for n in near]
    due = deque(range(len(net)))
    while due:  # settle what its own capacity decides
        a = due.popleft()
        if side[a] is None and abs(net[a]) >= pull[a]:
            side[a] = net[a] > 0
            for b, weight in near[a].items():
                if side[b] is None:
                    net[b] += weight if side[a] else -weight
                    pull[b] -= weight
                    due.append(b)
    rest = [a for a, s in enumerate(side) if s is None]
    if rest:
        for a, s in _max_flow(rest, net, near).items():
            side[a] = s
    return side


def _max_flow(nodes: list[int], net: list[int], near: list[dict[int, int]]) -> dict[int, bool]:
    """Sides of the given nodes, by max-flow in levels of shortest paths."""
    source, sink = -1, -2
    inside = set(nodes)
    left: dict[int, dict[int, int]] = {a: {b: w for b, w in near[a].items() if b in inside} for a in nodes}
    left[source], left[sink] = {}, {}
    for a in nodes:
        if net[a] > 0:
            left[source][a], left[a][source] = net[a], 0
        elif net[a] < 0:
            left[a][sink], left[sink][a] = -net[a], 0
    while True:
        level = {source: 0}
        wave = deque([source])
        while wave:
            a = wave.popleft()
            for b, room in left[a].items():
                if room > 0 and b not in level:
                    level[b] = level[a] + 1
                    wave.append(b)
        if sink not in level:
            return {a: a in level for a in nodes}
        ways = {a: iter(left[a].items()) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                room = min(left[x][y] for x, y in zip(path, path[1:]))
                for x, y in zip(path, path[1:]):
                    left[x][y] -= room
                    left[y][x] += room
                cut = next(k for k, (x, y) in enumerate(zip(path, path[1:])) if left[x][y] == 0)
                del path[cut + 1 :]
                ways[path[-1]] = iter(list(left[path[-1]].items()))
                continue
            for b, _ in ways[a]:
                if left[a][b] > 0 and level.get(b, -1) == level[a] + 1:
                    path.append(b)
                    break
            else:
                level[a] = -1
                path.pop()


def main_blocks(html: str) -> list[str]:
    """The blocks of a page that lie on the content side, in page order."""
    blocks, containers = read_blocks(html)
    if not blocks:
        return []
    priors = _priors(containers)
    n = len(blocks)
    terminal = [round(1000 * log_odds(text, share, tag, priors[c.number])) for text, c, share, tag in blocks]
    edges: dict[tuple[int, int], int] = {}
    for k in range(1, n):
        steps = _steps(blocks[k - 1][1], blocks[k][1])
        edges[k - 1, k] = round(1000 * ADJACENT / max(1, steps))
    used = set()
    for k, (_, c, _, _) in enumerate(blocks):
        edges[k, n + c.number] = round(1000 * NEARBY)
        while c.parent is not None and c.number not in used:
            used.add(c.number)
            if c.parent.number:  # the page itself holds everything and says nothing
                edges[n + c.number, n + c.parent.number] = round(1000 * NESTED)
            c = c.parent
    side = minimum_cut(terminal + [0] * len(containers), edges)
    return [blocks[k][0] for k in range(n) if side[k]]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its blocks of content, joined by empty lines."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = ["\n\n".join(main_blocks(html)) for html in frame["html"]]
            yield pd.DataFrame(
                {"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    # ids travel as text: a null among whole numbers would turn a pandas column into floats
    wanted = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    made = wanted.mapInPandas(work, "page_id string, url string, text string, n_chars long")
    return made.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType))
