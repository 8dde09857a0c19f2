"""Main text of web pages by minimum cuts over their blocks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemfold.llm.common import hash_sample

# --- fixed values: the kinds of elements, and words in class, id and role attributes ---
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript svg iframe object canvas textarea select option datalist head title button".split())
RAW = frozenset("script style textarea title iframe noscript svg template".split())
AWAY = frozenset("nav footer aside form menu dialog".split())
TOWARD = frozenset("article main".split())
AWAY_NAMES = frozenset("ad ads adv advert adverts advertisement advertising aside banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie cookies copyright disqus dropdown footer footnav form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted recommended related replies respond search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar topnav widget widgets".split())
TOWARD_NAMES = frozenset("article content entry main post story".split())
#: The last of these in a name says what holds something, the word before it what is held: post-content, footer-wrapper.
HOLDERS = frozenset("area bar block body box buttons container content group inner item items links list outer panel section text wrap wrapper".split())
#: With one of these before it even a story is not the page's own: related-posts.
OTHERS = frozenset("popular promoted recommended related sponsored trending".split())
#: A name with one of these says what a page has or lacks: no-sidebar.
ABOUT = frozenset("has is no not with without".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
PLAIN = frozenset(("p", "li", "dt", "dd", *HEADINGS))

_open = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_names = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_hide = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_quote = re.compile("[>\"']")

#: What an element says in which a form, or another element that is not content, is the innermost.
FORM, ASIDE = -1, -2

#: Features of a block's text and of the block that holds it; then what elements and names around it say.
TEXT, MARKS = 12, 4


@dataclass
class Block:
    text: str
    #: Number of the container, as in Page.parent.
    container: int
    linked: int
    tag: str
    #: Below 0 inside an element (or a name) that is not content, 1 inside one that is, as the innermost of them says.
    element: int
    name: int
    features: list[float] = field(default_factory=list)


@dataclass
class Page:
    blocks: list[Block]
    #: The container around each container; the first is the page.
    parent: list[int]


@cache
def _says(name: str, inside: bool) -> int:
    """What one name says: 1 content, -1 something else, 0 neither. Its head counts: post-comments are comments.

    The header of content (in it, or by its name) belongs to it.
    """
    words = [w.lower() for w in _word.findall(name)]
    if any(w in ABOUT for w in words):
        return 0
    if not OTHERS.isdisjoint(words):
        return -1
    while len(words) > 1 and words[-1] in HOLDERS:
        words.pop()
    head = words[-1] if words else ""
    if head == "header" and (inside or not TOWARD_NAMES.isdisjoint(words)):
        return 0
    return -1 if head in AWAY_NAMES else int(head in TOWARD_NAMES)


def _named(attributes: str, inside: bool) -> int:
    found = sum(_says(n, inside) for m in _names.finditer(attributes) for n in m[1].strip("\"'").split())
    return (found > 0) - (found < 0)


def _end(html: str, at: int, strict: bool, last: dict[str, int]) -> tuple[int, bool]:
    """The place of the > that ends a tag, outside quotes if their ends can be found, else the next one; -1 if there is none."""
    start = at
    while strict:
        m = _quote.search(html, at)
        if not m or m[0] != ">" and last[m[0]] <= m.start():
            strict = False
        elif m[0] == ">":
            return m.start(), True
        else:
            at = html.index(m[0], m.start() + 1) + 1
    return html.find(">", start), False


def read_page(html: str) -> Page:
    """The text blocks of a page in order, split at block elements; references are decoded, white space is one space.

    Time is in proportion to the page: each tag is scanned once, ends of
    comments and quotes are not searched for again where none are left, and
    open elements are found by counts.
    """
    out: list[Block] = []
    parent = [0]
    # name, container, element's say, names' say, hidden
    stack: list[tuple[str, int, int, int, bool]] = [("", 0, 0, 0, False)]
    held = [0]  # places of blocks in the stack
    inline: list[dict[str, int]] = [{}]  # open inline elements since each of them
    opened: dict[str, int] = {}  # open blocks
    parts: list[str] = []
    linked = in_link = at = 0
    strict, last = True, {c: html.rfind(c) for c in "\"'>"}
    last_comment = html.rfind("-->")

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            name, container, element, says, _ = stack[held[-1]]
            out.append(Block(text, container, min(linked, len(text)), name, element, says))
        parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not stack[-1][4]:
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def drop(depth: int) -> None:
        """Close all elements from this place of the stack on."""
        nonlocal in_link
        while len(stack) > depth:
            name = stack.pop()[0]
            if name in BLOCK:
                held.pop(), inline.pop()
                opened[name] -= 1
            else:
                inline[-1][name] -= 1
                in_link -= name == "a"

    while (i := html.find("<", at)) >= 0:
        say(html[at:i])
        if html.startswith("<!--", i):
            at = html.find("-->", i + 4) + 3 if last_comment >= i + 4 else len(html)
            continue
        m = _open.match(html, i)
        if not m:
            if html.startswith(("<!", "<?", "</"), i):
                at = html.find(">", i) + 1 or len(html)
            else:
                say("<")
                at = i + 1
            continue
        if last[">"] < i:  # a tag without end holds the rest
            at = len(html)
            break
        end, strict = _end(html, m.end(), strict, last)
        attributes, name, at = html[m.end() : end], m[2].lower(), end + 1
        if name == "br":
            say(" ")
        elif name in VOID:
            if name == "hr":
                flush()
        elif m[1]:
            if name in BLOCK:
                flush()
                if opened.get(name):
                    drop(next(k for k in reversed(held) if stack[k][0] == name))
            elif inline[-1].get(name):  # an inline end tag does not reach over the block it stands in
                drop(next(k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name))
        else:
            if name in BLOCK:
                flush()
                if stack[held[-1]][0] == "p" and held[-1]:
                    drop(held[-1])
                if stack[held[-1]][0] in ENDS.get(name, ()):
                    drop(held[-1])
            _, container, element, says, hidden = stack[-1]
            inside = element > 0 or says > 0
            own = _named(attributes, inside) if attributes.strip() and name not in ("html", "body") else 0
            # what is not content stays so for all that is in it, but a form may hold the page
            may = element >= FORM and says >= 0
            if name in AWAY or name == "header" and not inside:
                element, says = FORM if name == "form" and may else ASIDE, min(says, 0)
                may = name == "form" and may
            elif name in TOWARD and may:
                element = 1
            if own < 0 and inside and name in PLAIN:
                says = -1  # one paragraph's name does not undo what holds it
            elif own < 0:
                element, says = min(element, 0), -1
            elif own > 0 and may:
                element, says = max(element, 0), 1
            if name in BLOCK and name not in PLAIN:
                parent.append(container)
                container = len(parent) - 1
            stack.append((name, container, element, says, hidden or name in HIDDEN or bool(attributes and _hide.search(attributes))))
            if name in BLOCK:
                held.append(len(stack) - 1), inline.append({})
                opened[name] = opened.get(name, 0) + 1
            else:
                inline[-1][name] = inline[-1].get(name, 0) + 1
                in_link += name == "a"
            if name == "svg" and attributes.endswith("/"):
                drop(len(stack) - 1)
            elif name in RAW:
                closing = re.compile(rf"</{re.escape(name)}\b", re.I).search(html, at)
                at = closing.start() if closing else len(html)
    say(html[at:])
    flush()
    return Page(_with_features(out), parent)


def _with_features(found: list[Block]) -> list[Block]:
    own: dict[int, int] = {}
    for b in found:
        own[b.container] = own.get(b.container, 0) + len(b.text) - b.linked
    total = max(1, sum(own.values()))
    for b in found:
        n, words, stops = len(b.text), b.text.count(" ") + 1, sum(map(b.text.count, ".,;:!?"))
        mass = max(own[b.container], 0)
        b.features = [
            1.0, np.log1p(n) / 5, np.log1p(words) / 4, b.linked / n, min(0.2, stops / n) * 5, np.log1p(mass) / 6, mass / total,
            float(b.tag == "p"), float(b.tag == "li"), float(b.tag in HEADINGS), float(b.tag in ("div", "section", "body", "")), float(b.text[-1] in ".!?:;\"'”»…"),
            float(b.element < 0), float(b.element > 0), float(b.name < 0), float(b.name > 0),
        ]
    return found


def max_flow_labels(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source side of a minimum cut.

    A node with gain g > 0 hangs on the source with capacity g, one with g < 0
    on the sink with -g; cutting an edge costs its weight either way. Nodes
    whose gain outweighs all their edges are settled first, and hand their
    edges on as gains; that changes no minimum. Then each node sends its gain
    along shortest paths to nodes that can still take some. What a search
    reaches in vain stays on the source side for good: nothing can leave it.
    """
    n = len(gain)
    g = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        if w > 0 and i != j:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    side: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:
        i = todo.pop()
        if side[i] is None and abs(g[i]) >= sum(near[i].values()):
            side[i] = g[i] > 0
            for j, w in near[i].items():
                g[j] += w if side[i] else -w
                del near[j][i]
                if side[j] is None:
                    todo.append(j)
            near[i] = {}
    for start in range(n):
        while side[start] is None and g[start] > 1e-9:
            came, line, goal = {start: start}, [start], -1
            for i in line:
                if g[i] < -1e-9:
                    goal = i
                    break
                for j, c in near[i].items():
                    if c > 1e-9 and j not in came and side[j] is None:
                        came[j] = i
                        line.append(j)
            if goal < 0:
                for i in line:
                    side[i] = True
                break
            path, j = [], goal
            while j != start:
                path.append((came[j], j))
                j = came[j]
            least = min(g[start], -g[goal], *(near[i][j] for i, j in path))
            g[start] -= least
            g[goal] += least
            for i, j in path:
                near[i][j] -= least
                near[j][i] += least
    return [bool(s) for s in side]


#: What parting two neighbours costs: in one container, and for each step between their containers a share of it.
WITHIN, STEP, FAR = 1.5, 0.35, 4


def _steps(parent: list[int], a: int, b: int) -> int:
    """Steps in the tree of containers from a to b, FAR at most."""
    n = 0
    while a != b and n < FAR:
        if a > b:
            a = parent[a]
        else:
            b = parent[b]
        n += 1
    return n if a == b else FAR


def smoothness(page: Page) -> list[tuple[int, int, float]]:
    """Edges between neighbours in the page, and between a block and the one before it in its container or in those around it."""
    edges: list[tuple[int, int, float]] = []
    before: dict[int, int] = {}
    for k, b in enumerate(page.blocks):
        if k:
            edges.append((k - 1, k, WITHIN * STEP ** _steps(page.parent, page.blocks[k - 1].container, b.container)))
        c = b.container
        for up in range(3):
            if (j := before.get(c, k)) < k - 1:
                edges.append((j, k, WITHIN / 2 * STEP ** (up + _steps(page.parent, c, page.blocks[j].container))))
            before[c] = k
            if not c:
                break
            c = page.parent[c]
    return edges


#: Nats that a text's features may weigh, and a mark against or for content; so a text with an edge or two can overrule what a name says.
MOST_TEXT, MOST_AWAY, MOST_TOWARD = 3.0, 1.5, 3.0


def gains(found: list[Block], weights: np.ndarray) -> np.ndarray:
    """Terminal capacities: by how many nats each block is content by its text, and by what elements and names around it say."""
    x = np.array([b.features for b in found]).reshape(-1, TEXT + MARKS)
    return np.clip(x[:, :TEXT] @ weights[:TEXT], -MOST_TEXT, MOST_TEXT) + x[:, TEXT:] @ np.clip(weights[TEXT:], -MOST_AWAY, MOST_TOWARD)


def label_blocks(page: Page, weights: np.ndarray) -> list[bool]:
    return max_flow_labels(gains(page.blocks, weights).tolist(), smoothness(page)) if page.blocks else []


def main_text(html: str, weights: np.ndarray) -> str:
    page = read_page(html)
    return "\n".join(b.text for b, content in zip(page.blocks, label_blocks(page, weights), strict=True) if content)


def bulk(page: Page, share: float = 0.5) -> list[bool] | None:
    """Which blocks are in the container that directly holds ``share`` of the page's unlinked text, or in one inside it; None if none does.

    It looks at no tag and no name.
    """
    own: dict[int, int] = {}
    for b in page.blocks:
        own[b.container] = own.get(b.container, 0) + len(b.text) - b.linked
    top = max(own, key=lambda c: (own[c], -c), default=None)
    if top is None or own[top] < share * sum(own.values()) or own[top] < 200:
        return None
    inside = {top}
    for c in range(top + 1, len(page.parent)):
        if page.parent[c] in inside:
            inside.add(c)
    return [b.container in inside for b in page.blocks]


#: What is believed of the weights before any page is seen: text without marks (long, punctuated, unlinked text is content), and marks.
PRIOR = np.array([-3.0, 1.0, 1.0, -2.0, 1.0, 1.0, 2.0, 0.5, -0.5, 0.0, 0.0, 0.5, -4.5, 4.5, -4.5, 4.5])


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float, offset: np.ndarray, rounds: int = 25) -> np.ndarray:
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.clip(np.linalg.solve(hessian, x.T @ (p - y) + ridge * (w - prior)), -2, 2)
    return w


def fit_blocks(pages: DataFrame, html_col: str, most: int = 1000) -> np.ndarray:
    """Weights of a block's features from about ``most`` pages drawn by hash, each of them once.

    Labels come from where the bulk of a page's text is, so neither from
    tags nor from names. The text's weights are fitted first, without marks,
    and those of the marks on what the text leaves open; both are drawn to a prior that holds
    where the pages say nothing.
    """
    text = F.col(html_col)
    some = hash_sample(pages.select(text.alias("html")).where(text.isNotNull()), most, "html").distinct()
    x, y = [], []
    for r in some.toLocalIterator():
        page = read_page(r[0])
        if (labels := bulk(page)) is not None:
            x += [b.features for b in page.blocks]
            y += labels
    if not x:
        return PRIOR
    a, t = np.array(x), np.array(y, float)
    order = np.lexsort((*a.T, t))
    a, t = a[order], t[order]
    words = _logistic(a[:, :TEXT], t, PRIOR[:TEXT], 5.0, np.zeros(len(a)))
    said = np.clip(a[:, :TEXT] @ words, -MOST_TEXT, MOST_TEXT)
    return np.concatenate([words, _logistic(a[:, TEXT:], t, PRIOR[TEXT:], 5.0, said)])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: np.ndarray | None = None) -> DataFrame:
    """One row for each page: id, url, text, n_chars.

    A classifier of a block's text, of its place and of the elements and names around
    it gives the capacities of the terminals; neighbours and blocks of one container, or of
    containers that are near in the tree, pull each other; a minimum cut parts
    content from the rest. Content blocks are joined by line feeds.

    A null or empty page has an empty text; null ids and urls pass through;
    repeated rows come back repeated. Of ties, a block that gains nothing either way is
    left out. Extra columns are not read.
    """
    own = fit_blocks(pages, html_col) if weights is None else weights
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                texts = [main_text(t or "", own) for t in part.column(2).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars bigint")
