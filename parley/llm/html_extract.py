"""HTML extraction: boosted trees over DOM-node features, with hierarchical decoding."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.boosting import BoostedTrees
from parley.llm.common import slices

#: Comments, declarations, tags; a quote counts after an equals sign, and if it is closed; a tag cut off by the page's end.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*(?>"[^"]*"|'[^']*')?)*+)>|</?[a-zA-Z][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

# Element names of HTML, by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Of these, the ones that hold the rest of the page if they are not closed.
SWALLOWS = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "html body article section nav aside header footer main div p ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption form fieldset details summary address center hr dialog menu hgroup".split()
)
#: Elements whose text is never shown as running text.
HIDDEN = frozenset("head script style textarea title noscript template iframe object svg math select option button input xmp noembed noframes".split())
#: An element of the key closes an open one of these, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_P_CLOSERS = BLOCK - {"html", "body", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption"}
_P_LIMITS = frozenset("td th table li div article section aside nav main header footer blockquote body html form fieldset figure dd dt".split())

# What the words in class, id and role attributes speak for.
CONTENT_WORDS = frozenset("article content post entry story body main text blog news prose page hentry articlebody markdown".split())
CHROME_WORDS = frozenset(
    "nav navbar navigation menu sidebar side footer foot header head masthead banner ad ads advert advertisement adsense sponsor sponsored promo"
    " promotion cookie cookies consent gdpr notice alert popup modal overlay comment comments reply replies respond discussion disqus share"
    " sharing social related recommended more widget breadcrumb breadcrumbs pagination pager search subscribe newsletter signup login form"
    " toolbar copyright legal tags tag meta byline author toc skip complementary contentinfo dialog rail teaser outbrain taboola".split()
)
TAG_GROUPS = ("article main", "section", "div", "p blockquote pre", "h1 h2 h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "nav", "aside", "header", "footer", "form fieldset", "table tr td th tbody", "figure figcaption", "#text", "body html")
_GROUP = {t: i for i, g in enumerate(TAG_GROUPS) for t in g.split()}


class Node:
    __slots__ = ("tag", "up", "kids", "text", "attrs", "link", "chars", "linked", "nodes", "paras", "stops", "index", "depth", "blockish")

    def __init__(self, tag: str, up: Node | None, attrs: str = "", text: str = ""):
        self.tag, self.up, self.attrs, self.text = tag, up, attrs, text
        self.kids: list[Node] = []
        self.index = len(up.kids) if up is not None else 0
        self.depth = up.depth + 1 if up is not None else 0
        self.link = tag == "a" or (up is not None and up.link)
        if up is not None:
            up.kids.append(self)


def parse(page: str) -> Node:
    """A forgiving tree: end tags without a start are skipped, open elements end with their parents or the page."""
    root = Node("#root", None)
    at = root
    position, n = 0, len(page)
    while position < n:
        m = _TOKEN.search(page, position)
        end = m.start() if m else n
        if end > position:
            text = page[position:end]
            Node("#text", at, text=entities.unescape(text) if "&" in text else text)
        if m is None:
            break
        position = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            node = at
            while node is not root and node.tag != tag:
                if tag not in BLOCK and node.tag in BLOCK:
                    node = root  # an inline end tag does not close blocks
                    break
                node = node.up
            if node is not root:
                at = node.up
            continue
        if tag in _P_CLOSERS:
            node = at
            while node is not root and node.tag not in _P_LIMITS and node.tag != "p":
                node = node.up
            if node.tag == "p":
                at = node.up
        if tag in CLOSES:
            own, limits = CLOSES[tag]
            node, found = at, None
            while node is not root and node.tag not in limits:
                if node.tag in own:
                    found = node
                node = node.up
            if found is not None:
                at = found.up
        node = Node(tag, at, m[3])
        closed = m[3].rstrip().endswith("/")
        if tag in RAW and not (closed and tag not in SWALLOWS):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, position)
            if close or tag in SWALLOWS:
                Node("#text", node, text=page[position : close.start() if close else n])
                position = close.end() if close else n
        elif tag not in VOID and tag not in RAW and not closed:
            at = node
    return root


def _measure(node: Node) -> None:
    """Sizes of each subtree, without recursion. ``blockish``: it or a part of it is a block."""
    order, stack = [], [node]
    while stack:
        x = stack.pop()
        order.append(x)
        stack += x.kids
    for x in reversed(order):
        if x.tag == "#text":
            x.chars = len(" ".join(x.text.split()))
            x.linked = x.chars if x.link else 0
            x.nodes = x.paras = 0
            x.stops = sum(map(x.text.count, ".!?,;"))
            x.blockish = False
        elif x.tag in HIDDEN:
            x.chars = x.linked = x.nodes = x.paras = x.stops = 0
            x.blockish = x.tag == "head"
        else:
            x.chars = sum(k.chars for k in x.kids)
            x.linked = sum(k.linked for k in x.kids)
            x.nodes = 1 + sum(k.nodes for k in x.kids)
            x.paras = (x.tag == "p") + sum(k.paras for k in x.kids)
            x.stops = sum(k.stops for k in x.kids)
            x.blockish = x.tag in BLOCK or any(k.blockish for k in x.kids)


class Unit:
    """A node that is decided on: a block, or a run of inline nodes between blocks (kids: none, parts: the nodes)."""

    __slots__ = ("node", "kids", "parts", "row", "p")

    def __init__(self, node: Node, parts: list[Node] | None = None):
        self.node, self.parts, self.kids = node, parts, []


def units(root: Node) -> Unit:
    """The tree of units. Subtrees without text are left out."""
    _measure(root)
    top = Unit(root)
    stack = [top]
    while stack:
        u = stack.pop()
        run: list[Node] = []
        for k in [*u.node.kids, None]:
            if k is not None and not k.blockish and k.tag not in ("br", "hr"):
                if k.tag not in HIDDEN:
                    run.append(k)
                continue
            if run and any(x.chars for x in run):
                u.kids.append(Unit(u.node, run))
            run = []
            if k is not None and k.blockish and k.chars:
                child = Unit(k)
                u.kids.append(child)
                stack.append(child)
    return top


def _attribute_score(attrs: str) -> tuple[int, int]:
    if not attrs or "=" not in attrs:
        return 0, 0
    words = [w for m in _ATTRIBUTE.finditer(attrs) for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", m[2] or m[3] or m[4] or "").lower()) if w]
    return sum(w in CONTENT_WORDS for w in words), sum(w in CHROME_WORDS for w in words)


CHROME_TAGS = frozenset("nav aside footer form dialog menu".split())


def features(top: Unit, total: int) -> tuple[list[Unit], np.ndarray]:
    """Rows in document order; the first is the page."""
    flat: list[Unit] = []
    rows: list[list[float]] = []
    groups: list[int] = []
    # (unit, depth, content words above, chrome words above, in a main element, in a chrome element, group of parent, place, siblings, share of siblings' text)
    stack = [(top, 0, 0, 0, 0, 0, len(TAG_GROUPS), 0, 1, 1.0, 0)]
    total = max(1, total)
    before = 0
    while stack:
        u, depth, good, bad, inside, chrome, parent, place, siblings, share, same = stack.pop()
        node = u.node
        if u.parts is None:
            tag, chars, linked, nodes, paras, stops = node.tag, node.chars, node.linked, node.nodes, node.paras, node.stops
            own_good, own_bad = _attribute_score(node.attrs)
        else:
            tag = "#text"
            chars, linked = sum(x.chars for x in u.parts), sum(x.linked for x in u.parts)
            nodes, paras, stops, own_good, own_bad = sum(x.nodes for x in u.parts), 0, sum(x.stops for x in u.parts), 0, 0
        group = _GROUP.get(tag, len(TAG_GROUPS))
        groups.append(group)
        rows.append([
            depth, math.log1p(chars), chars / total, linked / max(1, chars), math.log1p(nodes), nodes / (1 + chars) * 100, paras / (1 + nodes), stops / (1 + chars) * 100,
            own_good, own_bad, good, bad, inside, chrome, share, place / max(1, siblings), before / total,
        ])
        u.row = len(flat)
        flat.append(u)
        if not u.kids:
            before += chars
        inside += tag in ("article", "main")
        chrome += tag in CHROME_TAGS or (tag in ("header",) and not inside)
        sizes = [k.node.chars if k.parts is None else sum(x.chars for x in k.parts) for k in u.kids]
        whole = max(1, sum(sizes))
        for i in range(len(u.kids) - 1, -1, -1):
            stack.append((u.kids[i], depth + 1, good + own_good, bad + own_bad, inside, chrome, group, i, len(u.kids), sizes[i] / whole, 0))
    return flat, np.column_stack([np.eye(len(TAG_GROUPS) + 1)[groups], np.array(rows, np.float64)])


def decode(top: Unit, flat: list[Unit], p: np.ndarray) -> list[Unit]:
    """The kept leaf units, in order. Each unit is kept whole, dropped whole or mixed; what is below a kept (dropped)
    unit is kept (dropped), so no node contradicts an ancestor. The choice with the greatest likelihood is taken."""
    p = np.clip(p, 1e-4, 1 - 1e-4)
    # a node speaks with the logarithm of its text, so that one long block weighs more than many short ones
    sizes = np.array([u.node.chars if u.parts is None else sum(x.chars for x in u.parts) for u in flat], float)
    weight = np.log1p(sizes)
    keep, drop = weight * np.log(p), weight * np.log(1 - p)
    mixed = np.zeros(len(flat))
    for u in reversed(flat):
        i = u.row
        if u.kids:
            rows = [k.row for k in u.kids]
            mixed[i] = sum(max(keep[r], drop[r], mixed[r] if flat[r].kids else -np.inf) for r in rows) + min(0.0, np.log(1 - abs(2 * p[i] - 1) * 0.5)) * weight[i] * 0.2
            keep[i] += keep[rows].sum()
            drop[i] += drop[rows].sum()
    out, stack = [], [(top, None)]
    while stack:
        u, state = stack.pop()
        i = u.row
        if state is None:
            best = max((keep[i], 1), (drop[i], 0), (mixed[i] if u.kids else -np.inf, 2))[1]
            state = {1: True, 0: False, 2: None}[best]
        if state is False:
            continue
        if u.kids:
            stack += [(k, state) for k in reversed(u.kids)]
        else:
            out.append(u)
    return out


def _inline_text(parts: list[Node]) -> str:
    out, stack = [], list(reversed(parts))
    while stack:
        x = stack.pop()
        if x.tag == "#text":
            out.append(x.text)
        elif x.tag == "br":
            out.append(" ")
        elif x.tag not in HIDDEN:
            stack += reversed(x.kids)
    return " ".join("".join(out).split())


def extract_all(pages: list[str | None], model: BoostedTrees) -> list[str]:
    """The main texts: the kept blocks in page order, white space inside a block made one space, joined by one space."""
    out, tops, rows = [""] * len(pages), [], []
    for i, page in enumerate(pages):
        if page and (top := units(parse(page))).kids:
            flat, x = features(top, top.node.chars)
            tops.append((i, top, flat))
            rows.append(x)
    if not rows:
        return out
    p, at = model.probability(np.concatenate(rows)), 0
    for i, top, flat in tops:
        kept = decode(top, flat, p[at : at + len(flat)])
        at += len(flat)
        out[i] = " ".join(t for u in kept if u.parts is not None and (t := _inline_text(u.parts)))
    return out


def extract(page: str | None, model: BoostedTrees) -> str:
    return extract_all([page], model)[0]


# --- training pages -------------------------------------------------------------------------------------------------


def _text(rng, low: int, high: int) -> str:
    words = ["".join(rng.choice(list("bcdfglmnprstvaeiou"), rng.integers(2, 9))) for _ in range(rng.integers(low, high + 1))]
    for i in range(0, len(words), int(rng.integers(6, 15))):
        words[i] = words[i].capitalize()
        if i:
            words[i - 1] += rng.choice([".", ".", "?", ","])
    return " ".join(words) + "."


def training_page(rng) -> str:
    """A page of random layout; elements with main text carry data-main="1", those with other text data-main="0"."""
    pick = lambda *xs: xs[rng.integers(len(xs))]
    links = lambda n: "".join(f'<li data-main="0"><a href="/x">{_text(rng, 1, 3)}</a></li>' for _ in range(n))

    def chrome(kind: str) -> str:
        n = int(rng.integers(2, 9))
        cls = lambda *xs: f' {pick("class", "id")}="{pick(*xs)}"' if rng.random() < 0.75 else ""
        if kind == "menu":
            tag = pick("nav", "nav", "div")
            return f'<{tag}{cls("menu", "nav", "navbar", "main-menu", "breadcrumbs") if tag == "nav" else f" class={chr(34)}{pick("menu", "navigation", "nav-bar")}{chr(34)}"} data-main="0"><ul data-main="0">{links(n)}</ul></{tag}>'
        if kind == "header":
            return f'<header{cls("site-header", "masthead", "top")} data-main="0"><div data-main="0">{_text(rng, 1, 6)}</div>{chrome("menu") if rng.random() < 0.4 else ""}</header>'
        if kind == "footer":
            tag = pick("footer", "footer", "div")
            name = cls("footer", "site-footer", "copyright") if tag == "footer" else ' class="footer"'
            return f'<{tag}{name} data-main="0">{pick("&copy; ", "")}{_text(rng, 2, 25)}{f"<p data-main={chr(34)}0{chr(34)}>{_text(rng, 4, 30)}</p>" if rng.random() < 0.4 else ""}</{tag}>'
        if kind == "ad":
            return f'<{pick("div", "div", "aside", "section")} class="{pick("ad", "ads", "advert", "ad-banner", "sponsored", "promo")}" data-main="0">{pick("", f"<p data-main={chr(34)}0{chr(34)}>{_text(rng, 4, 40)}</p>")}{_text(rng, 3, 60)}</{"div"}>'
        if kind == "side":
            tag = pick("aside", "aside", "div")
            name = cls("sidebar", "related", "widget") if tag == "aside" else f' class="{pick("sidebar", "related-posts", "widget", "side")}"'
            return f'<{tag}{name} data-main="0"><h3 data-main="0">{_text(rng, 1, 4)}</h3>{pick(f"<ul data-main={chr(34)}0{chr(34)}>{links(n)}</ul>", f"<p data-main={chr(34)}0{chr(34)}>{_text(rng, 8, 60)}</p>")}</{tag}>'
        if kind == "notice":
            return f'<{pick("div", "section", "p")} {pick("class", "id")}="{pick("cookie-notice", "cookie-banner", "notice", "consent", "alert", "popup", "newsletter")}" data-main="0">{_text(rng, 4, 35)}</{"div"}>'
        if kind == "form":
            return f'<form data-main="0"><label data-main="0">{_text(rng, 1, 5)}</label><input name="q"><p data-main="0">{_text(rng, 3, 15)}</p><button>{_text(rng, 1, 2)}</button></form>'
        body = "".join(f'<{(t := pick("li", "div"))} class="{pick("comment", "reply", "comment-body")}" data-main="0"><p data-main="0">{_text(rng, 5, 60)}</p></{t}>' for _ in range(n))
        return f'<{(t := pick("section", "div"))} {pick("class", "id")}="{pick("comments", "comment-list", "discussion", "respond")}" data-main="0"><h3 data-main="0">{_text(rng, 1, 3)}</h3>{body}</{t}>'

    def article() -> str:
        blocks = [f'<h1 data-main="1">{_text(rng, 2, 10)}</h1>'] if rng.random() < 0.85 else []
        for _ in range(int(rng.integers(1, 14))):
            r = rng.random()
            if r < 0.75:
                inner = _text(rng, 3, 110)
                if rng.random() < 0.25:
                    inner = f'{_text(rng, 1, 20)} <{(t := pick("b", "em", "a", "span"))}>{_text(rng, 1, 5)}</{t}> {inner}'
                blocks.append(f'<p data-main="1">{pick("", "", "", "<b>")}{inner}{pick("</p>", "</p>", "</p>", "", "<br>")}')
            elif r < 0.83:
                blocks.append(f'<h2 data-main="1">{_text(rng, 1, 8)}</h2>')
            elif r < 0.9:
                items = "".join(f'<li data-main="1">{_text(rng, 2, 25)}</li>' for _ in range(int(rng.integers(2, 7))))
                blocks.append(f'<ul data-main="1">{items}</ul>')
            elif r < 0.93:
                blocks.append(f'<blockquote data-main="1">{_text(rng, 5, 40)}</blockquote>')
            elif r < 0.95:
                cells = "".join(f'<tr data-main="1"><td data-main="1">{_text(rng, 1, 4)}</td><td data-main="1">{_text(rng, 1, 4)}</td></tr>' for _ in range(3))
                blocks.append(f'<table data-main="1">{cells}</table>')
            else:
                blocks.append(chrome(pick("ad", "ad", "side", "notice", "form")))
        tag = pick("article", "article", "article", "main", "div", "section")
        name = f' {pick("class", "id")}="{pick("content", "post", "article-body", "entry-content", "story", "main")}"' if tag in ("div", "section") or rng.random() < 0.3 else ""
        return f'<{tag}{name} data-main="1">{"".join(blocks)}</{tag}>'

    parts = [chrome(k) for k in ("header", "menu", "notice", "ad") if rng.random() < 0.55]
    middle = article()
    if rng.random() < 0.35:
        t = pick("main", "div")
        middle = f'<{t}{pick("", " id=" + chr(34) + "page" + chr(34), " class=" + chr(34) + "container" + chr(34))} data-main="2">{chrome("side") if rng.random() < 0.3 else ""}{middle}{chrome(pick("side", "comments", "ad", "form")) if rng.random() < 0.6 else ""}</{t}>'
    tail = [chrome(k) for k in ("comments", "side", "ad", "form", "footer") if rng.random() < (0.75 if k == "footer" else 0.35)]
    return f'<!DOCTYPE html><html><head><title>{_text(rng, 2, 8)}</title><style>p{{margin:0}}</style></head><body>{"".join(parts)}{middle}{"".join(tail)}</body></html>'


_MAIN = re.compile(r'data-main="(\d)"')


def labelled_rows(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the units of training pages; mixed containers have no label and are left out."""
    xs, ys = [], []
    for page in pages:
        root = parse(page)
        top = units(root)
        flat, x = features(top, root.chars)
        labels = np.full(len(flat), -1)
        for u in flat:
            node = u.node
            while node is not None and not (m := _MAIN.search(node.attrs)):
                node = node.up
            if node is not None:
                labels[u.row] = int(m[1])
        # an element that holds text of both kinds is mixed
        for u in reversed(flat):
            if u.kids and len({labels[k.row] for k in u.kids}) > 1:
                labels[u.row] = 2
        own = (labels == 0) | (labels == 1)
        xs.append(x[own])
        ys.append(labels[own])
    return np.concatenate(xs), np.concatenate(ys)


@lru_cache(maxsize=4)
def trained(pages: int = 400, trees: int = 60, seed: int = 11) -> BoostedTrees:
    """The model, fitted on generated pages; the same in every process."""
    rng = np.random.default_rng(seed)
    return BoostedTrees(trees).fit(*labelled_rows([training_page(rng) for _ in range(pages)]))


def main_text(page: Column, model: BoostedTrees | None = None) -> Column:
    """string: the main text of each whole page; empty for a null."""
    model = model or trained()

    @F.arrow_udf("string")
    def main(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([t for pages in slices(part, 1 << 20) for t in extract_all(pages, model)], pa.string())

    return main(page)


def extract_pages(pages: DataFrame, model: BoostedTrees | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points).

    Null and empty pages give an empty text; repeated rows give repeated results; other columns are not looked at; an
    empty table gives an empty result. A narrow map: no shuffle.
    """
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), main_text(F.col(html_col), model).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
