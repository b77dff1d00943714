"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree: its elements, and as leaves its blocks of text. Every
node is content or not. Node potentials come from features of the node, edge
potentials couple each child with its parent, by kind of child. Sum-product
messages, upward and then downward, give each node's exact probability; blocks
of one half or more are the text.

The model is trained on pages whose markup says what it means: what lies in an
article or main element and in no element meant for other things is content,
the rest of such a page is not. At most `MOST_PAGES`, picked by hash, come to
the driver, as feature rows. The penalty pulls weights towards what tags and
class names usually mean, so a page without an article is read sensibly, too.

Scripts, styles, comments and the head have no text. Character references are
decoded; white space within a block becomes one space; blocks follow in page
order, parted by a newline. A null page counts as empty and gives empty text.
Broken markup is read as browsers do: ends that are missing are implied, a tag
that never ends takes the rest of the page with it. Rows that repeat a page give
equal rows; a null page_id is carried along. Time grows with the length of the
page, and with its nesting.
"""

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_PAGES, MOST_NODES, STEPS = 400, 60_000, 150
# A quote opens a value only right after "="; elsewhere it is part of a name or of a bare value.
_ATTRIBUTE = r"""[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)?+)?+"""
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=|{_ATTRIBUTE})*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_RAW_END = {t: re.compile(r"</" + t + r"\s*>", re.I) for t in ("script", "style", "textarea", "title", "template", "noscript")}
_NAMES = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

# What HTML says about elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
    small span strike strong sub sup time tt u var br wbr img""".split())
NO_TEXT = frozenset("script style template noscript svg iframe object select textarea button head title canvas audio video math".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl body html div section article aside main nav form td th".split())

# What names of classes and roles usually mean.
OTHER = re.compile(r"""\b(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|alert|popup|modal|comments?|reply|
    replies|respond|discussion|sidebar|side|aside|menu|nav\w*|breadcrumbs?|footer|foot|header|masthead|share|social|related|
    recommend\w*|newsletter|subscribe|signup|login|search|widget|toolbar|pagination|tags|copyright|disclaimer)\b""", re.I | re.X)
MAIN = re.compile(r"\b(?:article\w*|main|content|post|entry|story|text|body|articlebody)\b", re.I)

KINDS = ("text", "p", "div", "section", "article", "main", "h1", "h2", "h3", "li", "ul", "ol", "nav", "header", "footer", "aside",
         "form", "table", "tr", "td", "blockquote", "pre", "figure", "figcaption", "body", "html", "a", "other")
# What the penalty pulls weights to, by feature.
USUAL = {"nav": -4.0, "header": -2.0, "footer": -4.0, "aside": -4.0, "form": -4.0, "article": 3.0, "main": 3.0, "p": 0.5,
         "named_other": -4.0, "named_main": 1.5, "links": -2.0, "long": 0.5}
EXTRAS = ("named_other", "named_main", "links", "long", "marks", "depth", "bias")
NAMES = (*KINDS, *EXTRAS)
_KIND = {k: i for i, k in enumerate(KINDS)}
_EXTRA = {k: len(KINDS) + i for i, k in enumerate(EXTRAS)}
_STRONG = frozenset(("nav", "footer", "aside", "form"))


@dataclass
class Page:
    """Nodes in document order: a parent comes before its children."""
    parent: list[int]
    kind: list[int]
    named: list[int]  # -1 other, 1 main, 0 neither
    text: list[str | None]  # of blocks
    linked: list[int]  # characters within links, of blocks
    depth: list[int]


def parse(source: str) -> Page:
    page = Page([-1], [_KIND["html"]], [0], [None], [0], [0])
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements and their nodes; inline elements share their parent's
    buffer: list[str] = []
    linked, links, silent = 0, 0, 0
    opened: Counter[str] = Counter()  # so that an end without a beginning costs nothing

    def node(kind: str, named: int, text: str | None, chars: int) -> int:
        owner = stack[-1][1]
        page.parent.append(owner)
        page.kind.append(_KIND.get(kind, _KIND["other"]))
        page.named.append(named)
        page.text.append(text)
        page.linked.append(chars)
        page.depth.append(page.depth[owner] + 1)
        return len(page.parent) - 1

    def flush() -> None:
        nonlocal linked
        if buffer:
            raw = "".join(buffer)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                node("text", 0, text, min(linked, len(text)))
            buffer.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal links, silent
        while len(stack) > upto:
            tag = stack[-1][0]
            if tag not in INLINE:
                flush()
            links -= tag == "a"
            silent -= tag in NO_TEXT
            opened[tag] -= 1
            stack.pop()

    at = 0
    while True:
        m = _TAG.search(source, at)
        piece = source[at:m.start() if m else len(source)]
        if piece and not silent:
            buffer.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                if stack[k][0] == tag:
                    close(k)
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE and not silent:
            flush()
        if tag in ("html", "body") and any(t == tag for t, _ in stack):
            continue
        if tag in _RAW_END:
            end = _RAW_END[tag].search(source, at)
            at = end.end() if end else len(source)
            continue
        if tag not in INLINE:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p" or stack[k][0] in CLOSES.get(tag, ()) or tag == "body" and stack[k][0] == "head":
                    close(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        if tag in INLINE:
            stack.append((tag, stack[-1][1]))
        else:
            names = " ".join(_NAMES.findall(m[3])) if "=" in m[3] else ""
            named = -1 if names and OTHER.search(names) else 1 if names and MAIN.search(names) else 0
            stack.append((tag, node(tag, named, None, 0)))
        links += tag == "a"
        silent += tag in NO_TEXT
        opened[tag] += 1
    close(1)
    flush()
    return page


def by_depth(depth: np.ndarray) -> list[np.ndarray]:
    """The nodes of each depth, in order."""
    return np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1])


def feature_rows(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, parent, depth, is_block) of all nodes of all pages, one page after another."""
    sizes = np.array([len(p.parent) for p in pages], np.int64)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    parent = np.concatenate([np.array(p.parent, np.int64) for p in pages])
    parent = np.where(parent < 0, -1, parent + starts)
    kind = np.concatenate([np.array(p.kind) for p in pages])
    named = np.concatenate([np.array(p.named) for p in pages])
    depth = np.concatenate([np.array(p.depth) for p in pages])
    chars = np.array([len(t) if t is not None else 0 for p in pages for t in p.text], np.float64)
    linked = np.concatenate([np.array(p.linked, np.float64) for p in pages])
    marks = np.array([t.count(".") + t.count(",") if t is not None else 0 for p in pages for t in p.text], np.float64)
    is_block = np.array([t is not None for p in pages for t in p.text])
    for level in reversed(by_depth(depth)[1:]):  # sums over what lies below
        for total in (chars, linked, marks):
            np.add.at(total, parent[level], total[level])
    x = np.zeros((len(parent), len(NAMES)))
    x[np.arange(len(parent)), kind] = 1
    x[:, _EXTRA["named_other"]], x[:, _EXTRA["named_main"]] = named == -1, named == 1
    x[:, _EXTRA["links"]] = linked / np.maximum(chars, 1)
    x[:, _EXTRA["long"]] = np.minimum(np.log1p(chars) / 5, 2) - 1
    x[:, _EXTRA["marks"]] = np.minimum(10 * marks / np.maximum(chars, 1), 1)
    x[:, _EXTRA["depth"]] = depth / 10
    x[:, _EXTRA["bias"]] = 1
    return x, parent, depth, is_block


@dataclass
class Model:
    """Weights of the node features, and log potentials of (child, parent) states.

    Edges differ by kind of child, and by whether the parent is the body: its
    children are judged for themselves, others hardly leave their parent.
    """
    weights: np.ndarray
    edges: np.ndarray  # 2 * kinds x 2 x 2, [child state][parent state]


def usual_model() -> Model:
    weights = np.array([USUAL.get(n, 0.0) for n in NAMES])
    edges = np.zeros((2 * len(KINDS), 2, 2))
    edges[:len(KINDS), 0, 0] = edges[:len(KINDS), 1, 1] = 1.0
    edges[:len(KINDS), 1, 0] = -8.0
    edges[[_KIND["article"], _KIND["main"]], 1, 0] = 0.0
    return Model(weights, edges)


def edge_kinds(x: np.ndarray, parent: np.ndarray) -> np.ndarray:
    kind = x[:, :len(KINDS)].argmax(1)
    top = np.isin(kind[parent], [_KIND["html"], _KIND["body"]]) | (parent < 0)
    return kind + len(KINDS) * top


def marginals(model: Model, x: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of every node, and the joint of each node with its parent, by sum-product in log space."""
    own = np.stack([np.zeros(len(x)), x @ model.weights], axis=1)
    pair = model.edges[edge_kinds(x, parent)]
    up, below = np.zeros((len(x), 2)), own.copy()
    levels = by_depth(depth)
    for level in reversed(levels[1:]):
        up[level] = np.logaddexp(below[level, 0, None] + pair[level, 0], below[level, 1, None] + pair[level, 1])
        np.add.at(below, parent[level], up[level])
    belief = below.copy()
    joint = np.zeros((len(x), 2, 2))
    for level in levels[1:]:
        rest = belief[parent[level]] - up[level]
        joint[level] = below[level, :, None] + pair[level] + rest[:, None, :]
        belief[level] = below[level] + np.logaddexp(pair[level, :, 0] + rest[:, 0, None], pair[level, :, 1] + rest[:, 1, None])
    top = belief.max(1, keepdims=True)
    p = np.exp(belief - top)
    joint = np.exp(joint - joint.max((1, 2), keepdims=True))
    return (p[:, 1] / p.sum(1)), joint / joint.sum((1, 2), keepdims=True)


def markup_labels(page: Page) -> list[int] | None:
    """Content or not, as the markup says; None if the page has no article or main element."""
    inside, barred, out = [False], [False], [0]
    for k in range(1, len(page.parent)):
        kind, above = KINDS[page.kind[k]], page.parent[k]
        inside.append(inside[above] or kind in ("article", "main"))
        barred.append(barred[above] or kind in _STRONG or page.named[k] == -1)
        out.append(int(inside[k] and not barred[k]))
    return out if any(out) else None


def fit(x, parent, depth, truth, steps: int = STEPS) -> Model:
    """Penalised maximum likelihood with Adam; the gradient is what is seen less what the marginals expect."""
    start = usual_model()
    model = Model(start.weights.copy(), start.edges.copy())
    kind = edge_kinds(x, parent)
    linked = parent >= 0
    seen = np.zeros_like(model.edges)
    np.add.at(seen, (kind[linked], truth[linked], truth[parent[linked]]), 1.0)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.edges)]
    for step in range(1, steps + 1):
        p, joint = marginals(model, x, parent, depth)
        expected = np.zeros_like(model.edges)
        np.add.at(expected, kind[linked], joint[linked])
        grads = [x.T @ (truth - p) - (model.weights - start.weights), seen - expected - (model.edges - start.edges)]
        for part, grad, m in zip((model.weights, model.edges), grads, moments):
            m[0], m[1] = 0.9 * m[0] + 0.1 * grad, 0.99 * m[1] + 0.01 * grad ** 2
            part += 0.05 * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
    return model


def train(pages: DataFrame, most_pages: int = MOST_PAGES, most_nodes: int = MOST_NODES) -> Model:
    """Fit on at most `most_pages` pages with telling markup, or fall back on what markup usually means."""
    some = pages.filter(F.regexp_like("html", F.lit("(?i)<(article|main)[ >]"))).select("page_id", "html").orderBy(
        F.xxhash64("page_id"), "page_id").limit(most_pages)

    def described(batches):
        for batch in batches:
            rows = []
            for page_id, source in zip(batch["page_id"], batch["html"]):
                page = parse(source)
                labels = markup_labels(page)
                if labels is not None and len(labels) <= most_nodes // 20:
                    x, parent, depth, _ = feature_rows([page])
                    rows.append((page_id, x.astype(np.float32).tobytes(), parent.tolist(), depth.tolist(), labels))
            yield pd.DataFrame(rows, columns=["page_id", "x", "parent", "depth", "truth"])

    found = some.mapInPandas(described, "page_id long, x binary, parent array<long>, depth array<long>, truth array<int>")
    rows = found.orderBy("page_id").toPandas()
    if not len(rows):
        return usual_model()
    x, parent, depth, truth, at = [], [], [], [], 0
    for row in rows.itertuples():
        if at + len(row.parent) > most_nodes and at:
            break
        above = np.array(row.parent)
        x.append(np.frombuffer(row.x, np.float32).reshape(len(above), -1).astype(np.float64))
        parent.append(np.where(above < 0, -1, above + at))
        depth.append(np.array(row.depth))
        truth.append(np.array(row.truth))
        at += len(above)
    return fit(np.concatenate(x), np.concatenate(parent), np.concatenate(depth), np.concatenate(truth))


def extract(sources: list[str], model: Model) -> list[str]:
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    x, parent, depth, is_block = feature_rows(pages)
    p, _ = marginals(model, x, parent, depth)
    keep, out, at = (p >= 0.5) & is_block, [], 0
    for page in pages:
        size = len(page.parent)
        out.append("\n".join(page.text[k] for k in np.flatnonzero(keep[at:at + size])))
        at += size
    return out


def extractor(model: Model):
    """A column function from html to text."""
    @F.pandas_udf("string")
    def main_text(sources: pd.Series) -> pd.Series:
        return pd.Series([t for k in range(0, len(sources), 200) for t in extract(sources.iloc[k:k + 200].tolist(), model)],
                         dtype=object)

    return main_text


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    source: Column = F.coalesce("html", F.lit(""))
    text = extractor(train(pages))(source)
    return pages.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
