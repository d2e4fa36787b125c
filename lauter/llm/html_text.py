"""Main text of web pages: boosted trees over DOM nodes, decoded down the tree.

1. A page is read into its block elements (inline markup belongs to the block around it).
   Head, scripts, styles and other unseen elements are not read.
2. Nodes have features: text of their own and below, density, links, depth, place among
   siblings and their likeness, and tokens (tag, class, id, role) of the node and of the
   nodes around it.
3. Pages carry no labels, so the trees learn from nodes that are clear by the HTML
   vocabulary: inside ``article`` or ``main``, or a long paragraph of prose, against
   inside ``nav``, ``footer``, an advert and the like. Every node is learned twice, the
   second time without its tokens, so that pages without telling names are judged by
   density. The sample is at most ``PAGES`` pages and ``NODES`` nodes, chosen by hash.
4. Decoding chooses the best labelling of the whole tree among those that agree with
   themselves: below a dropped node all is dropped; below a kept node all is kept, but for
   subtrees that are cut out at a price; a node that only leads to others gives no text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lauter.llm.common import text_or_empty, written

PAGES = 600
NODES = 20_000
TOKENS = 48
TREES = 30
DEPTH = 4
RATE = 0.3
BINS = 32
CUT = 2.0  # price of cutting a subtree out of kept text

# fixed values: the vocabulary of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style noscript template svg math iframe object canvas audio video".split())
# what may stand in a head; anything else ends it, as does text
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
FOREIGN = frozenset(("svg", "math"))
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td textarea tfoot th thead tr ul".split()
)
# an element ends when one of these begins, up to the boundary around it
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
INSIDE_P = frozenset("button option optgroup".split())

# names that pages give to what is not the article, and to what is
DROPPED_TAGS = frozenset("nav footer aside form button select menu dialog textarea".split())
DROPPED_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer "
    "menu modal nav navbar navigation newsletter notice pagination popup promo related search share sharing sidebar "
    "social sponsor sponsored subscribe toolbar widget".split()
)
DROPPED_ROLES = frozenset("navigation banner complementary contentinfo search dialog form".split())
KEPT_TAGS = frozenset(("article", "main"))
PROSE_WORDS = 25
PROSE_LINKS = 0.2


@dataclass
class Page:
    """Nodes in page order; node 0 is the root. A piece is a run of text of one node."""

    tag: list[str] = field(default_factory=lambda: ["#root"])
    up: list[int] = field(default_factory=lambda: [-1])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    links: list[int] = field(default_factory=lambda: [0])
    inline: list[int] = field(default_factory=lambda: [0])
    pieces: list[tuple[int, str]] = field(default_factory=list)


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.open = [0]
        self.unseen: list[str] = []
        self.link = False
        self.held: list[str] = []

    def flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                self.page.pieces.append((self.open[-1], text))
            self.held = []

    def close_to(self, depth: int) -> None:
        self.flush()
        del self.open[depth:]
        self.link = False

    def end_of(self, wanted, stop) -> None:
        """Closes the outermost open element of ``wanted`` above the nearest ``stop``."""
        found = 0
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.page.tag[self.open[depth]]
            if name in wanted:
                found = depth
            elif name in stop:
                break
        if found:
            self.close_to(found)

    def handle_starttag(self, tag, attrs):
        if self.unseen:
            if self.unseen == ["head"] and tag not in IN_HEAD or tag == "body" and self.unseen[0] == "head":
                self.unseen = []
            else:
                if tag == self.unseen[-1] or self.unseen == ["head"] and tag in UNSEEN:
                    self.unseen.append(tag)
                return
        if tag in UNSEEN:
            self.unseen.append(tag)
            return
        page = self.page
        if tag in ("br", "hr"):
            self.held.append(" ")
        if tag in VOID:
            return
        if tag not in BLOCK and "-" not in tag:
            page.inline[self.open[-1]] += 1
            if tag == "a":
                self.link = True
            return
        self.flush()
        if tag not in INSIDE_P and page.tag[self.open[-1]] == "p":
            self.close_to(len(self.open) - 1)
        if tag in ENDS:
            self.end_of(*ENDS[tag])
        given = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role", "itemprop")}
        names = [f"role={w}" for w in given.get("role", "").split()]
        names += [f"prop={w}" for w in given.get("itemprop", "").split()]
        for w in f"{given.get('class', '')} {given.get('id', '')}".replace("-", " ").replace("_", " ").split():
            names.append(w)
        if any(k == "hidden" for k, _ in attrs):
            names.append("hidden")
        page.up.append(self.open[-1])
        page.tag.append(tag)
        page.names.append(tuple(dict.fromkeys(names)))
        page.links.append(0)
        page.inline.append(0)
        self.open.append(len(page.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        # the slash means nothing in HTML but on void elements, svg and math
        before = len(self.unseen)
        self.handle_starttag(tag, attrs)
        if tag in FOREIGN and len(self.unseen) > before:
            self.unseen.pop()

    def handle_endtag(self, tag):
        if self.unseen:
            if tag == self.unseen[-1]:
                self.unseen.pop()
            elif tag in self.unseen and tag == "head":
                self.unseen = []
            return
        if tag == "a":
            self.link = False
        if tag in BLOCK or "-" in tag:
            for depth in range(len(self.open) - 1, 0, -1):
                if self.page.tag[self.open[depth]] == tag:
                    self.close_to(depth)
                    break

    def handle_data(self, data):
        if self.unseen == ["head"] and data.strip():
            self.unseen = []
        if not self.unseen:
            self.held.append(data)
            if self.link:
                self.page.links[self.open[-1]] += len(data)


def read_page(html: str) -> Page:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.page


# -- features -----------------------------------------------------------------

NUMBERS = 17


def tokens_of(page: Page) -> list[tuple[str, ...]]:
    return [(f"<{t}>", *n) for t, n in zip(page.tag, page.names, strict=True)]


def numbers_of(page: Page) -> np.ndarray:
    """The numeric features of each node."""
    n = len(page.tag)
    up = page.up
    own, own_words, ends = [0] * n, [0] * n, [0] * n
    for node, text in page.pieces:
        own[node] += len(text)
        own_words[node] += text.count(" ") + 1
        ends[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
    text, words, marks, links = own[:], own_words[:], ends[:], page.links[:]
    nodes = [1 + i for i in page.inline]
    depth, kids, alike, place = [0] * n, [0] * n, [0] * n, [0] * n
    same: dict[tuple[int, str], list[int]] = {}
    for i in range(1, n):
        depth[i] = depth[up[i]] + 1
        place[i] = kids[up[i]]
        kids[up[i]] += 1
        same.setdefault((up[i], page.tag[i]), []).append(i)
    for i in range(n - 1, 0, -1):
        p = up[i]
        text[p] += text[i]
        words[p] += words[i]
        marks[p] += marks[i]
        links[p] += links[i]
        nodes[p] += nodes[i]
    like = [0.0] * n
    for some in same.values():
        mean = sum(text[i] for i in some) / len(some)
        for i in some:
            alike[i] = len(some)
            like[i] = mean
    out = np.empty((n, NUMBERS), np.float32)
    t, w, m, k, c = (np.array(x, np.float64) for x in (text, words, marks, links, nodes))
    parent = np.maximum(np.array(up), 0)
    siblings = np.array(kids, np.float64)[parent]
    for j, column in enumerate((
        np.log1p(own), np.log1p(t), np.log1p(own_words), np.log1p(w), np.log1p(c), t / c, w / c,
        k / np.maximum(t, 1), m / np.maximum(w, 1), t / max(t[0], 1), t / np.maximum(t[parent], 1),
        np.array(depth, np.float64), np.log1p(siblings), np.array(place) / np.maximum(siblings, 1),
        np.array(alike) / np.maximum(siblings, 1), np.log1p(like), (k / np.maximum(t, 1))[parent],
    )):
        out[:, j] = column
    return out


def clear_labels(page: Page, numbers: np.ndarray) -> np.ndarray:
    """1 kept, 0 dropped, -1 not clear, by the nearest telling node around."""
    out = np.full(len(page.tag), -1, np.int8)
    prose = (numbers[:, 3] >= np.log1p(PROSE_WORDS)) & (numbers[:, 7] <= PROSE_LINKS)
    for i in range(1, len(page.tag)):
        tag, names = page.tag[i], page.names[i]
        around = out[page.up[i]]
        roles = {n[5:] for n in names if n.startswith("role=")}
        if tag in DROPPED_TAGS or "hidden" in names or not DROPPED_NAMES.isdisjoint(names) or not DROPPED_ROLES.isdisjoint(roles):
            out[i] = 0
        elif tag == "header" and around != 1:
            out[i] = 0
        elif around == 0:
            out[i] = 0
        elif around == 1 or tag in KEPT_TAGS or "main" in roles or "prop=articlebody" in names:
            out[i] = 1
        elif tag == "p" and prose[i]:
            out[i] = 1
    return out


def flags_of(page: Page, number: dict[str, int]) -> np.ndarray:
    """For each node which tokens it has, and which the nodes around it have."""
    size = len(number)
    out = np.zeros((len(page.tag), 2 * size), bool)
    for i, tokens in enumerate(tokens_of(page)):
        if i:
            out[i, size:] = out[page.up[i], size:] | out[page.up[i], :size]
        for t in tokens:
            if t in number:
                out[i, number[t]] = True
    return out


# -- boosted trees ------------------------------------------------------------


@dataclass
class Trees:
    """Additive trees of one depth; node ``i`` leads to ``2 i + 1`` (at most) and ``2 i + 2``."""

    base: float
    feature: np.ndarray  # tree, inner node
    least: np.ndarray
    leaf: np.ndarray  # tree, leaf

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, least, leaf in zip(self.feature, self.least, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > least[at])
            out += leaf[at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Gradient-boosted trees for the logistic loss, with splits at quantiles."""
    n, width = x.shape
    inner, calm = 2**depth - 1, 1.0
    share = (y.sum() + 1.0) / (n + 2.0)
    base = float(np.log(share / (1 - share)))
    features = np.zeros((trees, inner), np.int64)
    least = np.full((trees, inner), np.inf, np.float32)
    leaves = np.zeros((trees, inner + 1))
    if not n:
        return Trees(0.0, features[:0], least[:0], leaves[:0])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[:-1], method="lower")) for j in range(width)]
    useful = [j for j in range(width) if x[:, j].min() < x[:, j].max()]
    bins = {j: np.searchsorted(edges[j], x[:, j]) for j in useful}
    score = np.full(n, base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            here = at - first
            best = np.full(count, 1e-9)
            for j in useful:
                size = len(edges[j]) + 1
                cell = here * size + bins[j]
                left_g = np.bincount(cell, g, count * size).reshape(count, size).cumsum(1)
                left_h = np.bincount(cell, h, count * size).reshape(count, size).cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = left_g**2 / (left_h + calm) + (all_g - left_g) ** 2 / (all_h - left_h + calm) - all_g**2 / (all_h + calm)
                cut = gain[:, : len(edges[j])].argmax(1)
                found = gain[np.arange(count), cut]
                for k in np.flatnonzero(found > best):
                    best[k] = found[k]
                    features[tree, first + k] = j
                    least[tree, first + k] = edges[j][cut[k]]
            at = 2 * at + 1 + (x[np.arange(n), features[tree, at]] > least[tree, at])
        leaf = at - inner
        leaves[tree] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + calm)
        score += leaves[tree][leaf]
    return Trees(base, features, least, leaves)


# -- decoding -----------------------------------------------------------------

LEAD, DROP, KEEP = 0, 1, 2


def decode(up: list[int], logit: np.ndarray, weight: np.ndarray, cut: float = CUT) -> list[int]:
    """The best label per node: below DROP all is DROP, below KEEP all is KEEP or cut out."""
    n = len(up)
    gain = (logit * weight).tolist()
    # the best sum below a node for each of its labels; its own gain is added on the way up
    lead, drop, keep = [0.0] * n, [-g for g in gain], gain[:]
    for i in range(n - 1, 0, -1):
        p = up[i]
        drop[p] += drop[i]
        keep[p] += max(keep[i], drop[i] - cut)
        lead[p] += max(lead[i], drop[i], keep[i])
    label = [LEAD] * n
    for i in range(1, n):
        around = label[up[i]]
        if around == DROP:
            label[i] = DROP
        elif around == KEEP:
            label[i] = KEEP if keep[i] >= drop[i] - cut else DROP
        elif keep[i] >= drop[i] and keep[i] >= lead[i]:
            label[i] = KEEP
        else:
            label[i] = DROP if drop[i] >= lead[i] else LEAD
    return label


@dataclass
class Model:
    number: dict[str, int]
    trees: Trees

    def texts(self, pages: list[Page]) -> list[str]:
        """The main text of each page; one pass of the trees for all."""
        if not pages:
            return []
        numbers = [numbers_of(p) for p in pages]
        x = np.hstack([np.vstack(numbers), np.vstack([flags_of(p, self.number) for p in pages])])
        logit = self.trees.logit(x)
        out, start = [], 0
        for page, own in zip(pages, numbers, strict=True):
            stop = start + len(page.tag)
            # a node counts by its own text
            label = decode(page.up, logit[start:stop], 0.1 + own[:, 2].astype(float))
            label[0] = KEEP if logit[start] >= 0 else LEAD
            out.append(" ".join(t for i, t in page.pieces if label[i] == KEEP))
            start = stop
        return out


# -- jobs ---------------------------------------------------------------------


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", *, most_pages: int = PAGES, most_nodes: int = NODES) -> Model:
    """Trees from at most ``most_pages`` pages and ``most_nodes`` clear nodes of them.

    Without clear nodes every logit is 0, and all text that can be seen is kept.
    """
    order = F.xxhash64(F.col(id_col).cast("string"))
    chosen = pages.select(order.alias("__o")).distinct().orderBy("__o").limit(most_pages)
    named = pages.select(order.alias("__o"), text_or_empty(F.col(html_col)).alias("html"))
    # at most most_pages numbers
    sample = named.join(F.broadcast(chosen), "__o").groupBy("__o").agg(F.min("html").alias("html"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = read_page(html.as_py())
                numbers = numbers_of(page)
                labels = clear_labels(page, numbers)
                own = tokens_of(page)
                around: list[frozenset] = [frozenset()]
                for i in range(1, len(own)):
                    around.append(around[page.up[i]] | frozenset(own[page.up[i]]))
                some = np.flatnonzero(labels >= 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(some), pa.int64()), pa.array(some, pa.int32()), pa.array(labels[some], pa.int8()),
                        pa.array([own[i] for i in some], pa.list_(pa.string())),
                        pa.array([sorted(around[i]) for i in some], pa.list_(pa.string())),
                        pa.array(list(numbers[some]), pa.list_(pa.float32())),
                    ],
                    names=["k", "i", "y", "own", "around", "x"],
                )

    kind = "k long, i int, y tinyint, own array<string>, around array<string>, x array<float>"
    found = written(sample.mapInArrow(nodes, kind), "page-nodes")
    rows = found.orderBy(F.xxhash64("k", "i"), "k", "i").limit(most_nodes).collect()
    often = Counter(t for r in rows for t in r["own"])
    number = {t: i for i, (t, _) in enumerate(sorted(often.items(), key=lambda c: (-c[1], c[0]))[:TOKENS])}
    x = np.zeros((2 * len(rows), NUMBERS + 2 * len(number)), np.float32)
    for i, r in enumerate(rows):
        x[i, :NUMBERS] = r["x"]
        for t in r["own"]:
            if t in number:
                x[i, NUMBERS + number[t]] = 1
        for t in r["around"]:
            if t in number:
                x[i, NUMBERS + len(number) + number[t]] = 1
    x[len(rows) :, :NUMBERS] = x[: len(rows), :NUMBERS]
    y = np.tile(np.array([r["y"] for r in rows], float), 2)
    return Model(number, boost(x, y))


_TOGETHER = 4_000_000  # characters of html for one pass of the trees


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url", **options) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per input row.

    Null and empty html give empty text. Repeated rows give the same text. Only the three
    named columns are read. An empty table gives no rows.
    """
    sent = pages.sparkSession.sparkContext.broadcast(fit(pages, id_col, html_col, **options))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts: list[str] = []
            held: list[Page] = []
            size = 0
            for html in batch.column(2):
                html = html.as_py() or ""
                held.append(read_page(html))
                size += len(html)
                if size >= _TOGETHER:
                    texts += model.texts(held)
                    held, size = [], 0
            texts += model.texts(held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    plain = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return plain.mapInArrow(make, f"page_id {plain.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
