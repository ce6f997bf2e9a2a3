"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A tolerant reader turns the markup into elements (it closes what the HTML rules let open, and
bears truncated pages).  Every element is described by its tag, its attribute tokens, its depth, the
density of text, links and tags in its subtree, its place among its siblings, and the same for its
parents.  Boosted trees give each element the log odds of belonging to the article.  Decoding keeps
the set of elements with the largest sum of log odds in which no element is kept below a dropped one,
so that ancestors and descendants never contradict each other.

There are no labels for pages, so the trees learn from a bounded sample of the pages themselves:
elements whose meaning the markup states (``article``, ``nav``, ``footer`` ...) are the teacher, and each
sample page is also rewritten - tags and classes exchanged or removed, sidebars, notices, forms and
reader comments put in from the text of other sample pages - so that the trees must do without any
single sign."""

from __future__ import annotations

import html
import re
import warnings
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, smallest_hashes

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|style|hidden|aria-label)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe select datalist annotation annotation-xml desc metadata".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike "
                   "strong sub sup time tt u var object picture "
                   "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mspace msub msup msubsup munder mover munderover "
                   "mmultiscripts mprescripts none mtable mtr mtd mlabeledtr maction menclose semantics "
                   "svg g text tspan textpath path rect circle ellipse line polyline polygon use defs symbol".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hgroup hr main menu nav ol p pre search section table ul".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
               "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
BARRIER = frozenset("ul ol dl table article section div body html main aside nav footer header form".split())
# Tokens of class, id and role that name the parts of a page.
CONTENT_TOKENS = frozenset("article articlebody body content entry main post story text".split())
OTHER_TOKENS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination tabs toc skip",
    "frame": "header head masthead banner footer foot bottom copyright colophon legal topbar",
    "side": "sidebar side aside widget related recommended popular trending rail",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion adsense",
    "notice": "cookie cookies consent notice notification alert popup modal overlay newsletter subscribe subscription gdpr privacy",
    "form": "form search login signup contact",
    "comment": "comment comments reply replies discussion disqus respond feedback",
    "share": "share sharing social follow tags meta byline author print",
}
OTHER_KIND = {t: k for k, (_, ts) in enumerate(OTHER_TOKENS.items()) for t in ts.split()}
TAG_KIND = {t: k for k, ts in enumerate(["article main", "p", "h1 h2 h3 h4 h5 h6", "div section center", "ul ol dl menu", "li dt dd", "nav", "header hgroup",
                                         "footer", "aside", "form fieldset button input", "table tbody tr td th", "blockquote pre figure figcaption",
                                         "details dialog address"], 1) for t in ts.split()}
TEACHER_DROPS = frozenset("nav footer aside form header dialog button".split())
TEACHER_KEEPS = frozenset("article main".split())


@dataclass(slots=True)
class Node:
    tag: str
    parent: "Node | None"
    tokens: tuple = ()
    items: list = field(default_factory=list)       # strings and child nodes in page order
    link: bool = False                              # inside a link
    number: int = -1

    @property
    def children(self):
        return [x for x in self.items if type(x) is Node]


def attribute_tokens(raw: str) -> tuple:
    out = []
    for name, a, b, c in ATTRIBUTE.findall(raw):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            out += [w.lower() for w in WORD.findall(value)]
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            out.append("\0hidden")
    return tuple(out)


class Reader:
    """The elements open at one place of a page, from the root down.

    Depths are kept by tag, so what an opening or closing tag ends is looked up, not walked to: deep
    nesting costs no more than flat markup."""

    def __init__(self):
        self.root = Node("html", None)
        self.path, self.depths, self.barriers = [self.root], {"html": [0]}, [0]

    @property
    def here(self) -> Node:
        return self.path[-1]

    def open(self, tag: str, tokens: tuple):
        node = Node(tag, self.here, tokens, link=tag == "a" or self.here.link)
        self.here.items.append(node)
        self.depths.setdefault(tag, []).append(len(self.path))
        if tag in BARRIER:
            self.barriers.append(len(self.path))
        self.path.append(node)

    def cut(self, depth: int):
        """Close the element at ``depth`` and all inside it; the root stays open."""
        while len(self.path) > max(depth, 1):
            node = self.path.pop()
            self.depths[node.tag].pop()
            if node.tag in BARRIER:
                self.barriers.pop()

    def close_before(self, tags):
        """Close the outermost open element of ``tags`` that no barrier stands above."""
        found = []
        for tag in tags:
            depths = self.depths.get(tag, [])
            at = bisect_right(depths, self.barriers[-1])
            found += depths[at:at + 1]
        if found:
            self.cut(min(found))

    def close(self, tag: str):
        depths = self.depths.get(tag)
        if depths and (tag not in ("p", "li", "a") or depths[-1] > self.barriers[-1]):
            self.cut(depths[-1])


def parse(page: str) -> Node:
    """Tree of block-level elements; inline elements vanish into their parent's text (link text is marked
    by ``Node`` "a"), scripts, styles, titles and other raw elements are left out.  Inside a link only what
    ends the link makes an element, so every element but links is numbered by ``blocks``."""
    reader, at, unclosed = Reader(), 0, set()
    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            reader.here.items.append(page[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):                                          # end tag
            if not (tag in INLINE and tag != "a" or tag in VOID):
                reader.close(tag)
            continue
        if tag in RAW:
            end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if end is None:
                unclosed.add(tag)
            at = end.end() if end else len(page) if tag in ("script", "style") else at
            continue
        if tag == "br":
            reader.here.items.append(" ")
            continue
        if tag in VOID or tag in ("html", "body"):
            if tag == "body":
                reader.cut(1)
            continue
        if tag in INLINE and tag != "a":
            continue
        if tag == "a":
            if reader.here.tag == "a":
                reader.cut(len(reader.path) - 1)
        elif reader.here.link and tag not in CLOSES_P:
            reader.here.items.append(" " if tag in TAG_KIND else "")
            continue
        else:
            reader.close_before(SAME_CLOSES.get(tag, ()) if tag not in CLOSES_P else ("p", "a"))
            if reader.here.tag == "a" and tag in CLOSES_P:
                reader.cut(len(reader.path) - 1)
        reader.open(tag, attribute_tokens(m.group(3)) if m.group(3) else ())
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)             # a tag cut off at the end of the page
        reader.here.items.append(rest[:cut.start()] if cut else rest)
    return reader.root


def blocks(root: Node) -> list[Node]:
    """All elements but links, parents before children, numbered."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        node.number = len(out)
        out.append(node)
        stack += [c for c in reversed(node.children) if c.tag != "a"]
    return out


def own_text(node: Node) -> list[tuple[int, str, bool]]:
    """Runs of the element's own text, split where a child block stands: (position, text, in a link)."""
    out = []
    for i, x in enumerate(node.items):
        if type(x) is str:
            out.append((i, x, node.link))
        elif x.tag == "a":
            out += [(i, t, True) for _, t, _ in own_text(x)]
    return out


N_KINDS = len(OTHER_TOKENS)
FEATURES = 24 + 2 * (N_KINDS + 2)


def describe(nodes: list[Node]) -> np.ndarray:
    """Feature matrix of the elements of one page."""
    n = len(nodes)
    parent = [0 if x.parent is None else x.parent.number for x in nodes]
    kind = [TAG_KIND.get(x.tag, 0) for x in nodes]
    own, linked, commas = [0] * n, [0] * n, [0] * n
    rank, brothers, alike = [0.0] * n, [0] * n, [0.0] * n
    signs = np.zeros((n, N_KINDS + 2))
    for k, x in enumerate(nodes):
        for _, text, link in own_text(x):
            size = len(text) - text.count(" ")
            own[k] += size
            if link:
                linked[k] += size
            commas[k] += text.count(",") + text.count(".")
        for t in x.tokens:
            if t in OTHER_KIND:
                signs[k, OTHER_KIND[t]] = 1
            if t in CONTENT_TOKENS:
                signs[k, N_KINDS] = 1
            elif t == "\0hidden":
                signs[k, N_KINDS + 1] = 1
        family = [c for c in x.children if c.tag != "a"]
        if family:
            size, same = len(family), Counter([c.tag for c in family])
            for i, c in enumerate(family):
                at = c.number
                rank[at], brothers[at], alike[at] = (i + 1) / size, size, same[c.tag] / size
    chars, tags = own[:], [1] * n
    paras, heads, inputs = ([int(v) for v in vs] for vs in ([x.tag == "p" for x in nodes], [v == 3 for v in kind], [v == 11 for v in kind]))
    for k in range(n - 1, 0, -1):
        p = parent[k]
        chars[p] += chars[k]
        linked[p] += linked[k]
        commas[p] += commas[k]
        tags[p] += tags[k]
        paras[p] += paras[k]
        heads[p] += heads[k]
        inputs[p] += inputs[k]
    above, depth, up_kind, up_nav = signs.copy(), [0] * n, [0] * n, [0] * n
    for k in range(1, n):
        p = parent[k]
        depth[k], up_kind[k] = depth[p] + 1, kind[p]
        up_nav[k] = 1 if up_nav[p] or 7 <= kind[k] <= 11 else 0
        if p:                       # the root has no signs
            above[k] = np.maximum(above[k], above[p])
    parent, own, chars, linked, commas, tags = (np.array(v, float) for v in (parent, own, chars, linked, commas, tags))
    parent = parent.astype(np.int64)
    up = np.maximum(parent, 0)
    page = max(chars[0], 1)
    order = np.cumsum(own) - own
    columns = [kind, up_kind, up_nav, depth, np.log1p(chars), np.log1p(own), chars / page, linked / np.maximum(chars, 1), chars / tags,
               np.log1p(commas), commas / np.maximum(chars, 1), np.log1p(tags), paras, heads, inputs, rank, brothers, alike, order / page,
               chars[up] / page, linked[up] / np.maximum(chars[up], 1), chars / np.maximum(chars[up], 1), np.log1p(tags[up]),
               (chars - linked)[up] / np.maximum(tags[up], 1)]
    return np.column_stack([*columns, signs, above])


# ---------------------------------------------------------------- boosted trees

@dataclass
class Trees:
    """Boosted regression trees on the logistic loss, splits at quantile bins."""

    base: float = 0.0
    trees: list = field(default_factory=list)      # (feature, threshold, left, right, value) arrays

    def decision(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, left, right, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                inner = left[node] >= 0
                if not inner.any():
                    break
                go = x[rows, feature[node]] <= threshold[node]
                node = np.where(inner, np.where(go, left[node], right[node]), node)
            out += value[node]
        return out

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int, depth: int, rate: float = 0.2, bins: int = 32, l2: float = 5.0,
            share: float = 0.3, seed: int = 1):
        """Each tree may use a random ``share`` of the features, so that no single sign carries the model."""
        rng = np.random.default_rng(seed)
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])     # bin b: cuts[b-1] < v <= cuts[b]
        mean = np.clip((weight @ y) / weight.sum(), 0.01, 0.99)
        model = cls(float(np.log(mean / (1 - mean))))
        f = np.full(len(y), model.base)
        width = bins + 1
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)
            feature, threshold, left, right, value = [], [], [], [], []
            pending = [(np.arange(len(y)), 0)]
            feature.append(0), threshold.append(0.0), left.append(-1), right.append(-1), value.append(0.0)
            spots, usable = [0], np.flatnonzero(rng.random(x.shape[1]) < share)
            while pending:
                rows, level = pending.pop()
                spot = spots.pop()
                gs, hs = g[rows].sum(), h[rows].sum()
                value[spot] = rate * gs / (hs + l2)
                if level == depth or len(rows) < 40:
                    continue
                best, where = 1e-3, None
                for j in usable:
                    cut = cuts[j]
                    if not len(cut):
                        continue
                    gl = np.cumsum(np.bincount(binned[rows, j], g[rows], width))[:len(cut)]
                    hl = np.cumsum(np.bincount(binned[rows, j], h[rows], width))[:len(cut)]
                    gain = gl ** 2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs ** 2 / (hs + l2)
                    b = int(np.argmax(gain))
                    if gain[b] > best:
                        best, where = gain[b], (j, b)
                if where is None:
                    continue
                j, b = where
                goes = binned[rows, j] <= b
                if goes.all() or not goes.any():
                    continue
                feature[spot], threshold[spot] = j, float(cuts[j][b])
                for side, part in ((left, rows[goes]), (right, rows[~goes])):
                    side[spot] = len(feature)
                    feature.append(0), threshold.append(0.0), left.append(-1), right.append(-1), value.append(0.0)
                    pending.append((part, level + 1))
                    spots.append(side[spot])
            tree = tuple(np.array(v) for v in (feature, threshold, left, right, value))
            model.trees.append(tree)
            f += cls(0.0, [tree]).decision(x)
        return model


# ---------------------------------------------------------------- training pages

def teach(root: Node) -> list[tuple[Node, int]]:
    """(element, 1 main / 0 other / -1 not known) of a page, from what the markup states; what lies
    in no stated part of a page that has a stated article counts as other."""
    out, open_ = [], [(root, 0, False)]
    while open_:
        node, inside, settled = open_.pop()
        out.append((node, inside))
        for c in reversed(node.children):
            if c.tag == "a":
                continue
            if settled or c.tag in TEACHER_DROPS or c.tag not in TEACHER_KEEPS and any(t in OTHER_KIND for t in c.tokens):
                open_.append((c, 0, True))
            else:
                open_.append((c, 1 if c.tag in TEACHER_KEEPS or inside == 1 else inside, False))
    return out


LONG_PARAGRAPH, FEW_LINKS = 80, 0.3


def teach_unstated(root: Node) -> list[tuple[Node, int]]:
    """The same for pages that state no article: long paragraphs with few links are main, parts named as
    something else are other, nothing is known of the rest."""
    out = []
    dropped = {id(x) for x, _ in teach(root) if x.tag in TEACHER_DROPS or any(t in OTHER_KIND for t in x.tokens)}
    for x in blocks(root):
        if x.parent is not None and id(x.parent) in dropped:
            dropped.add(id(x))
        sizes = [(len(t), link) for _, t, link in own_text(x)]
        total = sum(n for n, _ in sizes)
        main = x.tag == "p" and total >= LONG_PARAGRAPH and sum(n for n, link in sizes if link) < FEW_LINKS * total
        out.append((x, 0 if id(x) in dropped else 1 if main else -1))
    return out


def named_parts(nodes: list[Node]) -> np.ndarray:
    """What stays where there was nothing to learn from: all but parts named as something else."""
    keep = np.ones(len(nodes), bool)
    for k, x in enumerate(nodes[1:], 1):
        named = x.tag in TEACHER_DROPS or x.tag not in TEACHER_KEEPS and any(t in OTHER_KIND for t in x.tokens)
        keep[k] = keep[x.parent.number] and not named
    return keep


KEEP_CLASSES = ["content", "post-content", "entry", "story", "article-body", "main", "text", "page", "c1", "wrap"]


class Rewriter:
    """Varied copies of a sample page, with labels by origin."""

    def __init__(self, paragraphs: list[str], seed: int):
        self.rng, self.paragraphs = np.random.default_rng(seed), paragraphs or ["text"]

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def prose(self, words: int) -> str:
        return " ".join(self.pick(self.paragraphs).split()[:words])

    def element(self, parent, tag, tokens, *items) -> Node:
        node = Node(tag, parent, tokens)
        for x in items:
            if type(x) is Node:
                x.parent = node
            node.items.append(x)
        return node

    def links(self, n):
        out = []
        for _ in range(n):
            a = Node("a", None, link=True)
            a.items.append(self.prose(int(self.rng.integers(1, 5))))
            out.append(self.element(None, "li", (), a))
        return self.element(None, "ul", (), *out)

    def other(self) -> Node:
        """One part that is not the article."""
        kind = self.pick(list(OTHER_TOKENS))
        token = (self.pick(OTHER_TOKENS[kind].split()),) if self.rng.random() < 0.75 else ()
        short = lambda: self.prose(int(self.rng.integers(3, 25)))
        p = lambda: self.element(None, "p", (), short())
        if kind == "menu":
            return self.element(None, self.pick(["nav", "div", "ul"]) if token else "nav", token, self.links(int(self.rng.integers(2, 9))))
        if kind == "frame":
            foot = self.pick(["footer", "header", "div"])
            return self.element(None, foot if token or foot != "div" else "footer", token, short())
        if kind == "side":
            return self.element(None, self.pick(["aside", "div"]) if token else "aside", token, self.element(None, "h3", (), self.prose(3)),
                                self.links(int(self.rng.integers(2, 8))), p())
        if kind == "form":
            return self.element(None, "form", token, self.element(None, "div", (), self.prose(4)), self.element(None, "button", (), self.prose(2)))
        if kind == "comment":
            one = lambda: self.element(None, self.pick(["div", "li", "article"]), ("comment",), p(), p())
            return self.element(None, self.pick(["section", "div", "ol"]), ("comments",), self.element(None, "h3", (), self.prose(2)),
                                *[one() for _ in range(int(self.rng.integers(1, 5)))])
        if not token:
            token = (kind,)
        return self.element(None, self.pick(["div", "section", "aside"]), token, short() if self.rng.random() < 0.5 else p())

    def vary(self, x: Node) -> list[Node]:
        """Turn a paragraph of the article into a list, a table, a quotation or a heading; the elements made."""
        words = " ".join(t for _, t, _ in own_text(x)).split()
        kind = self.pick(["ul", "ol", "table", "blockquote", "h2", "figure"])
        if kind in ("blockquote", "figure"):
            inner = self.element(x, "p" if kind == "blockquote" else "figcaption", (), *x.items)
            x.tag, x.items = kind, [inner]
            return [inner]
        if kind == "h2":
            x.tag, x.items = kind, [" ".join(words[:int(self.rng.integers(2, 12))])]
            return []
        size, rows = int(self.rng.integers(2, 15)), []
        for at in range(0, min(len(words), 20 * size), size):
            part = " ".join(words[at:at + size])
            rows.append(self.element(x, "li", (), part) if kind != "table" else self.element(x, "tr", (), self.element(None, "td", (), part)))
        x.tag, x.items = kind, rows
        return [*rows, *(c for r in rows for c in r.children)]

    def rewrite(self, root: Node, teacher) -> list[tuple[Node, int]]:
        """Change ``root`` in place; labels for all its elements."""
        label = {id(x): y for x, y in teacher(root)}
        for x in blocks(root):
            y, chance = label[id(x)], self.rng.random()
            if x.tag in TEACHER_KEEPS and chance < 0.6:
                x.tag, x.tokens = self.pick(["div", "section", "main", "article"]), \
                    (tuple(self.pick(KEEP_CLASSES).split("-")) if self.rng.random() < 0.6 else ())
            elif x.tag in ("nav", "footer", "aside") and chance < 0.5:
                kind = {"nav": "menu", "footer": "frame", "aside": "side"}[x.tag]
                x.tag, x.tokens = "div", (self.pick(OTHER_TOKENS[kind].split()),)
            elif y == 0 and x.tokens and chance < 0.5:
                kind = next((k for k in OTHER_TOKENS if x.tokens[0] in OTHER_TOKENS[k].split()), "advert")
                x.tokens = (self.pick(OTHER_TOKENS[kind].split()),)
        if self.rng.random() < 0.5 and root.children:
            wrap = self.element(root, "div", (self.pick(["page", "wrapper", "container", "content", "site"]),), *root.items)
            root.items = [wrap]
            label[id(wrap)] = -1
            place = wrap
        else:
            place = root
        for _ in range(int(self.rng.integers(0, 6))):
            extra = self.other()
            extra.parent = place
            place.items.insert(int(self.rng.integers(0, len(place.items) + 1)), extra)
        for x in blocks(root):
            if label.get(id(x)) == 1 and x.tag == "p" and x.parent is not None and self.rng.random() < 0.2:
                for made in self.vary(x):
                    label[id(made)] = 1
        keep = [x for x in blocks(root) if label.get(id(x)) == 1 and x.parent is not None and label.get(id(x.parent), 0) != 1]
        if keep and self.rng.random() < 0.1:                     # a very short article
            whole = keep[0]
            whole.items = [x for x in whole.items if type(x) is Node][:int(self.rng.integers(1, 4))]
            for x in whole.children:
                x.items = [self.prose(int(self.rng.integers(1, 8)))]
        if keep and self.rng.random() < 0.3:                     # a part that is not the article inside it
            extra = self.other()
            extra.parent = keep[0]
            keep[0].items.insert(int(self.rng.integers(0, len(keep[0].items) + 1)), extra)
        return [(x, label.get(id(x), 0)) for x in blocks(root)]


def training_rows(pages: list[str], copies: int, seed: int):
    """(features, labels, weights) from the sample pages and their rewritten copies.  Pages in which no
    article is stated teach nothing, unless no page of the sample states one."""
    roots = [parse(p) for p in pages]
    prose = [t.strip() for r in roots for x in blocks(r) if x.tag == "p" for _, t, _ in own_text(x) if len(t) > 40][:5000]
    stated = [any(n.tag in TEACHER_KEEPS for n in blocks(r)) for r in roots]
    teacher = teach if any(stated) else teach_unstated
    rewriter, x, y, w = Rewriter(prose, seed), [], [], []
    for page, usable in zip(pages, stated):
        for copy in range(copies + 1 if usable or teacher is teach_unstated else 0):
            root = parse(page)
            labels = {id(n): v for n, v in (rewriter.rewrite(root, teacher) if copy else teacher(root))}
            nodes = blocks(root)
            own = np.array([labels[id(n)] for n in nodes])
            holds_main = own == 1                               # below the element; children come after parents
            for k in range(len(nodes) - 1, 0, -1):
                holds_main[nodes[k].parent.number] |= holds_main[k]
            carriers = np.array([n.parent is not None for n in nodes]) & ((own == 1) | ~holds_main)
            keep = (own >= 0) & carriers                        # parents of article and other parts alike teach nothing
            f = describe(nodes)[keep]
            x.append(f)
            y.append(own[keep])
            w.append(1 / np.sqrt(max(1, keep.sum())) + 0.1 * f[:, 4])
    if not x or len(set(np.concatenate(y).tolist())) < 2:
        return None
    return np.concatenate(x), np.concatenate(y).astype(float), np.concatenate(w)


# ---------------------------------------------------------------- decoding

INHERITED = 0.25         # share of its parent's log odds that an element takes on


def inherit(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Log odds with what the element's ancestors say: doubt about one paragraph doesn't drop it out of a
    certain article, nor does it lift one out of a certain menu."""
    out = odds.copy()
    out[0] = 0
    for k in range(1, len(nodes)):
        out[k] += INHERITED * out[nodes[k].parent.number]
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Which elements are kept: the largest sum of log odds with no element kept under a dropped one.
    The root is always open and has no say."""
    best = odds.copy()
    best[0] = 0
    for k in range(len(nodes) - 1, 0, -1):
        best[nodes[k].parent.number] += max(best[k], 0.0)
    keep = np.zeros(len(nodes), bool)
    keep[0] = True
    for k in range(1, len(nodes)):
        keep[k] = keep[nodes[k].parent.number] and best[k] > 0
    return keep


def page_text(root: Node, keep: np.ndarray) -> str:
    """Text of the kept elements: a line for each block, white space inside a block as one space."""
    lines, run, stack = [], [], [(root, iter(root.items))]

    def flush():
        if run:
            line = " ".join(html.unescape("".join(run)).split())
            run.clear()
            if line:
                lines.append(line)

    while stack:
        node, items = stack[-1]
        for x in items:
            if type(x) is str:
                run.append(x)
            elif x.tag == "a":
                stack.append((x, iter(x.items)))
                break
            elif keep[x.number]:
                flush()
                stack.append((x, iter(x.items)))
                break
            else:
                flush()
        else:
            stack.pop()
            if node.tag != "a":
                flush()
    return "\n".join(lines)


def read_page(page: str) -> tuple[Node, list[Node]]:
    """Tree and elements of a page; text outside every element counts as an element of its own."""
    root = parse(page)
    for i, x in enumerate(root.items):
        if type(x) is str and x.strip():
            node = Node("p", root)
            node.items.append(x)
            root.items[i] = node
    return root, blocks(root)


def extract(pages: list[str], trees: Trees | None) -> list[str]:
    """Main text of each page; the trees judge the elements of all pages at once (none: parts by name)."""
    read = [read_page(p) for p in pages]
    if trees is None:
        return [page_text(root, named_parts(nodes)) for root, nodes in read]
    odds = trees.decision(np.concatenate([describe(nodes) for _, nodes in read]))
    ends = np.cumsum([len(nodes) for _, nodes in read])
    out = []
    for (root, nodes), end in zip(read, ends.tolist()):
        keep = decode(nodes, inherit(nodes, odds[end - len(nodes):end]))
        if len(nodes) == 2 and nodes[1].tag == "p" and not nodes[1].tokens:
            keep[1] = True               # nothing but one paragraph: there is no other part to tell it from
        out.append(page_text(root, keep))
    return out


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 300, most_chars: int = 20_000, copies: int = 4,
          rounds: int = 120, depth: int = 4, seed: int = 5) -> Trees | None:
    """Fit on the ``sample`` distinct page contents (all, if there are fewer) of at most ``most_chars`` characters
    with the smallest hashes (bounds of the training set alone; extraction reads whole pages).  Where no sample
    page states its article, long paragraphs and named parts teach instead; None, with a warning if there are pages, if these don't tell."""
    known = pages.where(F.col(html_col).isNotNull() & (F.length(html_col) <= most_chars)).select(F.col(html_col).alias("h"), F.lit(0).alias("g"))
    picked, sizes = smallest_hashes(known, ["h"], sample, "g")
    found = sorted(r["h"] for r in picked.collect())
    if sizes and not found:
        raise RuntimeError("pages to learn from, but none in the sample")
    data = training_rows(found, copies, seed)
    if data is None and (found or not pages.where(F.col(html_col).isNotNull()).isEmpty()):
        warnings.warn(f"the sample of {len(found)} pages of at most {most_chars} characters teaches nothing: all visible text but that of "
                      "parts named as something else is kept")
    return None if data is None else Trees.fit(*data, rounds=rounds, depth=depth)


def extract_pages(pages: DataFrame, trees: Trees | None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` for every row, from the whole page.

    Null and empty pages give an empty text; without a model all but parts named as something else is kept.
    Very deep or long pages cost in proportion to their length.  No shuffle;
    repeated rows, null ids and other columns don't matter; an empty table gives no rows."""
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def run(batches):
        for batch in slices(batches):
            texts = extract(batch.column(2).to_pylist(), trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    rows = pages.select(id_col, url_col, F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("h"))
    return rows.mapInArrow(run, f"{id_col} {id_type}, {url_col} {url_type}, text string, n_chars long")
