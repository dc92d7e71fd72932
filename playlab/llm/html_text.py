"""Main text of web pages by a linear-chain CRF over DOM leaf blocks (operator 9).

A page is cut into leaf blocks: the runs of text between the borders of block
elements, each with the path of its ancestors (tag, and the groups of words in
class, id and role).  Content of scripts, styles, titles, controls and other
markup that shows no text of the page is dropped while parsing.  A two-label CRF
(main text or not) scores blocks by ancestor and text features and neighbours by
label pairs; Viterbi gives the best labelling, and the blocks labelled as
main text, in page order, are the page's text.

Training pages are a bounded sample: the ``sample`` pages with the smallest hash of
their key that are no longer than ``MAX_TRAIN_CHARS``.  Their labels come from their
own markup (blocks inside article or main elements, outside navigation and the
like); pages without such a block train nothing.  Since one site's markup is poor in variety, every sampled page is also
laid out anew a few times with its own texts in other templates (other
containers, sidebars, notices, adverts, forms, reader comments), whose
labels are known from the layout.  Weights are fitted by gradient ascent on the
conditional likelihood (forward-backward, all pages of a step at once).

Edge cases: null or empty html, or a page without main text, gives the empty text;
unclosed tags, comments and quotes are read as far as they go; a head without its end
tag ends at body, or at the first text or tag that may not stand in it; a null url stays
null; repeated rows and further columns change nothing; without any training page
every block counts as boilerplate unless inside article or main.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlab.session import ship_package

SAMPLE_PAGES = 240
LAYOUTS = 4
MAX_TRAIN_CHARS = 100_000
STEPS = 150

# HTML element names by their role here.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rb rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes plaintext".split())
HIDDEN = frozenset("head script style textarea title noscript template iframe object svg math canvas select option "
                   "button datalist audio video map xmp noembed noframes plaintext".split())
FOREIGN = ("svg", "math")
# Start tags that may stand in head; any other one, and text, ends an open head.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSED_BY = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
             "tr": ("tr", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
MAIN = frozenset(["article", "main"])
ASIDE = frozenset("nav header footer aside form menu dialog".split())
BLOCK = frozenset("address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol "
                  "optgroup p pre search section summary table tbody td tfoot th thead tr ul".split())
NAMES = INLINE | VOID | RAW | HIDDEN | BLOCK  # other elements count as one name
# Words in class, id and role attributes, by group; matched as prefixes of their parts.
GROUPS = {
    "nav": "nav menu toc", "crumb": "breadcrumb crumb", "head": "header masthead topbar", "foot": "foot copyright legal",
    "side": "side aside widget rail", "ad": "ad ads advert sponsor promo banner", "notice": "cookie consent notice alert gdpr popup modal",
    "comment": "comment reply replies disqus discussion respond", "form": "form login signup subscribe newsletter search",
    "share": "share social follow", "related": "related recommend more trending", "page": "pager pagination",
    "main": "article main content post entry story body text",
}
_EXACT = {"ad", "ads", "more", "text", "toc", "page"}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
_OPEN_COMMENT = re.compile(r"<!--.*\Z", re.S)
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


def groups_of(attrs: str) -> tuple[str, ...]:
    found = set()
    for m in _ATTR.finditer(attrs):
        for part in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "").lower()):
            for group, words in GROUPS.items():
                if part and any(part == w or (w not in _EXACT and part.startswith(w)) for w in words.split()):
                    found.add(group)
    return tuple(sorted(found))


class Place(NamedTuple):
    """What the ancestors of a block say.

    Each element's place follows from its parent's, and the sets grow only with element
    names and groups that are new on the path, so a page's depth costs nothing.
    """
    tags: frozenset = frozenset()
    groups: frozenset = frozenset()
    leaf: str = "-"       # innermost element within body
    apart: bool = False   # in an element set apart by its name or groups
    inside: bool = False  # in article or main
    off: bool = False     # in an element set apart within these

    def child(self, tag: str, groups: tuple[str, ...] = ()) -> Place:
        tag = tag if tag in NAMES else "other"
        inside = self.inside or tag in MAIN
        named = tag in ASIDE
        return Place(
            self.tags if tag in self.tags else self.tags | {tag},
            self.groups if self.groups.issuperset(groups) else self.groups.union(groups),
            self.leaf if tag in ("html", "body") else tag,
            self.apart or named or any(g != "main" for g in groups),
            inside, self.off or (inside and (named or any(g not in ("main", "head", "page") for g in groups))))


def place(path) -> Place:
    at = Place()
    for tag, groups in path:
        at = at.child(tag, groups)
    return at


def blocks(page: str | None) -> list[tuple[Place, str, float]]:
    """Leaf blocks in page order: (place, text, share of characters inside links).

    Open elements are indexed by name, so every tag costs about the same at any depth.
    """
    out: list[tuple[Place, str, float]] = []
    stack: list[tuple[str, Place]] = []
    opened: dict[str, list[int]] = {}  # places of the open elements in the stack, by name
    parts: list[str] = []
    hidden = links = linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((stack[-1][1] if stack else Place(), text, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def say(s: str):
        nonlocal linked
        if hidden and stack[-1][0] == "head" and s.strip(" \t\n\f\r"):
            pop(len(stack) - 1)
        if s and not hidden:
            s = html.unescape(s) if "&" in s else s
            parts.append(s)
            if links:
                linked += len(s)

    def pop(to: int):
        nonlocal hidden, links
        for tag, _ in stack[to:]:
            hidden -= tag in HIDDEN
            links -= tag == "a"
            opened[tag].pop()
        del stack[to:]

    def last(names) -> int:
        return max([opened[n][-1] for n in names if opened.get(n)], default=-1)

    def close(names, stop=()):
        at = last(names)
        if at >= 0 and at >= last(stop):
            pop(at)

    page = page or ""
    at, size = 0, len(page)
    tags_end = page.rfind(">") + 1  # no tag ends beyond
    while at < size:
        m = _TOKEN.search(page, at, tags_end) if at < tags_end else _OPEN_COMMENT.search(page, at)
        if not m:
            say(page[at:max(at, tags_end)])
            at = max(at, tags_end)
            if at == tags_end and _OPEN_COMMENT.search(page, at):
                continue
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[0].startswith("<!--") and not m[0].endswith("-->"):
            break
        name = m[2] or m[5]
        if not name:
            continue
        tag, attrs = name.lower(), m[3] or m[6] or ""
        if m[1] or m[4]:
            if tag not in INLINE:
                flush()
            if tag == "br":
                parts.append(" ")
            else:
                close((tag,))
            continue
        if hidden and (tag == "body" or (stack[-1][0] == "head" and tag not in IN_HEAD)):
            close(("head",), ("template",))
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSED_BY:
                close(CLOSED_BY[tag][0].split(), CLOSED_BY[tag][1])
            elif tag not in VOID:
                close(("p",), ("article", "section", "div", "td", "li", "blockquote", "body"))
        if tag in VOID or (attrs.endswith("/") and (tag in FOREIGN or any(opened.get(f) for f in FOREIGN))):
            continue  # elsewhere a slash at a tag's end means nothing
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "a" and opened.get("a") and opened["a"][-1] == len(stack) - 1:
            pop(len(stack) - 1)  # links do not nest
        around = stack[-1][1] if stack else Place()
        opened.setdefault(tag, []).append(len(stack))
        stack.append((tag, around if tag in INLINE else around.child(tag, groups_of(attrs) if "=" in attrs else ())))
        hidden += tag in HIDDEN
        links += tag == "a"
    flush()
    return out


def markup_label(at: Place) -> int:
    """What the page's own markup says: inside article or main, in nothing set apart."""
    return int(at.inside and not at.off)


class Features:
    """Feature names to numbers; grows while training, fixed after it."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.of_path: dict[tuple, tuple[int, ...]] = {}
        self.fixed = False

    def _add(self, names) -> list[int]:
        if self.fixed:
            return [self.number[n] for n in names if n in self.number]
        return [self.number.setdefault(n, len(self.number)) for n in names]

    def path(self, path: Place) -> tuple[int, ...]:
        if path not in self.of_path:
            if len(self.of_path) > 20_000:
                self.of_path.clear()
            names = {f"in {t}" for t in path.tags} | {f"group {g}" for g in path.groups}
            names.add(f"leaf {path.leaf}")
            names.add("main element" if path.inside else "no main element")
            names.add("set apart" if path.apart else "not set apart")
            self.of_path[path] = tuple(self._add(sorted(names)))
        return self.of_path[path]

    def block(self, block) -> list[int]:
        path, text, linked = block
        n = len(text)
        names = ["bias", f"size {min(5, n.bit_length() // 2)}" if n < 1024 else "size long",
                 "links " + ("none" if linked == 0 else "some" if linked < 0.5 else "most")]
        if text[-1] in ".!?…\"'”":
            names.append("ends a sentence")
        if text[0] in "©®":
            names.append("rights")
        return [*self.path(path), *self._add(names)]


class Crf:
    """Two labels; weights per (feature, label), per label pair, and for first and last blocks."""

    def __init__(self):
        self.features = Features()
        self.w = np.zeros((0, 2))
        self.pair = np.zeros((2, 2))
        self.ends = np.zeros((2, 2))

    def fit(self, pages: list[list[tuple]], labels: list[list[int]], steps: int = STEPS, l2: float = 1e-3):
        coded = [[self.features.block(b) for b in p] for p in pages]
        self.features.fixed = True
        self.features.of_path.clear()
        n, longest, size = len(coded), max(map(len, coded)), len(self.features.number)
        lens = np.array([len(p) for p in coded])
        rows = np.array([(i * longest + t, f) for i, p in enumerate(coded) for t, fs in enumerate(p) for f in fs])
        y = np.zeros((n, longest), np.int64)
        for i, l in enumerate(labels):
            y[i, :len(l)] = l
        real = np.arange(longest)[None, :] < lens[:, None]
        both = real[:, 1:]
        theta = np.zeros(size * 2 + 8)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        last = (np.arange(n), lens - 1)
        total = lens.sum()

        def observed(state, pairs, first, end):
            g = np.zeros((size, 2))
            for k in range(2):
                g[:, k] = np.bincount(rows[:, 1], state[:, :, k].ravel()[rows[:, 0]], size)
            return np.concatenate([g.ravel(), pairs.ravel(), first, end])

        hot = np.eye(2)[y] * real[..., None]
        pairs = np.array([[(both & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
        target = observed(hot, pairs, hot[:, 0].sum(0), hot[last].sum(0))
        for step in range(1, steps + 1):
            w, pair = theta[:size * 2].reshape(size, 2), theta[size * 2:size * 2 + 4].reshape(2, 2)
            start, end = theta[-4:-2], theta[-2:]
            score = np.stack([np.bincount(rows[:, 0], w[rows[:, 1], k], n * longest) for k in range(2)], 1).reshape(n, longest, 2)
            score[:, 0] += start
            score[last] += end
            alpha, beta = np.zeros_like(score), np.zeros_like(score)
            alpha[:, 0] = score[:, 0]
            for t in range(1, longest):
                alpha[:, t] = score[:, t] + np.logaddexp.reduce(alpha[:, t - 1, :, None] + pair, axis=1)
            for t in range(longest - 2, -1, -1):
                nxt = np.logaddexp.reduce(pair[None] + (score[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
                beta[:, t] = np.where((t + 1 < lens)[:, None], nxt, 0.0)
            logz = np.logaddexp.reduce(alpha[last], axis=1)[:, None]
            state = np.exp(alpha + beta - logz[:, :, None]) * real[..., None]
            edge = np.exp(alpha[:, :-1, :, None] + pair + (score[:, 1:] + beta[:, 1:])[:, :, None, :]
                          - logz[:, :, None, None]) * both[..., None, None]
            grad = (target - observed(state, edge.sum((0, 1)), state[:, 0].sum(0), state[last].sum(0))) / total - l2 * theta
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            theta += 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        self.w, self.pair = theta[:size * 2].reshape(size, 2).copy(), theta[size * 2:size * 2 + 4].reshape(2, 2).copy()
        self.ends = np.stack([theta[-4:-2], theta[-2:]])
        return self

    def labels(self, page: list[tuple]) -> list[int]:
        """Viterbi: the best labelling of a page's blocks (ties: not main text)."""
        if not page:
            return []
        if not len(self.w):
            return [markup_label(p) for p, _, _ in page]
        w0, w1 = self.w[:, 0].tolist(), self.w[:, 1].tolist()
        (p00, p01), (p10, p11) = self.pair.tolist()
        (a, b), (e0, e1) = self.ends.tolist()
        back = []
        for t, block in enumerate(page):
            fs = self.features.block(block)
            s0, s1 = sum([w0[f] for f in fs]), sum([w1[f] for f in fs])
            if t:
                f0, f1 = a + p00 >= b + p10, a + p01 >= b + p11
                back.append((0 if f0 else 1, 0 if f1 else 1))
                a, b = (a + p00 if f0 else b + p10) + s0, (a + p01 if f1 else b + p11) + s1
            else:
                a, b = a + s0, b + s1
        y = [int(b + e1 > a + e0)]
        for pointers in reversed(back):
            y.append(pointers[y[-1]])
        return y[::-1]

    def text(self, page: str | None) -> str:
        found = blocks(page)
        return " ".join(b[1] for b, y in zip(found, self.labels(found)) if y)


def relaid(found: list[tuple], rng: random.Random) -> tuple[list[tuple], list[int]]:
    """The page's texts in another layout: blocks, and labels known from it."""
    body = [b for b in found if markup_label(b[0])]
    texts = [b[1] for b in found]
    page: list[tuple] = []
    labels: list[int] = []
    top = (("html", ()), ("body", ()))
    if rng.random() < 0.5:
        top += (("div", rng.choice([(), (), ("main",)])),)

    def add(path, text, y, linked=0.0):
        page.append((place(path), text, linked))
        labels.append(y)

    def some():
        t = rng.choice(texts).split()
        return " ".join(t[:rng.choice([1, 2, 4, 8, 20, 60])])

    def aside(base):
        kind = rng.choice(["nav", "menu", "header", "footer", "aside", "side", "ad", "notice", "form", "comment",
                           "share", "related", "crumb", "page"])
        tag = kind if kind in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.7 else rng.choice(["div", "section", "ul"])
        group = {"menu": "nav", "header": "head", "footer": "foot", "aside": "side"}.get(kind, kind)
        named = (tag, () if tag == kind and rng.random() < 0.6 else (group,))
        many = rng.randint(1, 6)
        inner = rng.choice([(), (("p", ()),), (("ul", ()), ("li", ())), (("div", ()),), (("div", ()), ("p", ()))])
        for _ in range(many):
            linked = 1.0 if group in ("nav", "crumb", "share", "related", "page") and rng.random() < 0.8 else 0.0
            text = rng.choice(texts) if group == "comment" or rng.random() < 0.2 else some()
            add((*base, named, *inner), text, 0, linked)

    for _ in range(rng.randint(0, 4)):
        aside(top)
    main = rng.choice([(("article", ()),), (("main", ()),), (("article", ("main",)),), (("main", ()), ("article", ())),
                       (("div", ("main",)),), (("section", ("main",)),), (("div", ("main",)), ("div", ())),
                       (("div", ()),), (("table", ()), ("tr", ()), ("td", ()))])
    heads = ("h1", "h2", "h3")
    for i, b in enumerate(body):
        leaf = b[0].leaf
        tag = leaf if leaf in heads else rng.choice(["p"] * 6 + ["blockquote", "li", "h2", "div", "td"])
        inner = {"li": (("ul", ()),), "td": (("table", ()), ("tr", ()))}.get(tag, ())
        add((*top, *main, *inner, (tag, ())), b[1], 1, b[2])
        if i and rng.random() < 0.15:
            aside((*top, *main))
    if rng.random() < 0.5:
        aside((*top, *main))
    for _ in range(rng.randint(0, 4)):
        aside(top)
    return page, labels


def train(pages: DataFrame, key: str = "page_id", text: str = "html", sample: int = SAMPLE_PAGES) -> Crf:
    """Fit on the ``sample`` pages with the smallest key hash; they are the only pages the driver sees."""
    ship_package(pages.sparkSession)
    drawn = (pages.where(F.col(text).isNotNull() & (F.length(text) <= MAX_TRAIN_CHARS))
             .select(F.xxhash64(F.col(key).cast("string"), F.lit("pages")).alias("h"), F.col(text).alias("page")))
    cut = drawn.select("h").orderBy("h").limit(sample).agg(F.max("h")).head()[0]
    if cut is None:
        return Crf()
    rows = sorted((r.h, r.page) for r in drawn.where(F.col("h") <= cut).orderBy("h", "page").limit(sample).collect())
    found, labels = [], []
    for h, page in rows:
        bs = blocks(page)
        marked = [markup_label(b[0]) for b in bs]
        if not any(marked):
            continue  # its markup says nothing about where its text is
        found.append(bs)
        labels.append(marked)
        rng = random.Random(h)
        for _ in range(LAYOUTS):
            p, y = relaid(bs, rng)
            found.append(p)
            labels.append(y)
    return Crf().fit(found, labels) if found else Crf()


def extract(pages: DataFrame, model: Crf, html_column: str = "html") -> DataFrame:
    """All columns of ``pages`` with ``text``; an earlier column of that name goes."""
    spark = pages.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([shared.value.text(p) for p in s], dtype=object)

    return pages.withColumn("text", main_text(F.col(html_column)))
