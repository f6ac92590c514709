"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded down the tree.

A page is read into a tree of block elements with runs of inline text as leaves (missing end tags are implied,
scripts, styles, comments and other raw elements are skipped, nothing is recursive). Every node gets features of
its tag, its attribute tokens and those above it, its subtree (text per tag, links, punctuation, kinds of blocks), its depth and
its siblings. Boosted trees score each node: does its subtree hold article text? Decoding keeps a set of nodes that
is closed upwards and has the largest sum of scores, so no node is kept below one that was dropped, and a doubtful
container lives or dies with what it holds.

The trees are trained here, on at most ``TRAIN_PAGES`` of the given pages that are no longer than
``TRAIN_CHARS`` (documented bounds of the sample; every page is scored). There are no labels, so each sampled page is used twice: as
it is where an ``article`` or ``main`` element marks the text, and a few times re-dressed, its own blocks put
into layouts drawn at random (with and without such elements) whose parts are known.

Blocks of kept text are joined by an empty line. White space (that of ``str.split``) inside a block becomes one space, character
references are decoded. Null and empty pages give an empty text, repeated rows are all
returned, other columns are kept; a column named ``text`` is replaced. No rows give no rows, and a model of no pages drops all.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import text as tx
from tallyhouse.llm.common import map_kept

TRAIN_PAGES, TRAIN_CHARS, TRAIN_NODES = 192, 1 << 16, 40_000
LAYOUTS = 4  # re-dressed copies of a training page
SLICE = 8 << 20  # bytes of pages that are scored together
ROUNDS, DEPTH, BINS, RATE = 30, 4, 32, 0.3

# Elements of HTML by their part in a page.
HEADINGS = "h1 h2 h3 h4 h5 h6"
GROUPS = {
    "text": "", "p": "p", "heading": HEADINGS, "item": "li dt dd", "list": "ul ol dl menu dir",
    "div": "div center", "section": "section figure figcaption details summary hgroup",
    "article": "article", "main": "main", "nav": "nav", "aside": "aside", "header": "header",
    "footer": "footer address", "form": "form fieldset legend button select option optgroup label dialog",
    "table": "table caption thead tbody tfoot tr td th", "quote": "blockquote pre",
    "body": "html body head",
}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes", "xmp", "svg", "math",
       "template", "object", "video", "audio", "canvas"}
BREAKS = {"br", "hr", "wbr"}
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
# Words in classes, ids and roles that name parts of a page.
AROUND = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs topbar toolbar sidebar side widget widgets rail aside footer foot "
    "bottom copyright legal header head masthead top cookie cookies consent gdpr notice notices alert popup modal overlay "
    "subscribe subscription newsletter signup login register form search share sharing social follow related recommended "
    "recommendations more popular trending tags pager pagination pagenav comment comments commentlist reply replies respond "
    "discussion disqus feedback complementary contentinfo hidden skip sitemap links toc rating".split()
)
WITHIN = set(
    "article content contents main body story post entry text page prose hentry blog news fulltext maintext "
    "articlebody postbody paragraph document".split()
)
_GROUP = {tag: i for i, tags in enumerate(GROUPS.values()) for tag in tags.split()}
_NAMES = list(GROUPS)
_P, _HEADING, _ITEM, _BODY = (_NAMES.index(n) for n in ("p", "heading", "item", "body"))
_TAG_END = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSEEN = re.compile(r"""\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>]|$)", re.I) for tag in RAW}
_MARK = re.compile(r"\bx-part=([01])")


class Tree:
    """Nodes of one or more pages, in page order; parents stand before their children."""

    def __init__(self):
        self.page: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.group: list[int] = []
        self.around: list[int] = []
        self.within: list[int] = []
        self.mark: list[int] = []  # 1 and 0 where a training layout says so, -1 elsewhere
        self.text: list[str | None] = []
        self.linked: list[int] = []
        self.n_pages = 0

    def _add(self, parent: int, group: int, text: str | None = None, linked: int = 0) -> int:
        self.page.append(self.n_pages)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.group.append(group)
        self.around.append(0)
        self.within.append(0)
        self.mark.append(-1)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.page) - 1

    def _attributes(self, node: int, found: str) -> None:
        mark = _MARK.search(found)
        if mark:
            self.mark[node] = int(mark[1])
        words = [w.lower() for value in _NAMED.findall(found) for w in _WORD.findall(value)]
        self.around[node] = sum(w in AROUND for w in words) + 2 * bool(_UNSEEN.search(found))
        self.within[node] = sum(w in WITHIN for w in words)

    def read(self, page: str | None) -> None:
        """Add a page."""
        page = page or ""
        root = self._add(-1, _BODY)
        stack: list[tuple[int, str]] = [(root, "#root")]
        open_tags: dict[str, int] = {}
        run: list[str] = []
        links, linked = 0, 0

        def flush() -> None:
            nonlocal linked
            text = " ".join("".join(run).split())
            if text:
                self._add(stack[-1][0], 0, text, min(linked, len(text)))
            run.clear()
            linked = 0

        def close(depth: int) -> None:
            for _, tag in stack[depth:]:
                open_tags[tag] -= 1
            del stack[depth:]

        at, n, quoted = 0, len(page), True
        while at < n:
            low = page.find("<", at)
            low = n if low < 0 else low
            if low > at:
                piece = page[at:low]
                piece = entities.unescape(piece) if "&" in piece else piece
                run.append(piece)
                if links:
                    linked += len(piece.strip())
            if low == n:
                break
            sign = page[low + 1 : low + 2]
            if sign in ("!", "?"):
                mark = "-->" if page.startswith("<!--", low) else ">"
                end = page.find(mark, low + (4 if mark == "-->" else 2))
                at = n if end < 0 else end + len(mark)
                continue
            ending = sign == "/"
            name = _NAME.match(page, low + 1 + ending)
            if not name:  # not a tag; an end tag without a name is skipped
                end = page.find(">", low) if ending else -1
                if end < 0:
                    run.append("<")
                at = low + 1 if end < 0 else end + 1
                continue
            tag = name[0].lower()
            whole = _TAG_END.match(page, name.end()) if quoted else None
            if whole is None:
                quoted = False  # an open quote: from here on the next sign ends a tag
                end = page.find(">", name.end())
                end = n if end < 0 else end + 1
            else:
                end = whole.end()
            at = end
            if tag == "a":
                links = 0 if ending else 1
            if tag in RAW:
                if not ending and page[end - 2 : end - 1] != "/":
                    stop = _RAW_END[tag].search(page, end)
                    stop = stop and page.find(">", stop.end())
                    at = n if stop is None or stop < 0 else stop + 1
                continue
            if tag in BREAKS:
                run.append(" ")
                if tag == "hr":
                    flush()
                continue
            group = _GROUP.get(tag)
            if group is None:
                if ":" in tag or "-" in tag:
                    run.append(" ")
                continue
            flush()
            if ending:
                if open_tags.get(tag):
                    depth = len(stack) - 1
                    while stack[depth][1] != tag:
                        depth -= 1
                    close(depth)
                links = 0
                continue
            if stack[-1][1] == "p" and tag not in ("button", "label", "select", "option"):
                close(len(stack) - 1)
            if tag[0] == "h" and group == _HEADING and stack[-1][1] in HEADINGS.split():
                close(len(stack) - 1)
            if tag in CLOSED_BY:
                closes, until = CLOSED_BY[tag]
                if any(open_tags.get(t) for t in closes):
                    depth = len(stack) - 1
                    found = None
                    while depth and stack[depth][1] not in until:
                        if stack[depth][1] in closes:
                            found = depth
                        depth -= 1
                    if found:
                        close(found)
            node = self._add(stack[-1][0], group)
            if end - name.end() > 1:
                self._attributes(node, page[name.end() - 1 : end - 1])
            stack.append((node, tag))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        flush()
        self.n_pages += 1


def _up(values: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Sums over subtrees."""
    out = values.astype(np.float64)
    for nodes in levels[:0:-1]:
        np.add.at(out, parent[nodes], out[nodes])
    return out


def _down(values: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Sums over the nodes above, without the node itself."""
    out = np.zeros(len(values))
    for nodes in levels[1:]:
        out[nodes] = out[parent[nodes]] + values[parent[nodes]]
    return out


def _levels(tree: Tree) -> tuple[np.ndarray, list[np.ndarray]]:
    depth = np.array(tree.depth, np.int64)
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    return np.array(tree.parent, np.int64), np.split(order, cuts) if len(order) else []


def features(tree: Tree, parent: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """One row per node, 32-bit floats."""
    n = len(parent)
    group = np.array(tree.group)
    page = np.array(tree.page)
    own = np.array([len(t) if t else 0 for t in tree.text], float)
    words = np.array([t.count(" ") + 1 if t else 0 for t in tree.text], float)
    stops = np.array([sum(map(t.count, ".,;!?")) if t else 0 for t in tree.text], float)
    linked = np.array(tree.linked, float)
    leaf = np.array([t is not None for t in tree.text])
    around, within = np.array(tree.around, float), np.array(tree.within, float)
    above = np.where(parent >= 0, parent, np.arange(n))

    def sums(values):
        return _up(values, parent, levels)

    chars, tags, texts = sums(own), sums(~leaf), sums(leaf)
    n_words, n_stops = sums(words), sums(stops)
    first = np.flatnonzero(np.r_[True, page[1:] != page[:-1]])
    size = np.diff(np.r_[first, n])
    page_chars = np.repeat(chars[first], size)
    place = np.arange(n) - np.repeat(first, size)
    # siblings, in page order side by side
    order = np.lexsort((np.arange(n), above))
    new = np.flatnonzero(np.r_[True, above[order][1:] != above[order][:-1]])
    count = np.diff(np.r_[new, n])
    siblings = np.empty(n)
    siblings[order] = np.repeat(count, count)
    index = np.empty(n)
    index[order] = np.arange(n) - np.repeat(new, count)
    kin = np.empty(n)
    kin[order] = np.repeat(np.add.reduceat(chars[order], new), count)
    alike = above * len(_NAMES) + group
    _, inverse, same = np.unique(alike, return_inverse=True, return_counts=True)
    columns = [group == i for i in range(len(_NAMES))]
    columns += [_down((group == i).astype(float), parent, levels) > 0 for i in range(1, len(_NAMES) - 1)]
    columns += [
        np.log1p(chars),
        chars / (1 + tags),  # text per tag
        sums(linked) / np.maximum(chars, 1),
        n_stops / np.maximum(n_words, 1),
        n_words / np.maximum(texts, 1),
        np.log1p(texts),
        sums(group == _P),
        sums(group == _ITEM) / np.maximum(tags, 1),
        sums(group == _HEADING),
        chars / np.maximum(page_chars, 1),
        chars / np.maximum(chars[above], 1),
        around, within,
        _down(around, parent, levels), _down(within, parent, levels),
        sums(around) - around, sums(within) - within,
        sums(np.where(_down(around, parent, levels) > 0, own, 0)) / np.maximum(chars, 1),
        np.array(tree.depth),
        place / np.repeat(size, size),
        siblings, index / siblings, same[inverse], same[inverse] / siblings,
        kin / siblings, chars * siblings / np.maximum(kin, 1),
        chars[above], sums(linked)[above] / np.maximum(chars[above], 1),
    ]
    return np.column_stack(columns).astype(np.float32)


@dataclass
class Boosted:
    """Boosted trees of one depth over binned features, stored level by level."""

    edges: list[np.ndarray]  # of each feature
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # go right above this bin
    value: np.ndarray  # (trees, leaves)
    base: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, edges in enumerate(self.edges):
            out[:, j] = np.searchsorted(edges, x[:, j])
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        x = self.binned(x)
        row, out = np.arange(len(x)), np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
            out += value[node - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, ridge: float = 1.0) -> Boosted:
    """Logistic gradient boosting with Newton leaves; the split of each node has the largest gain."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T] if len(x) else [
        np.zeros(0) for _ in range(x.shape[1])
    ]
    inner, k = 2**DEPTH - 1, x.shape[1]
    share = (y.sum() + 1) / (len(y) + 20)
    model = Boosted(
        edges, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.uint8), np.zeros((0, inner + 1)),
        float(np.log(share / (1 - share))),
    )
    if not len(x):
        return model
    z = model.binned(x)
    flat = z.astype(np.int64) + np.arange(k) * BINS
    score = np.full(len(y), model.base)
    fitted = [[], [], []]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        slope, bend = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.uint8)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            at = (flat + (node - first)[:, None] * (k * BINS)).ravel()
            g, h = (
                np.bincount(at, np.repeat(w, k), width * k * BINS).reshape(width, k, BINS).cumsum(2)
                for w in (slope, bend)
            )
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < 1) | (h_all - h < 1)] = 0
            best = gain.reshape(width, -1).argmax(1)
            split = gain.reshape(width, -1).max(1) > 1e-6
            feature[first : first + width] = best // BINS
            cut[first : first + width] = np.where(split, best % BINS, BINS)
            node = 2 * node + 1 + (z[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + ridge)
        score += value[leaf]
        for held, one in zip(fitted, (feature, cut, value), strict=True):
            held.append(one)
    model.feature, model.cut, model.value = (np.array(v) for v in fitted)
    return model


def decode(score: np.ndarray, fixed: np.ndarray, parent: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The upwards closed set of nodes with the largest sum; ``fixed`` nodes count nothing."""
    gain = np.where(fixed, 0, score)
    total = gain.copy()
    for nodes in levels[:0:-1]:
        np.add.at(total, parent[nodes], np.maximum(total[nodes], 0))
    kept = total > 0
    for nodes in levels[1:]:
        kept[nodes] &= kept[parent[nodes]]
    return kept


def main_texts(pages: list[str | None], model: Boosted) -> list[str]:
    tree = Tree()
    for page in pages:
        tree.read(page)
    parent, levels = _levels(tree)
    fixed = np.array(tree.group) == _BODY
    kept = decode(model.score(features(tree, parent, levels)), fixed, parent, levels)
    parts: list[list[str]] = [[] for _ in pages]
    for i in np.flatnonzero(kept):
        if tree.text[i] is not None:
            parts[tree.page[i]].append(tree.text[i])
    return ["\n\n".join(p) for p in parts]


def extract(pages: DataFrame, model: Boosted) -> DataFrame:
    """The pages with their main text in ``text``."""
    source = pages.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, SLICE, "html"):
            found = main_texts(batch.column("html").to_pylist(), model)
            yield batch.append_column("text", pa.array(found, pa.string()))

    return map_kept(source, run, "text string")


# --- training -----------------------------------------------------------------------


def _sides(tree: Tree) -> tuple[np.ndarray, bool]:
    """Which nodes are article text, and whether an element said so. Without such an element long
    paragraphs without links count."""
    parent, levels = _levels(tree)
    group = np.array(tree.group)
    leaf = np.array([t is not None for t in tree.text])

    def under(names: str) -> np.ndarray:
        wanted = np.isin(group, [_NAMES.index(n) for n in names.split()])
        return _down(wanted.astype(float), parent, levels) > 0

    inside = under("article main")
    said = bool((leaf & inside).any())
    if not said:
        words = np.array([t.count(" ") if t else 0 for t in tree.text])
        inside = (words >= 8) & (np.array(tree.linked) == 0)
    return leaf & inside & ~under("nav aside footer form"), said


def _block(rng: random.Random, text: str, plain: str) -> str:
    text = entities.escape(text)
    kind = rng.random()
    if kind < 0.08:
        return f"<blockquote>{text}</blockquote>"
    if kind < 0.14:
        cut = text.split(". ")
        return "<ul>" + "".join(f"<li>{c}" for c in cut) + "</ul>"
    if kind < 0.2:
        return f"<div>{text}</div>"
    if kind < 0.3:
        half = len(text) // 2
        return f'<p>{text[:half]}<a href="/x">{text[half : half + 12]}</a>{text[half + 12 :]}</p>'
    return f"<{plain}>{text}" + (f"</{plain}>" if rng.random() < 0.8 else "")


def redressed(rng: random.Random, inside: list[str], outside: list[str], others: list[str]) -> str:
    """A page that shows ``inside`` as its article and the rest around it. ``x-part`` marks what is what."""
    pick = rng.choice
    spare = [*outside, *others] or ["Home"]

    def few(low: int, high: int) -> list[str]:
        return [entities.escape(pick(spare)) for _ in range(rng.randint(low, high))]

    def short() -> str:
        return " ".join(few(1, 1)[0].split()[: rng.randint(1, 4)])

    def items() -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{short()}</a></li>' for i in range(rng.randint(2, 12))) + "</ul>"

    def part(opens: list[str], body: str, keep: int = 0) -> str:
        tag, _, rest = pick(opens).partition(" ")
        return f"<{tag} x-part={keep} {rest}>{body}</{tag}>"

    def speech(low: int, high: int) -> str:
        return "".join(f"<{pick(['p', 'div', 'p'])}>{t}" for t in few(low, high))

    def form() -> str:
        return part(
            ["form", 'form class="search"', 'form id="signup"', 'div class="newsletter"'],
            f"<label>{short()}</label><input><button>{short()}</button>" + (speech(0, 1)),
        )

    def advert() -> str:
        names = ["ad", "ads", "advert", "sponsored", "promo", "banner"]
        return part([f'div class="{n}"' for n in names] + ["aside"], pick([speech(1, 2), few(1, 1)[0]]))

    def notice() -> str:
        names = ['div class="cookie-notice"', 'div id="consent"', 'div role="alert"', 'section class="notice"',
                 'div class="popup modal"', 'p class="notice"', 'div class="banner gdpr"']
        return part(names, few(1, 1)[0])

    def menu() -> str:
        return part(["nav", 'ul class="menu"', 'div id="nav"', 'div class="navbar"', 'div role="navigation"',
                     'div class="breadcrumbs"', "div"], items())

    def side() -> str:
        return part(["aside", 'div id="sidebar"', 'div class="sidebar widget"', 'div class="rail"'],
                    f"<h3>{short()}</h3>" + items() + pick(["", speech(1, 2)]))

    def remarks() -> str:
        said = "".join(
            f'<{pick(["li", "div"])} class="{pick(["comment", "reply", "item"])}"><p>{t}</p>' for t in few(1, 5)
        )
        return part(['section id="comments"', 'div class="comments"', 'ol class="commentlist"',
                     'div class="discussion"', 'section class="reader-comments"'],
                    pick(["", f"<h2>{short()}</h2>"]) + said + pick(["", form()]))

    def bottom() -> str:
        return part(["footer", 'div id="footer"', 'div class="site-footer"', 'div class="copyright"',
                     'p class="copyright"'], pick([few(1, 1)[0], items(), "&copy; " + few(1, 1)[0]]))

    def top() -> str:
        return part(["header", 'div id="header"', 'div class="masthead"', 'div class="top-bar"'],
                    pick(["", f"<h1>{short()}</h1>", f"<p>{few(1, 1)[0]}</p>"]) + pick(["", menu()]))

    blocks = [_block(rng, t, "p") for t in inside]
    if blocks and rng.random() < 0.7:
        blocks[0] = f"<{pick(['h1', 'h1', 'h2'])}>{entities.escape(inside[0])}</h1>"
    if rng.random() < 0.2:
        blocks.insert(rng.randint(0, len(blocks)), f"<h2>{entities.escape(pick(inside)[:40])}</h2>")
    for extra in (advert, menu, form, side):
        if rng.random() < 0.12:
            blocks.insert(rng.randint(0, len(blocks)), extra())
    body = part(
        ["article", "main", "article", 'div id="content"', 'div class="post-content"', 'div class="entry"', "section", "div",
         'div class="story-body"', 'div class="article"', 'div itemprop="articleBody"'],
        "".join(blocks), 1,
    )
    for _ in range(rng.randint(0, 2)):
        rest = pick(["", side(), remarks(), advert()])
        body = f'<div class="{pick(["wrap", "row", "container", "page", "main", "x"])}">{body}{rest}</div>'
    before = [f() for f in (top, menu, notice, advert, side) if rng.random() < 0.5]
    after = [f() for f in (remarks, advert, side, form, bottom, notice) if rng.random() < 0.5]
    rng.shuffle(before)
    return f"<html><body>{''.join(before)}{body}{''.join(after)}</body></html>"


def _labelled(tree: Tree, leaves: np.ndarray):
    """Features and labels of all nodes but the roots: does the subtree hold article text?"""
    parent, levels = _levels(tree)
    y = _up(leaves, parent, levels) > 0
    some = np.array(tree.group) != _BODY
    return features(tree, parent, levels)[some], y[some]


def examples(pages: list[tuple[int, str]], layouts: int = LAYOUTS):
    """Features and labels of the nodes of training pages and of their re-dressed copies."""
    xs, ys = [], []
    materials = []
    for _, page in pages:
        tree = Tree()
        tree.read(page)
        leaves, said = _sides(tree)
        texts = [(t, i) for t, i in zip(tree.text, leaves, strict=True) if t]
        materials.append(([t for t, i in texts if i], [t for t, i in texts if not i]))
        if said:
            x, y = _labelled(tree, leaves)
            xs.append(x)
            ys.append(y)
    for k, (number, _) in enumerate(pages):
        inside, outside = materials[k]
        if not inside:
            continue
        others = materials[k - 1][0][:20]  # of another page, so that wording tells nothing
        for layout in range(layouts):
            tree = Tree()
            tree.read(redressed(random.Random(f"{number}:{layout}"), inside[:60], outside, others))
            parent, levels = _levels(tree)
            mark = np.array(tree.mark)
            for nodes in levels[1:]:  # the nearest mark above counts, and dropped stays dropped
                up = mark[parent[nodes]]
                mark[nodes] = np.where((up == 0) | (mark[nodes] < 0), up, mark[nodes])
            leaves = np.array([t is not None for t in tree.text]) & (mark == 1)
            x, y = _labelled(tree, leaves)
            xs.append(x)
            ys.append(y)
    if not xs:
        return np.zeros((0, _width()), np.float32), np.zeros(0, bool)
    return np.concatenate(xs), np.concatenate(ys)


def _width() -> int:
    tree = Tree()
    tree.read("")
    return features(tree, *_levels(tree)).shape[1]


def train(
    pages: DataFrame, *, train_pages: int = TRAIN_PAGES, train_chars: int = TRAIN_CHARS, train_nodes: int = TRAIN_NODES
) -> Boosted:
    """Fit on the pages of the least hashes; tasks make the features, and a bounded sample of them comes here."""
    usable = pages.where(F.length("html").between(1, train_chars)).select(
        F.xxhash64("html").alias("mixed"), "html"
    )
    # only hashes are shuffled to find the sample, however often one page is repeated
    least = usable.groupBy("mixed").agg(F.count(F.lit(1))).orderBy("mixed").limit(train_pages)
    hashes = [r.mixed for r in least.collect()]
    sample = (
        usable.where(F.col("mixed").isin(hashes))
        .groupBy("mixed")
        .agg(F.min("html").alias("html"))
        .orderBy("mixed")
        .limit(train_pages)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch.column("mixed").to_pylist(), batch.column("html").to_pylist(), strict=True))
            for low in range(0, len(rows), 16):
                x, y = examples(rows[low : low + 16])
                yield pa.RecordBatch.from_pydict(
                    {"x": pa.array([x.tobytes()]), "y": pa.array([y.astype(np.uint8).tobytes()])}
                )

    # one sorted task of a bounded sample, so that the model does not depend on the cluster
    made = sample.mapInArrow(run, "x binary, y binary").collect()
    width = _width()
    x = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(r.x, np.float32) for r in made]]).reshape(-1, width)
    y = np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(r.y, np.uint8) for r in made]])
    if len(x) > train_nodes:
        some = np.random.default_rng(0).choice(len(x), train_nodes, replace=False)
        x, y = x[some], y[some]
    return boost(x, y.astype(float))
