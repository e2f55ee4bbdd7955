"""Main text of web pages by a tree-structured graphical model.

Every DOM element has a hidden label, content or not.  A log-linear score of
the element's own features (tag, words of its class, id and role; its
parent's tag; of the text within it the length, its and its parent's share of
the page's, that in links, and how many sentence marks it has) and potentials between parent and child make up the
model; its graph is the DOM tree, so sum-product messages, once upward
and once downward, give exact marginals.  The weights are fitted to labelled
pages by the gradient of the likelihood.  A text is kept where its element's
marginal is above a half.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import map_batches, pick
from medallion.llm.labelled_pages import CONTENT, labelled_pages

# The elements of HTML that have no end tag, whose content is
# raw to their end tag and isn't shown, that start a new block, that end an
# open element of the kinds listed when they start, and that hold another
# language: a block ends it, unless it is within an element that holds HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea template iframe noframes".split())
BLOCK = set(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul xmp".split()
)
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",),
}
_NO_P = BLOCK - set("body br button caption dd dt head html label legend li option select td th tr tbody thead tfoot".split())
FOREIGN = ("svg", "math")
_HOLDS_HTML = ("foreignobject", "desc", "annotation-xml", "mi", "mo", "mn", "ms", "mtext")
_WITHIN = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",)}

_TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|%s)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""" % CONTENT, re.I)
_TOKEN = re.compile(r"[a-z]+")
LINK_SHARES = (0.0, 0.25, 0.6, 0.95)
PAGE_SHARES = (0.0, 0.02, 0.1, 0.3, 0.6, 0.9)
MARKS = (0.0, 0.4, 0.8, 1.5, 3.0)  # in a hundred characters
SIZES = 14  # of texts, by powers of two
PLAIN = set("html body div span section table tbody tr td center font b i em strong".split())  # tags that say nothing
SAME = 30.0  # log-odds that an element with all of its parent's text has its label
LEAST = 3  # elements that a word of a class, id or role is learned from


class Dom:
    """The elements and texts of pages, one page after the other."""

    def __init__(self):
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.tag: list[str] = []
        self.words: list[tuple[str, ...]] = []
        self.labels: list[int] = []
        self.own: list[int] = []  # characters of text
        self.marks: list[int] = []  # that end a sentence or part it
        self.root: list[int] = []  # the page's first element
        self.texts: list[list[tuple[int, str]]] = []  # by page: (element or -1, text)

    def _add(self, parent: int, tag: str, attrs: str) -> int:
        words: list[str] = []
        label = self.labels[parent] if parent >= 0 else 0
        if attrs and tag != "a":
            for m in _NAMED.finditer(attrs):
                value = (m[2] or m[3] or m[4] or "").lower()
                if m[1].lower() == CONTENT:
                    label = int(value == "1")
                else:
                    words += _TOKEN.findall(value)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.words.append(tuple(words))
        self.labels.append(label)
        self.own.append(0)
        self.marks.append(0)
        self.root.append(self.root[parent] if parent >= 0 else len(self.parent) - 1)
        return len(self.parent) - 1

    def page(self, html: str) -> None:
        out: list[tuple[int, str]] = []
        self.texts.append(out)
        stack = [self._add(-1, "#page", "")]
        at, tags, foreign = 0, self.tag, False
        places: dict[str, list[int]] = {}  # of the open elements in the stack, by tag

        def text(raw: str) -> None:
            if raw:
                s = unescape(raw) if "&" in raw else raw
                out.append((stack[-1], s))
                self.own[stack[-1]] += len(s.strip())
                self.marks[stack[-1]] += s.count(".") + s.count(",") + s.count("?") + s.count("!")

        def last(kinds: tuple[str, ...]) -> int:
            return max((places[k][-1] for k in kinds if places.get(k)), default=0)

        def end(kinds: tuple[str, ...], within: tuple[str, ...] = ()) -> None:
            """Close the innermost element of the kinds, and what is in it,
            unless it is outside of an open element of ``within``."""
            if (i := last(kinds)) > last(within):
                for open_ in stack[i:]:
                    places[tags[open_]].pop()
                del stack[i:]

        while m := _TAG.search(html, at):
            text(html[at : m.start()])
            at = m.end()
            if not (tag := m["tag"]):
                continue
            tag = tag.lower()
            if tag in BLOCK:
                out.append((-1, " "))
            if m["close"]:
                if tag not in VOID:
                    end((tag,), _WITHIN.get(tag, ("td", "th", "article") if tag not in BLOCK else ()))
                continue
            attrs = m["attrs"] or ""
            if tag in RAW:
                # to its end tag, whatever is written before
                if not attrs.endswith("/"):
                    close = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(html, at)
                    at = close.end() if close else len(html)
                continue
            foreign = foreign or tag in FOREIGN
            if foreign and tag in BLOCK:
                end(FOREIGN, _HOLDS_HTML)
            for kind in ENDS.get(tag, ()):
                end((kind,), _WITHIN.get(tag, ()))
            if tag in _NO_P:
                end(("p",), ("td", "th", "button", "li"))
            node = self._add(stack[-1], tag, attrs)
            closed = foreign and attrs.endswith("/") and (tag in FOREIGN or last(FOREIGN) > 0)
            if tag not in VOID and not closed:
                places.setdefault(tag, []).append(len(stack))
                stack.append(node)
        text(html[at:])

    def arrays(self) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """Parents, the elements of each depth, and of each element's subtree
        all characters and (characters in links, sentence marks)."""
        parent, depth = np.array(self.parent, np.int64), np.array(self.depth, np.int64)
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
        chars = np.array(self.own, np.float64)
        link, marks = np.zeros_like(chars), np.array(self.marks, np.float64)
        is_link = np.array([t == "a" for t in self.tag])
        for level in reversed(levels):
            link[level] = np.where(is_link[level], chars[level], link[level])
            up = parent[level]
            if up[0] >= 0:
                np.add.at(chars, up, chars[level])
                np.add.at(link, up, link[level])
                np.add.at(marks, up, marks[level])
        return parent, levels, chars, np.stack([link, marks])


class Model:
    """Weights of a vocabulary of features, and of parent-child potentials by
    the child's tag.  An unknown tag's are how often all elements have their
    parent's label."""

    def __init__(self, tags: list[str], words: list[str]):
        self.tags = {t: i for i, t in enumerate(["?", *tags])}
        n = len(self.tags)
        self.words = {w: n + i for i, w in enumerate(words)}
        self.first = n + len(words)
        self.unary = np.zeros(self.first + len(LINK_SHARES) + 2 * len(PAGE_SHARES) + len(MARKS) + 4 + SIZES + 1 + n)
        self.pair = np.zeros((n, 2, 2))

    def features(self, dom: Dom, chars: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Kind of each element: its tag, or -1 if it has all of its parent's
        text and so its label; (element, feature) pairs.  Such an element only
        adds what its tag and words say: the text counts once."""
        tag = np.array([self.tags.get(t, 0) for t in dom.tag])
        own = [(i, f) for i, ws in enumerate(dom.words) if ws for w in set(ws) if (f := self.words.get(w))]
        extra = np.array(own, np.int64).reshape(-1, 2)
        first, of_text, text = self.first, [], np.maximum(1, chars)
        page = np.maximum(1, chars[np.array(dom.root, np.int64)])
        above = np.maximum(np.array(dom.parent, np.int64), 0)
        for cuts, value in ((LINK_SHARES, link[0] / text), (PAGE_SHARES, chars / page), (PAGE_SHARES, chars[above] / page), (MARKS, 100 * link[1] / text)):
            of_text.append(first + np.searchsorted(cuts, value))
            first += len(cuts) + 1
        of_text.append(first + np.minimum(SIZES, np.log2(chars + 1)).astype(np.int64))
        of_text.append(first + SIZES + 1 + tag[above])
        same = (np.array(dom.parent) >= 0) & (chars == chars[above]) & (chars > 0)
        new, told = np.flatnonzero(~same), np.flatnonzero(~same | np.array([t not in PLAIN for t in dom.tag]))
        row = np.concatenate([told, *[new] * len(of_text), extra[:, 0]])
        return np.where(same, -1, tag), row, np.concatenate([tag[told], *[f[new] for f in of_text], extra[:, 1]])

    def marginals(self, parent: np.ndarray, levels: list[np.ndarray], tag: np.ndarray, unary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product over all trees at once: P(content) of each element, and
        the joint of each with its parent (parent's label first)."""
        score = np.zeros((len(parent), 2))
        score[:, 1] = unary
        pair = np.concatenate([self.pair, [[[0.0, -SAME], [-SAME, 0.0]]]])  # the last is kind -1's
        up = np.zeros((len(parent), 2))  # message to the parent
        below = score.copy()  # with all messages from children
        for level in reversed(levels[1:]):
            m = _log_sum(pair[tag[level]] + below[level][:, None, :], 2)
            up[level] = m - m.max(1, keepdims=True)
            np.add.at(below, parent[level], up[level])
        belief = below.copy()
        joint = np.zeros((len(parent), 2, 2))
        for level in levels[1:]:
            rest = belief[parent[level]] - up[level]  # the parent without this child
            j = rest[:, :, None] + pair[tag[level]] + below[level][:, None, :]
            j -= _log_sum(_log_sum(j, 2), 1)[:, None, None]
            joint[level] = np.exp(j)
            down = _log_sum(rest[:, :, None] + pair[tag[level]], 1)
            belief[level] = below[level] + down - down.max(1, keepdims=True)
        belief -= _log_sum(belief, 1)[:, None]
        return np.exp(belief[:, 1]), joint

    def fit(self, dom: Dom, steps: int = 300, rate: float = 0.1, prior: float = 0.01) -> Model:
        """Adam on the log-likelihood of the elements' labels."""
        parent, levels, chars, link = dom.arrays()
        tag, row, feature = self.features(dom, chars, link)
        y = np.array(dom.labels)
        for level in reversed(levels[1:]):  # one text has one label: the innermost element's
            one = level[tag[level] < 0]
            y[parent[one]] = y[one]
        child = np.flatnonzero((parent >= 0) & (tag >= 0))
        seen = np.zeros_like(self.pair)
        np.add.at(seen, (tag[child], y[parent[child]], y[child]), 1)
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (self.unary, self.pair)]
        for t in range(1, steps + 1):
            p, joint = self.marginals(parent, levels, tag, np.bincount(row, self.unary[feature], len(tag)))
            expected = np.zeros_like(self.pair)
            np.add.at(expected, tag[child], joint[child])
            g = [np.bincount(feature, (y - p)[row], len(self.unary)) - prior * self.unary, seen - expected - prior * self.pair]
            for w, d, m in zip((self.unary, self.pair), g, moments, strict=True):
                m[0] += 0.1 * (d - m[0])
                m[1] += 0.01 * (d * d - m[1])
                w += rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-8)
        n = seen.sum(0) + 1
        self.pair[0] = np.log(n / n.sum(1, keepdims=True))
        return self

    def extract(self, pages: list[str]) -> list[str]:
        """The main text of each page."""
        dom = Dom()
        for html in pages:
            dom.page(html)
        if not pages:
            return []
        parent, levels, chars, link = dom.arrays()
        tag, row, feature = self.features(dom, chars, link)
        p, _ = self.marginals(parent, levels, tag, np.bincount(row, self.unary[feature], len(tag)))
        keep = (p > 0.5).tolist()
        return [" ".join("".join([s for i, s in texts if i < 0 or keep[i]]).split()) for texts in dom.texts]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(*np.moveaxis(x, axis, 0))


def train(pages: list[str]) -> Model:
    """From pages whose elements bear the label attribute (``CONTENT``); an
    element without it has its parent's label."""
    dom = Dom()
    for html in pages:
        dom.page(html)
    seen = Counter(w for ws in dom.words for w in set(ws))
    return Model(sorted({*dom.tag}), sorted(w for w, n in seen.items() if n >= LEAST)).fit(dom)


@functools.lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages())


_AT_ONCE = 2 << 20  # characters of pages whose trees are searched together


def main_text(pages: DataFrame, model: Model | None = None, html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Null and empty pages, and pages without content, have an empty text.
    Character references are decoded, white space within a block becomes one
    blank and blocks are joined by one in page order.  Unclosed elements end
    where the next one of their kind, or their parent, does.  Very long pages
    are parsed in time that grows with their length, and held by one task.
    Repeated rows give a row each; an empty table none.  Extra columns are left
    out.
    """
    model = model or default_model()
    own = pick(pages, page_id="page_id", url="url", html=html_col).withColumn("html", F.coalesce(F.col("html").cast("string"), F.lit("")))

    def fn(batch: pa.RecordBatch) -> dict:
        texts, part, size = [], [], 0
        for html in batch.column(2).to_pylist():
            part.append(html)
            size += len(html)
            if size > _AT_ONCE:
                texts += model.extract(part)
                part, size = [], 0
        texts += model.extract(part)
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(own.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html"), fn, "page_id long, url string, text string, n_chars long")
