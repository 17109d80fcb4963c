"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of its block elements; runs of inline content are its leaves. Every
node is described by its subtree (text, links, markup density, paragraphs, punctuation),
its tag and attribute tokens, those of its ancestors, its depth and its place among its
siblings. Trees give each node the log-odds of holding main text. Decoding picks the set
of nodes with the largest sum in which a node is only taken with its parent; so a leaf is
never kept inside something dropped, nor a container kept without anything in it.

The trees are fitted on pages whose answer is known: layouts composed here from common
patterns with prose from a bounded sample of the given pages, and that sample itself where
its markup says which part is the article. No page's answer is looked up when scoring.

Cases: a null or empty html gives an empty text. Broken markup is read the way browsers do
in the common cases: unclosed paragraphs and list items end at the next, unknown or
unmatched end tags are skipped, a page that ends inside a tag loses that tag only. Repeated
pages give the same text each. Only page_id, url and html are read.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm import trees
from riskspark.llm.layouts import compose
from riskspark.llm.text import slices

#: Pages the trees are fitted on at most, of the given ones and of composed ones.
FIT_PAGES, COMPOSED = 100, 300

# Fixed values of the HTML standard: elements without content, raw text, and blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select button object".split())
BLOCKS = (
    "html body div article main section nav header footer aside form p ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary fieldset dialog menu center hgroup"
).split()
_TAG_ID = {t: i for i, t in enumerate(["#run", "head", *BLOCKS])}
#: A start tag on the left ends open elements on the right, up to one that holds both.
_ENDS_P = frozenset(BLOCKS) - {"html", "body", "td", "th", "caption", "summary", "figcaption"}
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = frozenset("ul ol menu dl table tr html body".split())

#: Attribute tokens that speak against main text, and for it.
AGAINST = (
    "ad ads advert advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs header "
    "masthead footer sidebar aside widget related recommended share sharing social comment comments reply replies discussion "
    "cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login search form pagination pager "
    "tags meta byline copyright legal disclaimer toolbar skip hidden"
).split()
FOR = "article content main post entry story text body prose page markdown copy".split()
_AGAINST, _FOR = frozenset(AGAINST), frozenset(FOR)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
_PART = re.compile(r"[a-z]+", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_MARKS = re.compile(r"[.,;:!?]")


def _tokens(attrs: str) -> set[str]:
    out: set[str] = set()
    for _, a, b, c, hidden in _ATTR.findall(attrs):
        out.update(x.lower() for x in _PART.findall(_CAMEL.sub(" ", a or b or c)))
        if hidden:
            out.add("hidden")
    return out


class Page:
    """The blocks of a page in document order; ``end[k]`` is behind the last node under k."""

    def __init__(self, source: str):
        self.tag: list[int] = [_TAG_ID["html"]]
        self.parent, self.end, self.depth = [-1], [0], [0]
        self.tokens: list[set[str]] = [set()]
        self.text: list[str] = [""]
        self.linked, self.inline = [0], [0]
        self._open: list[tuple[str, int]] = [("html", 0)]
        self._run: list[str] = []
        self._links, self._marks, self._in_link = 0, 0, 0
        self._read(source)
        while self._open:
            self._close()

    def _node(self, tag: int, tokens: set[str]) -> int:
        up = self._open[-1][1]
        for column, value in ((self.tag, tag), (self.parent, up), (self.end, 0), (self.depth, self.depth[up] + 1), (self.tokens, tokens), (self.text, ""), (self.linked, 0), (self.inline, 0)):
            column.append(value)
        return len(self.tag) - 1

    def _flush(self) -> None:
        text = " ".join("".join(self._run).split())
        if text:
            k = self._node(0, set())
            self.text[k], self.end[k] = text, k + 1
            self.linked[k], self.inline[k] = min(self._links, len(text)), self._marks
        self._run, self._links, self._marks = [], 0, 0

    def _close(self) -> None:
        self._flush()
        _, k = self._open.pop()
        self.end[k] = len(self.tag)

    def _say(self, text: str) -> None:
        if text:
            text = _html.unescape(text)
            self._run.append(text)
            if self._in_link:
                self._links += len(text)

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = _TOKEN.search(source, at)
            if m is None:
                self._say(source[at:])
                return
            self._say(source[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["end"]:
                self._end(tag)
            elif tag in RAW and not m["attrs"].rstrip().endswith("/"):
                shut = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(source, at)
                at = shut.end() if shut else (n if tag in ("script", "style", "textarea", "title") else at)
            else:
                self._start(tag, m["attrs"])

    def _start(self, tag: str, attrs: str) -> None:
        if tag in ("br", "hr"):
            self._run.append(" ")
            if tag == "br":
                return
        if tag in VOID:
            return
        if tag == "a":
            self._in_link = 1
        if tag not in _TAG_ID:
            self._marks += 1
            return
        if tag in ("html", "body") and any(t == tag for t, _ in self._open):
            self.tokens[next(k for t, k in self._open if t == tag)] |= _tokens(attrs)
            return
        self._flush()
        self._in_link = 0 if tag != "a" else 1
        if tag in _ENDS_P and self._open[-1][0] == "p":
            self._close()
        ends = _ENDS.get(tag)
        if ends:
            for depth in range(len(self._open) - 1, 0, -1):
                if self._open[depth][0] in ends:
                    while len(self._open) > depth:
                        self._close()
                    if tag != "tr":
                        break
                elif self._open[depth][0] in _HOLDS - {tag}:
                    break
        k = self._node(_TAG_ID[tag], _tokens(attrs))
        self._open.append((tag, k))

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._in_link = 0
        elif tag in _TAG_ID and tag not in ("html", "body"):
            for depth in range(len(self._open) - 1, 0, -1):
                if self._open[depth][0] == tag:
                    while len(self._open) > depth:
                        self._close()
                    return


_FLAGS = 4  # against by token, for by token, against by tag, for by tag
_AGAINST_TAGS = frozenset(_TAG_ID[t] for t in ("nav", "header", "footer", "aside", "form", "head", "menu", "dialog"))
_FOR_TAGS = frozenset(_TAG_ID[t] for t in ("article", "main"))
_P = _TAG_ID["p"]
_HEADINGS = tuple(_TAG_ID[f"h{i}"] for i in range(1, 7))


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row per node of all pages, parent of each, end of each), numbered through."""
    sizes = [len(p.tag) for p in pages]
    base = np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes).astype(np.int64)
    flat = lambda name: np.array([x for p in pages for x in getattr(p, name)])
    tag, depth = flat("tag"), flat("depth").astype(float)
    parent, end = flat("parent") + base, flat("end") + base
    parent = np.where(flat("parent") < 0, base, parent)
    texts = [t for p in pages for t in p.text]
    own = np.array(
        [(len(t), t.count(" ") + 1 if t else 0, len(_MARKS.findall(t)), 1 if t else 0) for t in texts], float
    ).reshape(-1, 4)
    own = np.column_stack([own, flat("linked"), flat("inline"), np.isin(tag, (_P,)), np.isin(tag, _HEADINGS), tag == _TAG_ID["li"]])
    total = np.concatenate([np.zeros((1, own.shape[1])), own.cumsum(axis=0)])
    k = np.arange(len(tag))
    sub = total[end] - total[k]
    nodes = (end - k).astype(float)
    flags = np.array(
        [(bool(t & _AGAINST), bool(t & _FOR), g in _AGAINST_TAGS, g in _FOR_TAGS) for p in pages for t, g in zip(p.tokens, p.tag, strict=True)], float
    ).reshape(-1, _FLAGS)
    above = np.zeros((len(tag), _FLAGS))  # among ancestors; parents come before children
    for level in range(1, int(depth.max(initial=0)) + 1):
        here = np.flatnonzero(depth == level)
        above[here] = np.maximum(above[parent[here]], flags[parent[here]])
    whole = sub[base]
    length, words = np.maximum(sub[:, 0], 1), np.maximum(sub[:, 1], 1)
    up = sub[parent]
    children = np.bincount(parent[k != parent], minlength=len(tag)).astype(float)
    first_of = np.full(len(tag), len(tag), np.int64)
    np.minimum.at(first_of, parent[k != parent], k[k != parent])
    order = np.argsort(parent, kind="stable")
    place = np.empty(len(tag))
    place[order] = np.arange(len(tag)) - np.searchsorted(parent[order], parent[order])
    same = np.unique(parent * 1000 + tag, return_inverse=True)[1].reshape(-1)
    alike = np.bincount(same)[same].astype(float)
    columns = [
        np.log1p(sub[:, 0]), sub[:, 4] / length, sub[:, 0] / nodes, sub[:, 2] / words, sub[:, 0] / words, np.log1p(sub[:, 6]),
        np.log1p(sub[:, 7]), sub[:, 8] / nodes, sub[:, 5] / words, sub[:, 0] / np.maximum(whole[:, 0], 1), sub[:, 0] / np.maximum(up[:, 0], 1),
        up[:, 4] / np.maximum(up[:, 0], 1), np.log1p(up[:, 0] / np.maximum(up[:, 3], 1)), depth, nodes, children, place, alike, children[parent],
        (k - base) / np.maximum(end[base] - base, 1), *flags.T, *above.T, *flags[parent].T,
        *(tag == i for i in range(len(_TAG_ID))), *(tag[parent] == i for i in range(len(_TAG_ID))),
    ]
    return np.column_stack(columns).astype(np.float32), parent, end


def decode(odds: np.ndarray, parent: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which nodes are taken: the best sum of log-odds with every node's parent taken too."""
    gain = odds.tolist()
    up = parent.tolist()
    for k in range(len(gain) - 1, -1, -1):  # children come after their parent
        if up[k] != k and gain[k] > 0:
            gain[up[k]] += gain[k]
    taken = [False] * len(gain)
    for k in range(len(gain)):
        taken[k] = up[k] == k or (taken[up[k]] and gain[k] > 0)
    return np.array(taken, bool)


def extract(sources: list[str], model: trees.Trees) -> list[str]:
    """The main text of each page."""
    pages = [Page(s) for s in sources]
    if not pages:
        return []
    x, parent, end = features(pages)
    taken = decode(np.clip(model.raw(x), -8, 8), parent, end)
    out, at = [], 0
    for p in pages:
        out.append("\n".join(t for t, keep in zip(p.text, taken[at : at + len(p.text)], strict=True) if keep and t))
        at += len(p.text)
    return out


def _known(page: Page, marked: bool) -> np.ndarray:
    """1, 0 or -1 (not known) for each node of a page with an answer.

    In composed pages the token ``answer`` marks main containers and ``noise`` what is to
    go; in given ones the article element and the tags and tokens against main text do.
    """
    n = len(page.tag)
    inside, out = np.zeros(n, bool), np.zeros(n, bool)
    for k in range(n):
        up, t, g = page.parent[k], page.tokens[k], page.tag[k]
        good = "xanswer" in t if marked else g in _FOR_TAGS
        bad = "xnoise" in t if marked else g in _AGAINST_TAGS or bool(t & _AGAINST)
        inside[k] = good or (up >= 0 and inside[up])
        out[k] = bad or (up >= 0 and out[up])
    leaf = np.array([bool(t) for t in page.text])
    held = np.concatenate([[0], np.cumsum(inside & ~out & leaf)])
    label = (held[np.array(page.end)] > held[:-1]).astype(int)
    return label if marked or inside.any() else np.full(n, -1)


def fit(pages: DataFrame, most: int = FIT_PAGES, composed: int = COMPOSED) -> trees.Trees:
    """The model, from at most ``most`` given pages and so many composed ones."""
    turn = F.xxhash64("page_id", "url")
    chosen = pages.where("html is not null").select(turn.alias("turn")).orderBy("turn").limit(most).distinct()
    # so many hashes at most, which is why they may be broadcast; pages travel for these alone
    picked = pages.where("html is not null").select(turn.alias("turn"), "html").join(F.broadcast(chosen), "turn")
    rows = picked.select("html").limit(most).collect()
    given = [Page(r[0]) for r in rows]
    prose = [t for p in given for t in p.text if len(t) > 20][:2000]
    drawn = [Page(s) for s in compose(composed, prose)]
    known = [_known(p, True) for p in drawn] + [_known(p, False) for p in given]
    for p in drawn:
        p.tokens = [t - {"xanswer", "xnoise"} for t in p.tokens]
    x, _, _ = features(drawn + given)
    y = np.concatenate(known)
    return trees.fit(x[y >= 0], y[y >= 0].astype(float), trees=40, depth=4, rate=0.3, bins=16)


def main_text(pages: DataFrame, model: trees.Trees) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)
    pages = pages.select("page_id", "url", "html")
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"]]).add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                text = extract([s or "" for s in part["html"].to_pylist()], sent.value)
                size = pa.array([len(t) for t in text], pa.int64())
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(text, pa.string()), size], schema.names)

    return pages.mapInArrow(run, schema)
