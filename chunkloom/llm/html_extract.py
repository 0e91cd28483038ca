"""Main text of web pages by a tree-structured graphical model over the DOM.

Every block element is a node that is content or not.  A node has a potential from
its own features (tag, words of its class and id, length, links, punctuation), and
one with its parent.  Messages go up the tree and down again, and each node's
marginal says whether its own text is kept.

The model is learned from pages that mark their article themselves (``article`` or
``main``), a bounded sample: potentials of nodes by logistic regression around prior
weights, so that tags and names no page of the sample has keep their usual meaning,
and potentials of parent and child by smoothed counts.

Defined cases: a null or empty page has empty text; broken markup is read as far as
it goes, unclosed elements end with their parent; an unclosed script, style, title, textarea
or iframe takes the rest of the page, any other element that is left out whole the text up
to the next block or the end of its parent; from the first quote of a tag that never ends on,
quotes mean nothing and tags end at the next ``>``; what follows a last ``<`` without one is
text; a page takes time in proportion to its length; without any page that marks its
article the prior weights alone decide; ids may be null or repeated.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About so many pages are learned from, chosen by a hash of id and address.
SAMPLE = 2_000
#: At most so many nodes of them go to the driver, the first by a hash.
NODES = 500_000

# Kinds of elements in HTML.
BLOCKS = frozenset(
    """html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody
    tfoot tr td th caption blockquote pre figure figcaption nav header footer aside form fieldset
    legend label button select option details summary address hr center dialog menu head""".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object canvas".split())
TO_THE_END = frozenset("script style title textarea iframe".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = frozenset("html body article main section div table ul ol dl nav header footer aside form blockquote".split())

# What tags and the words of classes and ids usually mean, as log-odds.
PRIOR = {
    "bias": -0.5, "tag:article": 3.0, "tag:main": 2.0, "tag:p": 1.0, "tag:pre": 1.0,
    "tag:blockquote": 1.0, "tag:h1": 1.0, "tag:h2": 1.0, "tag:h3": 1.0, "tag:nav": -4.0, "tag:footer": -4.0, "tag:aside": -4.0,
    "tag:header": -2.0, "tag:form": -4.0, "tag:button": -4.0, "tag:select": -4.0,
    "tag:option": -4.0, "tag:label": -3.0, "tag:menu": -4.0, "tag:dialog": -4.0,
    "tag:head": -4.0, "good": 2.5, "bad": -9.0, "length": 0.15, "links": -2.0, "stops": 0.3,
}
GOOD = frozenset("article content entry post story main body text page".split())
BAD = frozenset(
    """ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion nav
    navigation navbar menu breadcrumb breadcrumbs header masthead footer sidebar aside widget
    related recommended share sharing social comment comments reply replies respond disqus cookie
    cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login
    search form pagination pager toolbar copyright legal disclaimer""".split()
)
DENSE = ("length", "links", "stops")
FEATURES = (
    "bias", *(f"tag:{t}" for t in sorted(BLOCKS)), "tag:other", "good", "bad", *DENSE
)

_BEGIN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_REST = re.compile(r"([^>]*+)>")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-zA-Z]+")
_STOP = re.compile(r"[.,;:!?]")


class Page:
    """Nodes of a page in order, parents first, and its pieces of text.

    ``nodes`` are ``[parent, tag, good, bad, characters, linked characters,
    stops, inside the marked article]``, ``texts`` are ``(node, block, text)``.
    """

    def __init__(self, source: str):
        self.nodes: list[list] = [[-1, "html", False, False, 0, 0, 0, False]]
        self.texts: list[tuple[int, int, str]] = []
        self.marked = False
        self._open: list[tuple[str, int]] = [("html", 0)]  # element and the node it belongs to
        self._links, self._block, self._muted = 0, 0, 0
        at, rest, unclosed = 0, _REST, set()
        while (begin := _BEGIN.search(source, at)) is not None:
            name = begin[3]
            if begin[1]:
                end = source.find("-->", begin.end())
                stop = len(source) if end < 0 else end + 3
            else:
                tag = (rest if name else _PLAIN_REST).match(source, begin.end())
                if tag is None and name and rest is _REST:
                    # Read so only once: to fail takes a look at all that follows.
                    rest = _PLAIN_REST
                    tag = rest.match(source, begin.end())
                if tag is None:
                    break
                stop = tag.end()
            if begin.start() > at:
                self._text(source[at : begin.start()])
            at = stop
            if name is None:
                continue
            name = name.lower()
            if begin[2]:
                self._end(name)
            elif name not in RAW:
                self._start(name, tag[1])
            elif not tag[1].endswith("/"):
                end = None
                if name not in unclosed:
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                if end:
                    at = end.end()
                elif name in TO_THE_END:
                    at = len(source)
                else:
                    unclosed.add(name)
                    self._muted = len(self._open)
        if at < len(source):
            self._text(source[at:])

    def _text(self, raw: str) -> None:
        if self._muted:
            return
        text = html.unescape(raw) if "&" in raw else raw
        node = self._open[-1][1]
        self.texts.append((node, self._block, text))
        n, row = len(text), self.nodes[node]
        row[4] += n
        row[5] += n if self._links else 0
        row[6] += len(_STOP.findall(text))

    def _start(self, name: str, attributes: str) -> None:
        block = name in BLOCKS
        if block:
            self._muted = 0
        if block and name != "hr":
            ends = CLOSED_BY.get(name, set()) | {"p"}
            for depth in range(len(self._open) - 1, 0, -1):
                open_name = self._open[depth][0]
                if open_name in ends:
                    self._close(depth)
                    break
                if open_name in SCOPE:
                    break
        if name in VOID:
            if block:
                self._block += 1
            elif name == "br":
                self.texts.append((self._open[-1][1], self._block, " "))
            return
        node = self._open[-1][1]
        words = (
            {w.lower() for m in _NAMED.finditer(attributes) for w in _WORD.findall(m[2] or m[3] or m[4] or "")}
            if attributes
            else set()
        )
        good, bad = not GOOD.isdisjoint(words), not BAD.isdisjoint(words)
        if name == "html":
            return
        if block or good or bad:
            mark = name in ("article", "main")
            self.marked = self.marked or mark
            inside = (self.nodes[node][7] or mark) and not bad and PRIOR.get(f"tag:{name}", 0) > -2
            self.nodes.append([node, name, good, bad, 0, 0, 0, inside])
            node = len(self.nodes) - 1
        self._block += block
        self._links += name == "a"
        self._open.append((name, node))

    def _end(self, name: str) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth][0] == name:
                self._close(depth)
                return
            if name not in BLOCKS and self._open[depth][0] in SCOPE:
                return

    def _close(self, depth: int) -> None:
        for name, _ in self._open[depth:]:
            self._block += name in BLOCKS
            self._links -= name == "a"
        del self._open[depth:]
        if depth < self._muted:
            self._muted = 0


def dense(node: list) -> tuple[float, float, float]:
    """Log length, share of linked text, stops for each hundred characters (3 at most)."""
    n = node[4]
    if not n:
        return 0.0, 0.0, 0.0
    return math.log1p(n), node[5] / n, min(3.0, 100.0 * node[6] / n)


def opens(tag: str, good: bool) -> bool:
    """May the node be content below one that is not?"""
    return good or tag in ("article", "main")


class Model:
    """Weights of the features and the chances of a child's state given its parent's."""

    def __init__(self, weights: dict[str, float], child: list, share: float):
        """``child[opens][parent][state]``: separate chances for nodes that may open an article."""
        self.weights, self.child = weights, child
        self.base = math.log(share / (1 - share))

    def own(self, node: list) -> float:
        """A node's log-odds from its features, without the share of content in general."""
        w = self.weights
        length, links, stops = dense(node)
        score = w["bias"] + w.get(f"tag:{node[1]}", w["tag:other"])
        score += w["length"] * length + w["links"] * links + w["stops"] * stops
        score += (w["good"] if node[2] else 0.0) + (w["bad"] if node[3] else 0.0)
        return max(-20.0, min(20.0, score - self.base))

    def marginals(self, nodes: list[list]) -> list[float]:
        """Log-odds of each node being content, by sum-product up and down the tree."""
        exp, log = math.exp, math.log
        kinds = [opens(x[1], x[2]) for x in nodes]
        total = [self.own(x) for x in nodes]
        up = [0.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            (a, b), (c, d) = self.child[kinds[i]]
            odds = exp(max(-30.0, min(30.0, total[i])))
            up[i] = log((c + d * odds) / (a + b * odds))
            total[nodes[i][0]] += up[i]
        for i in range(1, len(nodes)):
            (a, b), (c, d) = self.child[kinds[i]]
            odds = exp(max(-30.0, min(30.0, total[nodes[i][0]] - up[i])))
            total[i] += log((b + d * odds) / (a + c * odds))
        return total

    def text(self, source: str) -> str:
        page = Page(source)
        keep = self.marginals(page.nodes)
        blocks: dict[int, list[str]] = {}
        for node, block, text in page.texts:
            if keep[node] > 0:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(x for x in lines if x)


def _labelled_nodes(batches: Iterator) -> Iterator:
    import pyarrow as pa

    kinds = {"tag": pa.string(), "good": pa.bool_(), "bad": pa.bool_(), "inside": pa.bool_(), "above": pa.bool_()}
    for batch in batches:
        rows = []
        for source in batch.column(0):
            page = Page(source.as_py() or "")
            if page.marked:
                rows += [
                    (x[1], x[2], x[3], x[7], page.nodes[x[0]][7] if x[0] >= 0 else None, *dense(x))
                    for x in page.nodes
                ]
        columns = list(zip(*rows)) or [()] * 8
        types = [*kinds.values(), *[pa.float64()] * 3]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=[*kinds, *DENSE]
        )


def train(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from the pages of the sample that mark their article."""
    import numpy as np

    share = min(1.0, sample / max(pages.count(), 1))
    chosen = pages.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20)) < int(share * (1 << 20)))
    found = (chosen if share < 1 else pages).select("html").mapInArrow(
        _labelled_nodes,
        "tag string, good boolean, bad boolean, inside boolean, above boolean, "
        "length double, links double, stops double",
    )
    # Pages that share an id come in together, and one page may be huge: the bound is on nodes.
    rows = found.orderBy(F.xxhash64(*found.columns)).limit(NODES).toPandas()
    prior = np.array([PRIOR.get(f, 0.0) for f in FEATURES])
    child = np.array([[[99.0, 1.0], [1.0, 9.0]], [[1.0, 1.0], [1.0, 9.0]]])
    weights, content = prior.copy(), 0.5
    if len(rows):
        at = {f: i for i, f in enumerate(FEATURES)}
        x = np.zeros((len(rows), len(FEATURES)))
        x[:, at["bias"]] = 1
        tags = rows["tag"].map(lambda t: at.get(f"tag:{t}", at["tag:other"])).to_numpy()
        x[np.arange(len(rows)), tags] = 1
        for name in ("good", "bad", *DENSE):
            x[:, at[name]] = rows[name].to_numpy(float)
        y = rows["inside"].to_numpy(float)
        for _ in range(12):  # Newton steps to the mode of the posterior
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            gradient = x.T @ (y - p) - (weights - prior)
            curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(FEATURES))
            weights = weights + np.linalg.solve(curve, gradient)
        below = rows[rows["above"].notna()]
        kind = np.array([opens(t, g) for t, g in zip(below["tag"], below["good"])], dtype=bool)
        above, inside = below["above"].astype(bool).to_numpy(), below["inside"].astype(bool).to_numpy()
        for k, a, b in np.ndindex(2, 2, 2):
            child[k, a, b] += ((kind == k) & (above == a) & (inside == b)).sum()
        content = float(np.clip(y.mean(), 0.05, 0.95))
    # Content may hold an exception, one in fifty at least; what is not content hardly does.
    child = child / child.sum(axis=2, keepdims=True)
    child[:, 1] = np.clip(child[:, 1], 0.02, 0.98)
    child[:, 0] = np.clip(child[:, 0], 0.001, 0.999)
    return Model(dict(zip(FEATURES, weights.tolist())), child.tolist(), content)


def _extract(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value
        for batch in batches:
            texts = [model.text(x.as_py() or "") for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def extract_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A row for each page: ``(page_id, url, text, n_chars)``."""
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, sample))
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract(shared), f"page_id {kind}, url string, text string, n_chars bigint"
    )
