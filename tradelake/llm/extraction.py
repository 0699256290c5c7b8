"""Main text of web pages: boosted trees over features of DOM elements, and a decoding that respects the tree.

Each element gets a probability of holding main text from its tag, the words of its class, id and role, its ancestors'
words, depth, the density of text, links and punctuation in its subtree, and its siblings. Decoding chooses for all
elements at once the likeliest marking in which no element is kept below one that is dropped.

There are no labelled pages, so the model learns from pages put together from the corpus: paragraphs and headings of
a bounded sample of pages stand as main text in layouts of many kinds, their menus, notices and footers around them,
and the place an element is put in is its label. Layouts of the corpus itself are among them.
"""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import drop, scratch_name, ship_package, stage
from tradelake.llm.dom import Page

SAMPLE_PAGES = 400
LAYOUTS = 3
TREES, DEPTH = 20, 4

# Words that page authors use for what is around the main text, for reader comments, and for main text.
AROUND = (
    "ad ads advert advertisement advertising adsense aside banner billboard bottom breadcrumb breadcrumbs button buttons byline cart category cookie cookies consent "
    "copyright disclaimer footer form gdpr header help hidden legal link links login logo masthead menu meta modal more nav navbar navigation "
    "newsletter notice notification overlay pager pagination paywall popup privacy promo promotion promoted recommended related search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription tag tags teaser toc toolbar top topbar tracking warning widget alert"
).split()
COMMENTS = "comment comments commentlist disqus discussion reply replies respond responses reader feedback".split()
MAIN = "article articlebody body-copy content entry main maincontent post postbody story text hentry entry-content post-content".split()
_AROUND, _COMMENTS, _MAIN = frozenset(AROUND), frozenset(COMMENTS), frozenset(MAIN)

# Groups of element names.
GROUPS = [
    frozenset({"article", "main"}),
    frozenset("nav header footer aside menu dialog search".split()),
    frozenset("form button input select option textarea label fieldset legend".split()),
    frozenset("script style head title meta link noscript template iframe object svg canvas".split()),
    frozenset("h1 h2 h3 h4 h5 h6".split()),
    frozenset("p blockquote pre figure figcaption".split()),
    frozenset("ul ol dl li dt dd".split()),
    frozenset("table tr td th tbody thead tfoot".split()),
    frozenset("div section".split()),
    frozenset(["a"]),
    frozenset("html body #root".split()),
]
_GROUP_OF = {tag: i for i, group in enumerate(GROUPS) for tag in group}
FEATURES = len(GROUPS) + 21
_STOPS = re.compile(r"[.,;:!?]")
_SPLIT = re.compile(r"[^a-z]+")


def _words(text: str) -> tuple[int, int, int]:
    words = {*text.split(), *_SPLIT.split(text)}
    return int(not words.isdisjoint(_AROUND)), int(not words.isdisjoint(_COMMENTS)), int(not words.isdisjoint(_MAIN))


def features(page: Page) -> np.ndarray:
    """One row per element."""
    tags, parents = page.tags, page.parents
    n = len(tags)
    size, stops, own = [0] * n, [0] * n, [0] * n
    for block in page.blocks:
        for node, text in block:
            length = len(text.strip())
            size[node] += length
            own[node] += length
            if length:
                stops[node] += len(_STOPS.findall(text))
    linked = [size[i] if tags[i] == "a" else 0 for i in range(n)]
    count, children, depth = [1] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        p = parents[i]
        size[p] += size[i]
        stops[p] += stops[i]
        linked[p] += linked[i] if tags[i] != "a" else size[i]
        count[p] += count[i]
        children[p] += 1
    of_tag: dict[tuple[int, str], int] = {}
    place = [0] * n
    seen = [0] * n
    rows = np.zeros((n, FEATURES))
    flags = [(0, 0, 0)] * n
    above = [(0, 0, 0, 0, 0)] * n  # words and tags of ancestors
    memory: dict[str, tuple[int, int, int]] = {}
    for i in range(n):
        p = parents[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            place[i] = seen[p]
            seen[p] += 1
            key = (p, tags[i])
            of_tag[key] = of_tag.get(key, 0) + 1
        w = f"{tags[i]} {page.words[i]}"  # an element's name counts among its words
        if w not in memory:
            memory[w] = _words(w)
        flags[i] = memory[w]
        g = _GROUP_OF.get(tags[i], -1)
        f = flags[i]
        if p >= 0:
            q, a = flags[p], above[p]
            gp = _GROUP_OF.get(tags[p], -1)
            above[i] = (a[0] | q[0], a[1] | q[1], a[2] | q[2], a[3] | (gp == 0), a[4] | (gp in (1, 2, 3)))
        a = above[i]
        if g >= 0:
            rows[i, g] = 1
        brothers = children[p] if p >= 0 else 1
        rows[i, len(GROUPS) :] = (
            f[0], f[1], f[2], *a, depth[i], np.log1p(size[i]), np.log1p(own[i]), size[i] / count[i],
            linked[i] / size[i] if size[i] else 0, stops[i] / size[i] if size[i] else 0, children[i], place[i],
            place[i] / brothers, brothers, size[i] / max(size[p], 1) if p >= 0 else 1, np.log1p(count[i]), 0,
        )
    for i in range(1, n):
        rows[i, -1] = of_tag[parents[i], tags[i]] / children[parents[i]]
    return rows


def decode(parents: list[int], odds: np.ndarray) -> list[bool]:
    """The likeliest marking in which a kept element's parent is kept, from log odds of keeping each element.

    Dropping everything below an element is the base; a kept element adds its odds and what its children add, if that
    is more than nothing.
    """
    gain = odds.tolist()
    for i in range(len(gain) - 1, 0, -1):
        if gain[i] > 0:
            gain[parents[i]] += gain[i]
    keep = [False] * len(gain)
    keep[0] = True
    for i in range(1, len(gain)):
        keep[i] = keep[parents[i]] and gain[i] > 0
    return keep


class Trees:
    """Boosted trees as arrays, walked for many rows at once."""

    def __init__(self, nodes: list[tuple], weights: list[float]):
        """nodes: (tree, id, prediction, left, right, feature, threshold), ids counting from 0 within a tree."""
        self.weights = weights
        self.trees = []
        for t in range(len(weights)):
            mine = sorted((x[1:] for x in nodes if x[0] == t))
            self.trees.append([np.array([x[k] for x in mine]) for k in range(1, 6)])

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for weight, (value, left, right, feature, threshold) in zip(self.weights, self.trees, strict=True):
            at = np.zeros(len(rows), np.int64)
            while (inner := left[at] >= 0).any():
                down = np.where(rows[every, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at])
                at = np.where(inner, down, at)
            total += weight * value[at]
        return 2 * total  # the model's loss puts the odds at twice the sum


# Putting training pages together


def _parts(html_text: str) -> tuple[list[tuple[str, str]], list[str]]:
    """Headings and paragraphs of the longest element of a page as (tag, text), and the texts of its other blocks."""
    page = Page(html_text)
    rows = features(page)
    # The element with most text whose text is not mostly links or one child's.
    best = 0
    while True:
        inner = [i for i in range(len(page.tags)) if page.parents[i] == best and _GROUP_OF.get(page.tags[i], -1) != 3]
        big = max(inner, key=lambda i: rows[i, len(GROUPS) + 9], default=None)
        if big is None or rows[big, len(GROUPS) + 18] < 0.6 or page.tags[big] in ("p", "b"):
            break
        best = big
    inside = {best}
    for i in range(best + 1, len(page.tags)):
        if page.parents[i] in inside:
            inside.add(i)
    main, rest = [], []
    for block in page.blocks:
        line = " ".join("".join(t for _, t in block).split())
        node = block[0][0]
        if line and _GROUP_OF.get(page.tags[node], -1) != 3:
            (main.append((page.tags[node], line)) if node in inside else rest.append(line))
    return main, rest


def layout(main: list[tuple[str, str]], rest: list[str], seed: int) -> str:
    """A page with the given main text; elements carry their label as role y (main) or n (around it)."""
    draw = random.Random(seed)
    pick = draw.choice
    esc = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    rest = rest or ["Home", "More"]

    def around(words: int = 12) -> str:
        return " ".join(pick(rest).split()[: draw.randint(1, words)])

    def box(tag: str, words: list[str], inner: str, label: str) -> str:
        name = f' class="{pick(words)}"' if words and draw.random() < 0.8 else ""
        if not name and tag in ("div", "section", "ul", "p") and words:
            name = f' id="{pick(words)}"'
        return f'<{tag}{name} role="{label}">{inner}</{tag}>'

    def links() -> str:
        items = "".join(f'<li role="n"><a href="/x" role="n">{esc(around(2))}</a></li>' for _ in range(draw.randint(2, 9)))
        return f'<ul role="n">{items}</ul>'

    def passage(tag: str, text: str) -> str:
        text = esc(text)
        if draw.random() < 0.25 and " " in text:
            one, two = text.split(" ", 1)
            inline = pick(["b", "i", "em", "strong", "span", "a"])
            extra = ' href="/y"' if inline == "a" else ""
            text = f'<{inline}{extra} role="y">{one}</{inline}> {two}'
        return f'<{tag} role="y">{text}</{tag}>'

    tags = lambda t: t if t.startswith("h") else pick(["p"] * 6 + ["div", "blockquote", "li", "td"])
    body = []
    for tag, text in main:
        t = tags(tag)
        piece = passage(t, text)
        body.append(f'<ul role="y">{piece}</ul>' if t == "li" else f'<table role="y"><tr role="y">{piece}</tr></table>' if t == "td" else piece)
    noise = [
        lambda: box(pick(["div", "p", "section", "aside"]), "ad ads advert advertisement sponsored promo banner".split(), esc(around()), "n"),
        lambda: box(pick(["aside", "div"]), "sidebar related widget recommended more share social".split(), links() if draw.random() < 0.6 else f'<p role="n">{esc(around(30))}</p>', "n"),
        lambda: box("div", "cookie-notice notice consent alert popup newsletter subscribe disclaimer".split(), f'<p role="n">{esc(around(25))}</p>', "n"),
        lambda: box(pick(["section", "div", "ol"]), "comments comment-list responses discussion".split(), "".join(box("div", ["comment", "reply", "comment-body"], f'<p role="n">{esc(around(40))}</p>', "n") for _ in range(draw.randint(1, 4))), "n"),
        lambda: f'<form role="n"><label role="n">{esc(around(4))}</label><input role="n"><button role="n">{esc(around(2))}</button></form>',
        lambda: box("div", "breadcrumbs pagination tags meta byline toolbar login".split(), links() if draw.random() < 0.5 else esc(around(6)), "n"),
    ]
    for _ in range(draw.choice([0, 0, 1, 2, 3])):
        body.insert(draw.randint(0, len(body)), pick(noise)())
    inner = "".join(body)
    if draw.random() < 0.3:
        inner = box("div", pick([["entry-content", "text", "post-body"], []]), inner, "y")
    holder = pick(["article", "article", "main", "div", "section"])
    core = box(holder, [] if holder in ("article", "main") and draw.random() < 0.7 else MAIN, inner, "y")
    if draw.random() < 0.3:
        core = box(pick(["div", "main"]), pick([["wrapper", "container", "page", "layout"], []]), core + "".join(pick(noise)() for _ in range(draw.randint(0, 2))), "y")
    top = []
    if draw.random() < 0.85:
        top.append(box(pick(["nav", "nav", "div", "header"]), "menu nav navbar navigation top".split() if draw.random() < 0.5 else [], links(), "n"))
    if draw.random() < 0.4:
        top.append(box(pick(["header", "div"]), ["header", "masthead", "logo", "topbar"], f'<{pick(["h1", "p", "a"])} role="n">{esc(around(6))}', "n"))
    top += [pick(noise)() for _ in range(draw.choice([0, 1, 1, 2]))]
    low = [pick(noise)() for _ in range(draw.choice([0, 0, 1, 2]))]
    if draw.random() < 0.85:
        low.append(box(pick(["footer", "footer", "div"]), "footer bottom copyright legal".split(), f"&copy; {esc(around(25))}" if draw.random() < 0.6 else links(), "n"))
    return f'<!DOCTYPE html><html role="y"><head role="n"><title role="n">{esc(around())}</title><style role="n">p{{margin:0}}</style></head><body role="y">{"".join(top)}{core}{"".join(low)}</body></html>'


_LABEL = re.compile(r"\b([yn])$")


def labelled(html_text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the elements of a page made by `layout`; the labels are not seen by the features."""
    page = Page(html_text)
    labels = np.array([1.0 if i == 0 or (found := _LABEL.search(w)) is None or found[1] == "y" else 0.0 for i, w in enumerate(page.words)])
    page.words = [_LABEL.sub("", w).strip() for w in page.words]
    return features(page), labels


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, seed: int = 5) -> Trees | None:
    """Trees learned from about `sample_pages` pages, drawn by a hash of the page id; None if there is no page."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    spark = pages.sparkSession
    ship_package(spark)
    total = pages.count()
    part = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample_pages / max(total, 1)))

    def run(batches):
        import zlib

        import pyarrow as pa

        for b in batches:
            out, marks = [], []
            for html_text in b.column("html").to_pylist():
                main, rest = _parts(html_text or "")
                for i in range(LAYOUTS):
                    rows, labels = labelled(layout(main[:60], rest[:60], zlib.crc32((html_text or "").encode()) + i))
                    out += rows.tolist()
                    marks += labels.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64())), pa.array(marks, pa.float64())], names=["x", "label"])

    rows = stage(pages.where(part).select("html").mapInArrow(run, "x array<double>, label double"), "layout-elements")
    if rows.isEmpty():
        return None
    table = rows.select(array_to_vector("x").alias("features"), "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=seed, maxMemoryInMB=64).fit(table)
    path = scratch_name(spark, "trees")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # at most 2^(DEPTH + 1) nodes a tree
    nodes = [(r.treeID, r.id, r.prediction, r.leftChild, r.rightChild, r.split.featureIndex, (r.split.leftCategoriesOrThreshold or [0.0])[0]) for r in saved]
    trees = Trees(nodes, list(model.treeWeights))
    drop(rows)
    return trees


def extract(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """page_id, url, text of every page, from the whole of its html.

    A null or empty html, or one without main text, has an empty text. Unclosed tags end where HTML ends them, and
    broken ones are text. Pages that repeat give the same text again.
    """
    ship_package(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out: list[str] = []
            for i in range(0, b.num_rows, 200):
                read = [Page(h or "") for h in b.column("html").slice(i, 200).to_pylist()]
                rows = [features(p) for p in read]
                odds = trees.log_odds(np.concatenate(rows)) if trees else np.ones(sum(map(len, rows)))
                at = np.cumsum([0, *map(len, rows)])
                out += [p.text(decode(p.parents, odds[x:y])) for p, x, y in zip(read, at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    schema = pages.select("page_id", "url", F.lit("").alias("text")).schema
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
