"""Main text of pages by a tree-structured graphical model.

Every node of a page's tree is content or not. A node's own look (element, class words, length,
links, punctuation) and a potential between each child and its parent decide; messages go up
from the leaves and down from the root (sum-product), which gives each text block's exact
marginal. The weights are trained on labelled pages: a bounded sample of the table, labelled
where its markup says what a part is, and the same texts laid out anew with many kinds of
parts, which carry their labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.llm.common import grouped, texts_of
from queuelens.llm.dom import Page, parse

SAMPLE_PAGES = 200  #: pages of the table that the model is trained on at most
SAMPLE_BYTES = 200_000  #: larger pages are left out of the sample, not of the extraction
HASH_BITS = 14
STEPS = 200
PENALTY = 1e-5
BLOCK_BYTES = 2 << 20

# What markup that names its parts says about them; used for labels of sampled pages alone.
SAYS_CONTENT = frozenset(["article", "main"])
SAYS_OTHER = frozenset(["nav", "header", "footer", "aside", "form", "dialog", "menu"])
NAMES_OTHER = frozenset(
    "ad ads advert advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer header cookie cookies consent notice popup modal newsletter subscribe share social related comments comment "
    "reply login signup pagination pager widget".split()
)

# Parts that training pages are laid out with: where an article stands, what stands beside it.
CONTENT_PARTS = (
    "article;main;div class=content;div id=content;div id=main;div class=post;div class=entry-content;div class=article-body;"
    "section class=main-content;div role=main;div class=story;div class=text;section class=article;div itemprop=articleBody;"
    "div class=post-content;td class=main;div class=page-content;div class=body;article class=post;main id=content"
).split(";")
OTHER_PARTS = [
    *"nav;header;footer;aside;form;nav;header;footer;aside;dialog;menu;section class=comments;ol class=comments;ul class=menu;ul class=nav".split(";"),
    *[f"div class={name}" for name in sorted(NAMES_OTHER)],
    *[f"div id={name}" for name in sorted(NAMES_OTHER)],
    *"div class=site-header;div class=site-footer;div class=cookie-notice;div class=cookie-banner;div class=comment-list".split(";"),
    *"div id=comments;div class=reader-comments;div class=copyright;div class=top-bar;div class=alert;div class=message".split(";"),
    *"section id=comments;aside class=related;aside class=sidebar;div class=discussion;div class=ad-slot;td class=menu".split(";"),
    *"div role=navigation;div role=banner;div role=contentinfo;div role=complementary;div class=newsletter-form".split(";"),
]
ROUNDS = 1200  #: pages laid out for training


class Model(NamedTuple):
    weights: np.ndarray  # of content against other, by hashed feature
    ties: np.ndarray  # parent x child
    leaf_ties: np.ndarray  # parent x text block


def _number(feature: str) -> int:
    return zlib.crc32(feature.encode()) & (1 << HASH_BITS) - 1


_numbers: dict[str, int] = {}


def number(feature: str) -> int:
    found = _numbers.get(feature)
    if found is None:
        if len(_numbers) > 100_000:
            _numbers.clear()
        found = _numbers[feature] = _number(feature)
    return found


def node_features(page: Page) -> list[list[int]]:
    """Hashed features of each node that can be seen from it alone or from its parent's tag."""
    out = []
    total = max(1, sum(map(len, page.texts)))
    said = 0
    for parent, name, tokens, text, linked in zip(page.parents, page.names, page.words, page.texts, page.linked):
        if name:
            out.append([number("<" + name), *[number("." + t) for t in tokens], number("plain<" + name) if not tokens else number("named")])
            continue
        size = len(text)
        said += size
        above = page.names[parent]
        count = text.count(" ") + 1
        stops = text.count(".") + text.count(",")
        out.append(
            [
                number("text"),
                number("in<" + above),
                number(f"size{size.bit_length()}"),
                number(f"in<{above}size{size.bit_length() // 2}"),
                number(f"links{4 * linked // size}"),
                number(f"stops{min(8 * stops // count, 4)}"),
                number(f"end{text[-1] in '.!?'}"),
                number(f"place{4 * (said - size) // total}"),
                *[number("." + t + "|") for t in page.words[parent]],
            ]
        )
    return out


class Forest:
    """The trees of many pages as one table, by level."""

    def __init__(self, pages: list[Page]):
        parents, depths, features, self.starts = [], [], [], []
        for page in pages:
            base = len(parents)
            self.starts.append(base)
            for p in page.parents:
                parents.append(p + base if p >= 0 else -1)
                depths.append(0 if p < 0 else depths[p + base] + 1)
            features += node_features(page)
        self.starts.append(len(parents))
        self.parents, self.depths = np.array(parents, np.int64), np.array(depths, np.int64)
        self.leaf = np.array([not n for page in pages for n in page.names], bool)
        self.levels = np.split(np.argsort(self.depths, kind="stable"), np.cumsum(np.bincount(self.depths))[:-1])
        self.flat = np.array([f for row in features for f in row], np.int64)
        self.owner = np.repeat(np.arange(len(features)), [len(row) for row in features])

    def beliefs(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sum-product: (node's log marginals, its messages from below with its own, what its parent
        sends down). Two passes over the levels."""
        half = np.bincount(self.owner, model.weights[self.flat], len(self.parents)) / 2
        up = np.stack([-half, half], axis=1)
        sent = np.zeros_like(up)
        for level in self.levels[:0:-1]:
            sent[level] = _log_sum(up[level][:, None, :] + self._ties(model, level))
            np.add.at(up, self.parents[level], sent[level])
        down = np.zeros_like(up)
        for level in self.levels[1:]:
            above = self.parents[level]
            rest = up[above] + down[above] - sent[level]
            down[level] = _log_sum((rest[:, :, None] + self._ties(model, level)).swapaxes(1, 2))
        both = up + down
        return both - _log_sum(both)[:, None], up, down

    def _ties(self, model: Model, nodes: np.ndarray) -> np.ndarray:
        return np.where(self.leaf[nodes][:, None, None], model.leaf_ties, model.ties)

    def pairs(self, model: Model, up: np.ndarray, down: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Joint marginals (parent, child) of each node with its parent."""
        ties = self._ties(model, nodes)
        sent = _log_sum(up[nodes][:, None, :] + ties)
        above = self.parents[nodes]
        joint = (up[above] + down[above] - sent)[:, :, None] + ties + up[nodes][:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        return joint / joint.sum(axis=(1, 2), keepdims=True)


def _log_sum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1)
    return top + np.log(np.exp(a - top[..., None]).sum(axis=-1))


def labels(page: Page) -> np.ndarray:
    """A label per node: from data-content, else from what the markup names; an element that says
    nothing is what most of the text below it is."""
    count = len(page.parents)
    said = np.zeros(count, bool)
    marked = any(m is not None for m in page.marks)
    for i in range(1, count):
        above = said[page.parents[i]]
        if marked:
            said[i] = above if page.marks[i] is None else page.marks[i]
        else:
            name = page.names[i]
            other = name in SAYS_OTHER or not NAMES_OTHER.isdisjoint(page.words[i])
            said[i] = False if other and not (name == "header" and above) else True if name in SAYS_CONTENT else above
    yes, all_ = np.zeros(count), np.zeros(count)
    for i in range(count - 1, 0, -1):
        size = len(page.texts[i])
        yes[i] += size * said[i]
        all_[i] += size
        yes[page.parents[i]] += yes[i]
        all_[page.parents[i]] += all_[i]
    return np.where(all_ > 0, 2 * yes > all_, said).astype(int)


def fit(pages: list[Page]) -> Model:
    """Train weights and potentials by the exact gradient of the labels' likelihood."""
    forest = Forest(pages)
    y = np.concatenate([labels(p) for p in pages])
    size = 1 << HASH_BITS
    flat = np.zeros(size + 8)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    weight = 1.0 / np.diff(forest.starts)
    per_node = np.repeat(weight / weight.mean(), np.diff(forest.starts))
    below = np.flatnonzero(forest.parents >= 0)
    kinds = [below[~forest.leaf[below]], below[forest.leaf[below]]]
    for step in range(1, STEPS + 1):
        model = Model(flat[:size], flat[size : size + 4].reshape(2, 2), flat[size + 4 :].reshape(2, 2))
        marginal, up, down = forest.beliefs(model)
        gap = (y - np.exp(marginal[:, 1])) * per_node
        grad = np.zeros_like(flat)
        grad[:size] = np.bincount(forest.flat, gap[forest.owner], size)
        for k, nodes in enumerate(kinds):
            if len(nodes):
                expected = (forest.pairs(model, up, down, nodes) * per_node[nodes][:, None, None]).sum(axis=0)
                told = np.zeros((2, 2))
                np.add.at(told, (y[forest.parents[nodes]], y[nodes]), per_node[nodes])
                grad[size + 4 * k : size + 4 * k + 4] = (told - expected).ravel()
        grad = grad / len(y) - PENALTY * flat
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        flat = flat + 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8) * (np.abs(first) > 0)
    return Model(flat[:size].astype(np.float32), flat[size : size + 4].reshape(2, 2), flat[size + 4 :].reshape(2, 2))


def laid_out(pages: list[Page], rounds: int = ROUNDS, seed: int = 7) -> list[Page]:
    """Pages of the paragraphs of labelled ones, each with an article among other parts.

    Parts carry their label as ``data-content``. Either kind of part is filled with texts of
    either kind, so that where a text stands tells more than what it says.
    """
    import html

    rng = np.random.default_rng(seed)
    pick = lambda items: items[int(rng.integers(0, len(items)))]
    found: tuple[list[str], list[str]] = ([], [])
    for page in pages:
        for text, label in zip(page.texts, labels(page)):
            if text:
                found[label].append(html.escape(text[:2000], quote=False))
    other, good = (part or DEFAULT for part in found)

    def prose() -> str:
        return pick(good) if rng.random() < 0.85 else pick(other)

    def short() -> str:
        return " ".join(pick(other if rng.random() < 0.5 else good).split()[: int(rng.integers(1, 8))])

    def wrap(part: str, label: int, inner: str) -> str:
        name = part.split()[0]
        cell = name == "td"
        attributes = part[len(name):].replace("=", '="') + '"' if " " in part else ""
        out = f'<{name}{attributes} data-content="{label}">{inner}</{name}>'
        return f"<table><tr>{out}</tr></table>" if cell else out

    def aside() -> str:
        kinds = [
            lambda: short(),
            lambda: f"<p>{prose()}</p>",
            lambda: f"<h3>{short()}</h3><p>{prose()}</p>",
            lambda: "<ul>" + "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(int(rng.integers(1, 7)))) + "</ul>",
            lambda: f'<a href="#">{short()}</a> {short()}',
            lambda: "".join(f"<div><p>{prose()}</p></div>" for _ in range(int(rng.integers(1, 5)))),
            lambda: f"<p>{short()}</p><label>{short()}</label>",
            lambda: "<ol>" + "".join(f"<li><p>{prose()}</p></li>" for _ in range(int(rng.integers(1, 4)))) + "</ol>",
            lambda: f"{prose()}",
        ]
        return wrap(pick(OTHER_PARTS), 0, pick(kinds)())

    def block() -> str:
        kinds = [
            lambda: f"<h2>{short()}</h2>",
            lambda: f"<ul><li>{short()}</li><li>{prose()}</li></ul>",
            lambda: f"<blockquote>{prose()}</blockquote>",
            lambda: f"<pre>{short()}</pre>",
            lambda: f"<table><tr><td>{short()}</td><td>{short()}</td></tr></table>",
            lambda: f"<p>{short()}</p>",
            lambda: f"<figure><figcaption>{short()}</figcaption></figure>",
            lambda: f"<div><p>{prose()}</p></div>",
        ]
        return pick(kinds)() if rng.random() < 0.3 else f"<p>{prose()}</p>"

    out = []
    for _ in range(rounds):
        title = pick([f"<h1>{short()}</h1>", f"<h1>{prose()}</h1>", f"<header><h1>{short()}</h1></header>", ""])
        inner = title + "".join(block() if rng.random() > 0.12 else aside() for _ in range(int(rng.integers(1, 9))))
        if rng.random() < 0.3:
            inner = f"<div>{inner}</div>"
        if rng.random() < 0.05:  # an article without any part of its own
            inner = "".join(f'<p data-content="1">{prose()}</p>' for _ in range(int(rng.integers(1, 5))))
        else:
            inner = wrap(pick(CONTENT_PARTS), 1, inner)
        body = "".join(aside() for _ in range(int(rng.integers(0, 4)))) + inner + "".join(aside() for _ in range(int(rng.integers(0, 5))))
        if rng.random() < 0.3:
            body = f'<div class="{pick(["wrapper", "container", "page", "site", "row"])}">{body}</div>'
        out.append(parse(f"<html><body>{body}</body></html>"))
    return out


DEFAULT = ["Home", "A sentence of some words, which ends with a stop. And another one that follows it, of more words still.", "Contact us"]


def learn(pages: DataFrame, page_id: str = "page_id", html: str = "html", most: int = SAMPLE_PAGES) -> Model:
    """Train on at most ``most`` pages, those with the least hash of their id, of at most
    ``SAMPLE_BYTES`` each, and on as many layouts as ``ROUNDS`` says. An empty
    table trains on layouts alone."""
    small = F.octet_length(html) <= SAMPLE_BYTES
    ids = pages.where(small).select(F.col(page_id).cast("bigint").alias("_id")).where("_id is not null").distinct()
    chosen = [r[0] for r in ids.orderBy(F.xxhash64("_id"), "_id").limit(most).collect()]
    found = pages.where(small & F.col(page_id).isin(chosen)).select(F.col(page_id), F.col(html).cast("string")).limit(most).collect()
    found.sort(key=lambda r: (r[0], r[1]))
    real = [parse(r[1]) for r in found]
    named = [p for p in real if not SAYS_CONTENT.isdisjoint(p.names)]  # others have no labels
    return fit([*named, *laid_out(named)])


def texts(pages: list[Page], model: Model) -> list[str]:
    """The blocks of each page that are content with a marginal of a half or more, joined by \\n."""
    forest = Forest(pages)
    content = forest.beliefs(model)[0][:, 1] >= np.log(0.5)
    out = []
    for page, a, b in zip(pages, forest.starts, forest.starts[1:]):
        out.append("\n".join(t for t, keep in zip(page.texts, content[a:b].tolist()) if t and keep))
    return out


def extract(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row. Null and empty html give an empty text. One pass, no
    shuffle; broken markup is read as a browser would, roughly, and never stops the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in grouped(batches, "_html", BLOCK_BYTES):
            found = texts([parse(h.decode()) for h in texts_of(block["_html"].combine_chunks())], model)
            yield from pa.table(
                {
                    "page_id": block["_id"].combine_chunks(),
                    "url": block["_url"].combine_chunks(),
                    "text": pa.array(found, pa.string()),
                    "n_chars": pa.array([len(t) for t in found], pa.int64()),
                }
            ).to_batches()

    given = pages.select(
        F.col(page_id).cast("bigint").alias("_id"), F.col(url).cast("string").alias("_url"), F.col(html).cast("string").alias("_html")
    )
    return given.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
