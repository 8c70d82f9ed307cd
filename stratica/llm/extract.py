"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: maximal runs of text between block-level tags, each with the tags, classes and ids above it. A block's
features come from these ancestors and from its text (length, links, marks). The chain labels each block as
article or not; neighbours share a transition weight, and Viterbi finds the best labelling of the whole page.

The field is trained on labelled pages. Pages whose markup states where the article is (an ``article`` or ``main`` element) label
themselves. From each of them further labelled pages are made, which put the same blocks into other
containers, next to menus, notices, adverts, forms and comments, so that the weights don't rest on one template. At most ``SAMPLE``
pages, in hash order of their ids, are used; only they reach the driver.

Defined results: null, empty and textless pages give an empty text; broken markup is read as browsers do, as
far as blocks go; repeated rows give a row each; without a labelled page the field is trained on made pages around
fixed sentences; no rows give no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratica.llm.common import bounded_sample, small_batches

SAMPLE = 240
EPOCHS = 8
#: What HTML says of its tags.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title iframe object canvas audio video select textarea button datalist".split())
#: Elements that can stand in a head without ending it, and roots of markup in which any tag can close itself.
HEADED = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
FOREIGN = frozenset({"svg", "math"})
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends an open element of these kinds, up to the nearest of the limits.
CLOSES = {
    **dict.fromkeys(BLOCKS - {"li", "dd", "dt", "tr", "td", "th"}, ({"p"}, {"table", "td", "th", "button"})),
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt", "p"}, {"dl"}),
    "dt": ({"dd", "dt", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
}
#: Elements that hold the article, and elements whose text is never part of one.
ARTICLE = frozenset({"article", "main"})
ASIDE = frozenset({"nav", "aside", "footer", "form", "header", "menu", "dialog"})
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: its text, the tags and the class and id words above it, and its share of linked text.

    ``mark`` is what a made page states about the block, 1 for the article.
    """

    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]
    linked: float
    mark: int = 0


@dataclass
class _Reader(HTMLParser):
    blocks: list[Block] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...], int | None]] = []
        self.parts: list[str] = []
        self.in_link = self.silent = 0
        self.begun = False
        self.link_size = 0

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            tags = tuple(dict.fromkeys(t for t, _, _ in self.open))
            names = tuple(dict.fromkeys(n for _, own, _ in self.open for n in own))
            mark = next((m for _, _, m in reversed(self.open) if m is not None), 0)
            self.blocks.append(Block(text, tags, names, min(1.0, self.link_size / len(text)), mark))
        self.parts.clear()
        self.link_size = 0

    def pop(self, at: int) -> None:
        for tag, _, _ in self.open[at:]:
            self.in_link -= tag == "a"
            self.silent -= tag in SILENT
        del self.open[at:]

    def leave_head(self, tag: str = "") -> None:
        """The body has begun, by ``tag`` or by text: an open head ends. Within its elements only <body> ends it."""
        if self.begun:
            return
        tags = [t for t, _, _ in self.open]
        if "head" in tags and (tags[-1] == "head" or tag == "body" and "template" not in tags):
            self.pop(tags.index("head"))
            tags = []
        self.begun = "head" not in tags

    def handle_starttag(self, tag, attrs):
        if tag not in HEADED:
            self.leave_head(tag)
        elif tag == "head" and (self.begun or self.silent):
            return  # a head has its place before the body, once
        if tag in BLOCKS:
            self.flush()
            kinds, limits = CLOSES.get(tag, ((), ()))
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] in limits:
                    break
                if self.open[at][0] in kinds:
                    self.pop(at)
                    if tag not in ("tr", "td", "th", "li", "dd", "dt"):
                        break
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        words = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        own = (*_NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", words).lower()), *(["hidden"] if hidden else []))
        mark = {"data-article": 1, "data-other": 0}.get(attrs[-1][0]) if attrs else None
        self.open.append((tag, own, mark))
        self.in_link += tag == "a"
        self.silent += tag in SILENT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and (tag == "path" or any(t in FOREIGN for t, _, _ in self.open)):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.pop(at)
                return
            if self.open[at][0] in BLOCKS and tag not in BLOCKS:
                return  # an inline end tag closes nothing outside its block

    def handle_data(self, data):
        if data.strip() and not (self.open and self.open[-1][0] in SILENT - {"head"}):
            self.leave_head()
        if not self.silent:
            self.parts.append(data)
            if self.in_link:
                self.link_size += len(data.strip())


def read_blocks(html: str | None) -> list[Block]:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return reader.blocks


def block_features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold of each block."""
    out = []
    last = max(1, len(blocks) - 1)
    for at, block in enumerate(blocks):
        words = block.text.split()
        marks = sum(block.text.count(c) for c in ".,;:!?")
        own = ["bias", f"parent={block.tags[-1] if block.tags else ''}"]
        own += [f"tag={t}" for t in block.tags if t not in ("html", "body")]
        own += [f"name={n}" for n in block.names]
        own.append("named" if block.names else "unnamed")
        own.append(f"words={min(6, len(words).bit_length())}")
        own.append(f"linked={min(3, int(block.linked * 3.99))}")
        own.append(f"marks={min(3, int(20 * marks / max(1, len(words)) / 4))}")
        own.append(f"ends={block.text[-1] in '.!?…'}")
        own.append(f"place={int(4 * at / last)}")
        if block.text[0] in "©®™" or "©" in block.text[:40]:
            own.append("rights")
        out.append(own)
    return out


class Field:
    """Weights of the chain: emissions by feature, transitions, and starts, for the labels 0 and 1."""

    def __init__(self, emissions: dict[str, tuple[float, float]], chain: np.ndarray, start: np.ndarray):
        self.emissions, self.chain, self.start = emissions, chain, start

    def scores(self, names: list[list[str]]) -> np.ndarray:
        none = (0.0, 0.0)
        return np.array([[sum(x) for x in zip(*(self.emissions.get(n, none) for n in own), strict=True)] for own in names])

    def labels(self, names: list[list[str]]) -> list[int]:
        """The best labelling of a page's blocks (Viterbi)."""
        if not names:
            return []
        emitted = self.scores(names).tolist()
        (c00, c01), (c10, c11) = self.chain.tolist()
        best0, best1 = emitted[0][0] + float(self.start[0]), emitted[0][1] + float(self.start[1])
        back = []
        for e0, e1 in emitted[1:]:
            from0, from1 = best0 + c00 < best1 + c10, best0 + c01 < best1 + c11
            best0, best1 = max(best0 + c00, best1 + c10) + e0, max(best0 + c01, best1 + c11) + e1
            back.append((int(from0), int(from1)))
        out = [int(best1 > best0)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def trained(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, seed: int = 5) -> Field:
    """Weights of greatest conditional likelihood, by AdaGrad page after page, pulled towards zero."""
    index = {n: i for i, n in enumerate(dict.fromkeys(n for names, _ in pages for own in names for n in own))}
    weights = np.zeros((len(index), 2))
    chain, start = np.zeros((2, 2)), np.zeros(2)
    seen = [np.full(w.shape, 0.1) for w in (weights, chain, start)]
    coded = [([[index[n] for n in own] for own in names], np.array(gold)) for names, gold in pages if names]
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(coded)
        for rows, gold in coded:
            n = len(rows)
            flat = np.array([i for own in rows for i in own])
            sizes = np.array([len(own) for own in rows])
            emitted = np.add.reduceat(weights[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = emitted[0] + start
            for t in range(1, n):
                ahead[t] = emitted[t] + _logsum(ahead[t - 1][:, None] + chain, 0)
            for t in range(n - 2, -1, -1):
                behind[t] = _logsum(chain + (emitted[t + 1] + behind[t + 1])[None, :], 1)
            total = _logsum(ahead[-1], 0)
            single = np.exp(ahead + behind - total)
            single[np.arange(n), gold] -= 1
            pairs = np.zeros((2, 2))
            if n > 1:
                pairs = np.exp(
                    ahead[:-1, :, None] + chain[None] + (emitted[1:] + behind[1:])[:, None, :] - total
                ).sum(axis=0)
                np.add.at(pairs, (gold[:-1], gold[1:]), -1)
            slope = np.column_stack([np.bincount(flat, np.repeat(single[:, k], sizes), len(index)) for k in (0, 1)])
            own = np.unique(flat)
            for w, g, s, rows_of in (
                (weights, slope, seen[0], own), (chain, pairs, seen[1], slice(None)), (start, single[0], seen[2], slice(None)),
            ):
                step = g[rows_of] + 0.01 * w[rows_of]
                s[rows_of] += step * step
                w[rows_of] -= 0.3 * step / np.sqrt(s[rows_of])
    return Field({n: tuple(weights[i].tolist()) for n, i in index.items()}, chain, start)


def stated_labels(blocks: list[Block]) -> list[int] | None:
    """Labels that a page's own markup states, or None where it does not say."""
    inside = [int(bool(ARTICLE & set(b.tags)) and not ASIDE & set(b.tags)) for b in blocks]
    return inside if any(inside) else None


#: Words that name the parts of pages in classes and ids, by what they hold.
CONTAINERS = (
    ("article", ""), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "post-content"), ("section", "entry-content"),
    ("div", "story"), ("div", "main-text"), ("td", "content"), ("div", ""), ("section", ""), ("div", "page-content text"),
)
BOILERPLATE = {
    "menu": (("nav", ""), ("div", "menu"), ("ul", "nav navbar"), ("div", "breadcrumbs"), ("div", "navigation"), ("ul", "topmenu")),
    "header": (("header", ""), ("div", "header"), ("div", "masthead"), ("div", "site-title banner"), ("div", "top-bar")),
    "side": (("aside", ""), ("div", "sidebar"), ("div", "related"), ("div", "widget"), ("section", "recommended"), ("div", "tags")),
    "notice": (("div", "cookie-notice"), ("div", "consent"), ("div", "notice"), ("div", "alert popup"), ("p", "disclaimer"), ("div", "modal")),
    "advert": (("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "sponsored"), ("div", "promo"), ("aside", "advertisement")),
    "form": (("form", ""), ("form", "search"), ("div", "subscribe newsletter"), ("form", "login"), ("fieldset", "")),
    "comments": (("section", "comments"), ("div", "comment-list"), ("ol", "comments"), ("div", "reader-comments"), ("div", "discussion replies")),
    "footer": (("footer", ""), ("div", "footer"), ("div", "copyright"), ("div", "bottom site-info"), ("div", "share social")),
}
_BEFORE = ("menu", "header", "notice", "advert", "form", "side")
_AFTER = ("side", "comments", "form", "advert", "notice", "footer", "menu")
_SENTENCES = (
    "The quick brown fox jumps over the lazy dog, and nobody minds.", "A second sentence follows the first one.",
    "Home", "About us", "Later on, the river rose; the town, however, stayed dry.", "Read more", "No one had expected that.",
)


def made_page(article: list[tuple[str, str]], other: list[str], chance: random.Random) -> str:
    """A page around an article's blocks; text marked by ``data-article`` is what the label states.

    ``article`` has (tag, text); ``other`` is text of no article, from the same pages.
    """

    def text(long: bool) -> str:
        pool = [t for _, t in article] if long else other
        return escape(chance.choice(pool or list(_SENTENCES))[: 2000 if long else 200])

    def wrapped(tag: str, name: str, inner: str, mark: str = "") -> str:
        attr = f' {chance.choice(("class", "id", "class"))}="{name}"' if name else ""
        return f"<{tag}{attr}{mark}>{inner}</{tag}>"

    def part(kind: str) -> str:
        tag, name = chance.choice(BOILERPLATE[kind])
        if kind == "menu":
            links = "".join(f'<li><a href="#">{text(False)[:20]}</a></li>' for _ in range(chance.randint(2, 7)))
            return wrapped(tag, name, links if tag == "ul" else f"<ul>{links}</ul>")
        if kind == "comments":
            said = [f'<div class="comment"><b>{text(False)[:12]}</b><p>{text(True)}</p></div>' for _ in range(chance.randint(1, 5))]
            return wrapped(tag, name, "".join(f"<li>{s}</li>" if tag == "ol" else s for s in said))
        if kind == "form":
            return wrapped(tag, name, f"<label>{text(False)[:30]}</label><input name=q><p>{text(False)}</p>")
        if kind == "side":
            return wrapped(tag, name, "".join(f"<p>{text(chance.random() < 0.4)}</p>" for _ in range(chance.randint(1, 3))))
        inner = text(chance.random() < 0.3)
        inner = f"<p>{inner}</p>" if chance.random() < 0.5 and tag != "p" else inner
        return wrapped(tag, name, ("&copy; " if kind == "footer" and chance.random() < 0.5 else "") + inner)

    shown = []
    for tag, own in article:
        shown.append(f"<{tag}>{escape(own)}</{tag}>")
        if chance.random() < 0.03:
            shown.append(f'<!-- --><div class="{chance.choice(("ad", "advert", "promo"))}" data-other>{text(False)}</div>')
    before = [part(k) for k in chance.sample(_BEFORE, chance.randint(1, 4))]
    after = [part(k) for k in chance.sample(_AFTER, chance.randint(1, 5))]
    container = wrapped(*chance.choice(CONTAINERS), "".join(shown), " data-article")
    return f"<html><body>{''.join(before)}{container}{''.join(after)}</body></html>"


def training_pages(htmls: list[str], seed: int = 3, made: int = 2) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of the pages that state their article, and of pages made from each."""
    chance = random.Random(seed)
    out = []

    def make(article: list[tuple[str, str]], other: list[str]) -> None:
        for _ in range(made):
            blocks = read_blocks(made_page(article, other, chance))
            out.append((block_features(blocks), [b.mark for b in blocks]))

    for html in htmls:
        blocks = read_blocks(html)
        labels = stated_labels(blocks)
        if labels is None:
            continue
        out.append((block_features(blocks), labels))
        inside = [b for b, y in zip(blocks, labels, strict=True) if y]
        article = [(b.tags[-1] if b.tags[-1][0] in "hp" else "p", b.text) for b in chance.sample(inside, min(30, len(inside)))]
        make(article, [b.text for b, y in zip(blocks, labels, strict=True) if not y])
    if not out:
        make([("h1", _SENTENCES[1]), *(("p", t) for t in _SENTENCES)], list(_SENTENCES))
    return out


def learned(pages: DataFrame, sample: int = SAMPLE) -> Field:
    """The field trained on a bounded sample of the pages that state where their article is."""
    stating = pages.where(F.lower("html").rlike("<(article|main)[ >]")).select("page_id", "html")
    rows = bounded_sample(stating, ["page_id", "html"], sample).collect()
    return trained(training_pages([r["html"] for r in rows]))


def main_text(html: str | None, chain: Field) -> str:
    blocks = read_blocks(html)
    labels = chain.labels(block_features(blocks))
    return "\n".join(b.text for b, y in zip(blocks, labels, strict=True) if y)


def extracted(pages: DataFrame, chain: Field) -> DataFrame:
    """page_id, url, text and n_chars of every page row."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast((chain.emissions, chain.chain, chain.start))

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Field(*shared.value)
        for batch in batches:
            yield pd.Series([main_text(html, own) for html in batch], dtype=object)

    texts = pages.select("page_id", "url", text_of("html").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
