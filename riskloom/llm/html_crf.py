"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Each leaf block of a page (see ``html_blocks``) gets features of its ancestors and of
its text (length, share of links, final punctuation, element). What an ancestor's
element says and what the words of its class and id say are features apart, alone and
together; neither outranks the other, the weights are learnt. (``body`` holds every
block alike and is left out.) The field has two states, article and rest; it is trained
by maximum likelihood on labelled pages and decoded by Viterbi.

No table has labels for pages, so the labelled pages are built here: layouts whose
parts are known, in the markup that sites use for them, with texts taken from a
bounded sample of the given pages (``SAMPLE_PAGES`` pages, the first ``SAMPLE_CHARS``
characters of each). Only the layouts carry labels, so which text stands where says
nothing. The weights are a few hundred numbers and go to the tasks in the closure.

Results by case: null or empty html, or a page without article text, gives an empty
text; no rows give no rows (and no sample: fixed words fill the layouts); repeated
rows are extracted one by one; a null identifier or url is kept; other columns are not
read. Whole pages are read, nothing is cut.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.html_blocks import Block, leaf_blocks

SAMPLE_PAGES = 64
SAMPLE_CHARS = 20_000
TRAINING_PAGES = 600
STEPS = 150
PENALTY = 1e-3

# What element names and the words of classes and ids say about a part of a page.
TAG_ROLES = {
    "article": "content", "main": "content", "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side",
    "form": "form", "fieldset": "form", "button": "form", "legend": "form", "dialog": "notice", "address": "footer", "figcaption": "caption",
}
WORD_ROLES = {
    "comment": "comments comment reply replies respond response responses disqus discussion commenter commentlist reader",
    "ad": "ad ads advert adverts advertisement advertising adsense adslot adsbygoogle sponsor sponsored sponsors promo promotion banner",
    "notice": "cookie cookies consent notice notices alert alerts gdpr privacy popup modal overlay newsletter subscribe subscription paywall signup toast disclaimer announcement",
    "side": "sidebar side widget widgets related recommended recommendations trending popular rail more",
    "menu": "nav navbar navigation navigational menu menus breadcrumb breadcrumbs toolbar tabs pagination pager toc topbar",
    "share": "share sharing social follow tags tag",
    "footer": "footer foot copyright colophon contentinfo",
    "header": "header masthead logo branding tagline",
    "form": "form search login register",
    "content": "content article post entry story body text main blog",
    "switch": "has with without no enabled disabled",
}
_ROLE_OF_WORD = {w: role for role, words in reversed(WORD_ROLES.items()) for w in words.split()}

# Markup of the parts of a page, by what they are.
ARTICLES = (
    "<article>", "<main>", '<main id="main"><article class="post">', '<div class="post-content">', '<div id="content">', '<section class="entry-content">',
    '<div itemprop="articleBody">', '<div class="story-body">', '<div class="article-text">', '<div id="main-content"><div class="blog-post">', '<div class="page"><article>', "<div>",
)
PARTS = {
    "menu": ("<nav>", '<div class="menu">', '<ul id="main-menu">', '<div class="breadcrumbs">', '<div role="navigation">', '<div class="navbar">', "<menu>"),
    "header": ("<header>", '<div class="site-header">', '<div id="masthead">', '<div class="header"><div class="branding">'),
    "footer": ("<footer>", '<div class="site-footer">', '<div id="footer">', '<div class="copyright">', '<div role="contentinfo">'),
    "side": ("<aside>", '<div class="sidebar">', '<div id="sidebar"><div class="widget">', '<div class="related-posts">', '<section class="related">', '<div class="related-posts"><article class="post">', '<aside class="widget">', '<div class="recommended-stories">'),
    "notice": ('<div class="cookie-notice">', '<div id="cookie-banner">', '<div class="alert">', '<div class="newsletter-signup">', '<div class="notice">', '<div role="alert">', "<dialog>", '<div class="gdpr-consent">', '<section class="subscribe-popup">', '<p class="notice">'),
    "ad": ('<div class="ad">', '<div class="advert">', '<div id="ad-slot">', '<div class="sponsored-content">', '<div class="banner">', '<div class="promo">', '<section class="advertisement">', '<aside class="ad">', '<p class="ad">'),
    "form": ("<form>", '<form class="search-form">', "<fieldset>", '<div class="login-form">', '<form id="contact"><div>'),
    "comment": ('<ol class="comment-list"><li><article class="comment-body">', '<ol class="commentlist"><li class="comment"><article class="entry">', '<section class="comments">', '<div id="comments">', '<ol class="comment-list">', '<div class="comment-body">', '<div id="disqus_thread">', '<section id="responses">', '<div class="reader-comments"><article class="comment">', '<ul class="replies">'),
    "share": ('<div class="share-buttons">', '<div class="social">', '<ul class="share">', '<p class="tags">'),
}
# Words of classes and ids that say an element holds the article.
CONTENT_WORDS = ("post", "entry", "story", "article", "content", "blog-post")
_FILLER = "some plain words that stand where no page has given any, and a few more of them."


def _said(tag: str, words: frozenset[str]) -> tuple[str, tuple[str, ...]]:
    """What an element says it is, and what its class and id words say it is."""
    return TAG_ROLES.get(tag, ""), tuple(sorted({_ROLE_OF_WORD[w] for w in words if w in _ROLE_OF_WORD}))


@lru_cache(maxsize=20_000)
def _place_features(tags: tuple[str, ...], words: tuple[frozenset[str], ...]) -> tuple[str, ...]:
    nodes = [_said(t, w) for t, w in zip(tags, words) if t not in ("html", "body")]
    nodes = [n for n in nodes if any(n)]
    names = [f"{element}|{'+'.join(roles)}" for element, roles in nodes]
    inner, outer = names[-1] if names else "none", names[-2] if len(names) > 1 else "none"
    leaf = tags[-1] if tags else "none"
    out = {"bias", f"inner={inner}", f"pair={outer}>{inner}", f"leaf={leaf}", f"leaf={leaf}&inner={inner}", f"listed={'li' in tags or 'dd' in tags}"}
    if nodes:
        out.update([f"inner element={nodes[-1][0]}", *(f"inner word={r}" for r in nodes[-1][1])])
    for name, (element, roles) in zip(names, nodes):
        out.update([f"has={name}", f"has element={element}", *(f"has word={r}" for r in roles), *(f"has={element}&{r}" for r in roles)])
    return tuple(sorted(out))


def _text_features(b: Block) -> tuple[str, ...]:
    n = len(b.text)
    size = 0 if n <= 20 else 1 if n <= 60 else 2 if n <= 150 else 3 if n <= 400 else 4
    links = 0 if not b.link_chars else 1 if 2 * b.link_chars < n else 2
    return (f"size={size}", f"links={links}", f"stop={b.text[-1] in '.!?…:;。！？'}", f"rights={'©' in b.text}", f"size={size}&links={links}")


def features(b: Block) -> tuple[str, ...]:
    return _place_features(b.tags, b.words) + _text_features(b)


# ---- labelled pages -------------------------------------------------------------------------


def _closing(opened: str) -> str:
    tags = [part.split(">")[0].split()[0] for part in opened.split("<")[1:]]
    return "".join(f"</{t}>" for t in reversed(tags))


class _Layouts:
    """Pages of known parts; texts come from ``texts``. A label per leaf block comes with each page."""

    def __init__(self, texts: list[str], seed: int):
        self.rng = random.Random(seed)
        self.texts = texts or [_FILLER]

    def _words(self, least: int, most: int) -> str:
        words = self.rng.choice(self.texts).split()
        n = self.rng.randint(least, most)
        while len(words) < n:
            words += self.rng.choice(self.texts).split() or ["word"]
        return " ".join(w.replace("<", "").replace("&", "") or "x" for w in words[:n])

    def part(self, kind: str, out: list[tuple[str, int | None]]) -> None:
        opened = self.rng.choice(PARTS[kind])
        if self.rng.random() < 0.3:  # the element of the part, or a plain one, with any of the part's words
            tag = self.rng.choice([t for t, r in TAG_ROLES.items() if r == kind and t not in ("button", "legend", "menu")] + ["div"])
            opened = f'<{tag} {self.rng.choice(("class", "id"))}="{self.rng.choice(WORD_ROLES[kind].split())}">'
        leaf_only = opened.startswith("<p ")
        out.append((opened, None))
        linked = kind in ("menu", "share") or kind in ("side", "footer", "header") and self.rng.random() < 0.5
        is_list = opened.rsplit("<", 1)[1].startswith(("ul", "ol", "menu"))
        listed = is_list or not leaf_only and linked and self.rng.random() < 0.7
        if listed and not is_list:
            out.append(("<ul>", None))
        for _ in range(1 if leaf_only else self.rng.randint(3, 8) if linked else self.rng.randint(1, 4)):
            text = self._words(1, 3) if linked else self._words(2, 60 if kind in ("comment", "notice", "ad", "side") else 14)
            if kind == "footer" and self.rng.random() < 0.6:
                text = "&copy; " + text
            text = f'<a href="/x">{text}</a>' if linked else text
            tag = "" if leaf_only else "li" if listed else self.rng.choice(("p", "div", "span", "h3") if kind != "form" else ("label", "button", "p"))
            tag = "p" if tag in ("span", "label") else tag
            out.append((f"<{tag}>{text}</{tag}>" if tag else text, 0))
        if listed and not is_list:
            out.append(("</ul>", None))
        out.append((_closing(opened), None))

    def misleading(self) -> str:
        """An article's element whose class or id also has words that name other parts, as topics and theme switches do."""
        role = self.rng.choice([r for r in WORD_ROLES if r not in ("content", "switch")])
        words = [self.rng.choice(WORD_ROLES[role].split()) + self.rng.choice(("", "-topic", "-open"))]
        if self.rng.random() < 0.4:
            words.append(self.rng.choice(WORD_ROLES[self.rng.choice(("share", "side", "menu", "notice"))].split()) + "-x")
        # a lone "comment" or "ad" is one, whatever its element; a plain element needs a word for the article
        plain = role == "share" and self.rng.random() < 0.5
        if plain or role in ("comment", "ad") or self.rng.random() < 0.5:
            words = [self.rng.choice(CONTENT_WORDS), *words[:1 if plain else None]]
        tag = self.rng.choice(("div", "section")) if plain else self.rng.choice(("article", "article", "main"))
        return f'<{tag} {self.rng.choice(("class", "id"))}="{" ".join(words)}">'

    def article(self, out: list[tuple[str, int | None]]) -> None:
        opened = self.misleading() if self.rng.random() < 0.35 else self.rng.choice(ARTICLES)
        plain = opened == "<div>"
        out.append((opened, None))
        title = f"<h1>{self._words(3, 12)}</h1>"
        if self.rng.random() < 0.3 and not plain:
            title = f"<header>{title}</header>"
        out.append((title, 1))
        for _ in range(self.rng.randint(1, 14)):
            kind = self.rng.random()
            if kind < 0.8 or plain:
                out.append((f"<p>{self._words(20 if plain else 1, 120)}.</p>", 1))
            elif kind < 0.87:
                out.append((f"<h2>{self._words(1, 8)}</h2>", 1))
            elif kind < 0.92:
                out.append((f"<blockquote>{self._words(3, 40)}</blockquote>", 1))
            elif kind < 0.97:
                out.append(("<ul>", None))
                for _ in range(self.rng.randint(1, 4)):
                    out.append((f"<li>{self._words(1, 25)}</li>", 1))
                out.append(("</ul>", None))
            else:
                out.append((f"<p>{self._words(2, 20)} <a href='/y'>{self._words(1, 4)}</a> {self._words(2, 20)}.</p>", 1))
            if self.rng.random() < 0.2 and not plain:
                self.part(self.rng.choice(("ad", "side", "share", "notice")), out)
        if self.rng.random() < 0.3 and not plain:
            self.part(self.rng.choice(("comment", "share", "footer", "form")), out)
        out.append((_closing(opened), None))

    def page(self) -> tuple[str, list[int]]:
        out: list[tuple[str, int | None]] = [("<html><body>", None)]
        chance = self.rng.random
        # themes mark the whole page with words for its parts as well
        wrapped = chance() < 0.25
        if wrapped:
            role = self.rng.choice(("side", "menu", "notice", "share", "header"))
            out.append((f'<div class="{self.rng.choice(("has", "with", "no"))}-{self.rng.choice(WORD_ROLES[role].split())}">', None))
        for kind, p in (("notice", 0.3), ("header", 0.5), ("menu", 0.7), ("ad", 0.5), ("side", 0.2)):
            if chance() < p:
                self.part(kind, out)
        if chance() < 0.95:
            self.article(out)
        for kind, p in (("share", 0.3), ("ad", 0.3), ("comment", 0.5), ("side", 0.4), ("form", 0.3), ("notice", 0.2), ("footer", 0.8)):
            if chance() < p:
                self.part(kind, out)
        out.append(("</div></body></html>" if wrapped else "</body></html>", None))
        return "".join(x for x, _ in out), [y for _, y in out if y is not None]


def labelled_pages(texts: list[str], count: int = TRAINING_PAGES, seed: int = 1) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels (1: article) of built pages."""
    layouts = _Layouts(texts, seed)
    pages = []
    while len(pages) < count:
        page, labels = layouts.page()
        blocks = leaf_blocks(page)
        if blocks and len(blocks) == len(labels):
            pages.append((blocks, labels))
    return pages


# ---- the field ------------------------------------------------------------------------------


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis=axis)) + m.squeeze(axis)


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS, penalty: float = PENALTY) -> dict:
    """Weights of features by state and of transitions, by gradient ascent on the penalised log-likelihood.

    All pages are one padded array, and each step is a forward and a backward pass over its columns.
    """
    names: dict[str, int] = {}
    rows = [[[names.setdefault(f, len(names)) for f in features(b)] for b in blocks] for blocks, _ in pages]
    n, longest, k = len(pages), max(len(r) for r in rows), len(names)
    most = max(len(fs) for r in rows for fs in r)
    x = np.full((sum(map(len, rows)), most), k)  # the features of a block; place k has weight zero
    where = np.full((n, longest), -1)
    gold = np.zeros((n, longest), int)
    at = 0
    for i, (r, (_, labels)) in enumerate(zip(rows, pages)):
        for t, fs in enumerate(r):
            x[at, :len(fs)] = fs
            where[i, t], gold[i, t] = at, labels[t]
            at += 1
    there = where >= 0
    y = np.zeros((len(x), 2))
    y[where[there], gold[there]] = 1
    pair = np.zeros((2, 2))
    both = there[:, 1:]
    np.add.at(pair, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    w, trans = np.zeros((k + 1, 2)), np.zeros((2, 2))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, trans)]
    lengths = there.sum(axis=1)
    for step in range(1, steps + 1):
        scores = np.zeros((n, longest, 2))
        scores[there] = w[x].sum(axis=1)[where[there]]
        alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        alpha[:, 0] = scores[:, 0]
        for t in range(1, longest):
            alpha[:, t] = _log_sum(alpha[:, t - 1][:, :, None] + trans, 1) + scores[:, t]
        for t in range(longest - 2, -1, -1):
            ahead = _log_sum(trans + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(there[:, t + 1][:, None], ahead, 0)
        total = _log_sum(alpha[np.arange(n), lengths - 1], 1)
        marginal = np.exp(alpha + beta - total[:, None, None])
        expected = np.zeros((len(x), 2))
        expected[where[there]] = marginal[there]
        joint = np.exp(alpha[:, :-1, :, None] + trans + (scores + beta)[:, 1:, None, :] - total[:, None, None, None])
        found = np.stack([np.bincount(x.ravel(), np.repeat((y - expected)[:, c], most), k + 1) for c in (0, 1)], axis=1)
        found[k] = 0
        for p, g, (m, v) in zip((w, trans), (found / n - penalty * w, (pair - joint[both].sum(axis=0)) / n - penalty * trans), moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {"weights": {f: (float(w[i, 0]), float(w[i, 1])) for f, i in names.items()}, "transitions": trans.tolist()}


class Decoder:
    """Viterbi decoding with trained weights."""

    def __init__(self, model: dict):
        self.gain = {f: b - a for f, (a, b) in model["weights"].items()}
        (self.t00, self.t01), (self.t10, self.t11) = model["transitions"]
        self.place: dict[tuple, float] = {}

    def _score(self, b: Block) -> float:
        """Score of the article state over the other."""
        key = (b.tags, b.words)
        known = self.place.get(key)
        if known is None:
            if len(self.place) > 20_000:
                self.place.clear()
            known = self.place[key] = sum(self.gain.get(f, 0.0) for f in _place_features(*key))
        return known + sum(self.gain.get(f, 0.0) for f in _text_features(b))

    def labels(self, blocks: list[Block]) -> list[int]:
        if not blocks:
            return []
        rest, article = 0.0, self._score(blocks[0])
        back: list[tuple[int, int]] = []
        for b in blocks[1:]:
            s = self._score(b)
            from_rest, from_article = rest + self.t00, article + self.t10
            to_rest = (from_rest, 0) if from_rest >= from_article else (from_article, 1)
            from_rest, from_article = rest + self.t01, article + self.t11
            to_article = (from_article, 1) if from_article >= from_rest else (from_rest, 0)
            back.append((to_rest[1], to_article[1]))
            rest, article = to_rest[0], to_article[0] + s
        state = int(article > rest)
        out = [state]
        for pointers in reversed(back):
            state = pointers[state]
            out.append(state)
        return out[::-1]

    def text(self, page: str | None) -> str:
        blocks = leaf_blocks(page or "")
        return "\n".join(b.text for b, label in zip(blocks, self.labels(blocks)) if label)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> dict:
    """Train the field with layouts filled from the pages with the smallest identifier hashes."""
    place = F.xxhash64(F.col(id_col))
    known = pages.where(F.col(html_col).isNotNull())
    last = known.select(place.alias("place")).orderBy("place").limit(SAMPLE_PAGES).agg(F.max("place")).first()[0]
    # only pages of the sample are read to the driver: at most the bound, whatever the number of partitions
    sample = known.where(place <= F.lit(last)).select(place.alias("place"), F.substring(F.col(html_col).cast("string"), 1, SAMPLE_CHARS).alias("html"))
    rows = sample.orderBy("place", "html").limit(SAMPLE_PAGES).collect() if last is not None else []
    texts = sorted({b.text for r in rows for b in leaf_blocks(r.html)})
    return train(labelled_pages(texts))


def main_texts(pages: DataFrame, model: dict, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for b in batches:
            texts = [decoder.text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "id long, url string, text string, n_chars long")
