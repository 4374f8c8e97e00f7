"""HTML extraction by a linear-chain conditional random field over leaf blocks.

A page is a run of leaf blocks; each is main text or not.  The field has a weight per feature and label and one per pair
of neighbouring labels.  It is trained by maximum likelihood (forward-backward, gradient ascent) on labelled pages, and
the labels of a page are its likeliest run (Viterbi).  Features are the tags and the kinds of class names around a
block, its length, links, punctuation and place.

Labelled pages come from ``labelled_pages``, which lays out invented pages whose every block is known, or from the
caller; at most ``TRAINING_PAGES`` are used.  The weights (a few hundred numbers) travel to the tasks; pages are
independent of each other, so there is no shuffle.

Cases: NULL, empty and text-free html give the empty string and 0 characters; a NULL URL stays NULL; repeated rows are
extracted one by one; an empty table gives an empty table; further columns are ignored.  Malformed markup and very long
or deeply nested pages take time in proportion to their length (see ``html_blocks``).
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.llm.html_blocks import Block, Node, blocks

TRAINING_PAGES = 400
EPOCHS = 60

# What class names and ids tell.
KINDS = {
    "ad": r"\b(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|adsense)\b",
    "comment": r"comment|disqus|\brepl(?:y|ies)\b|\bresponses?\b",
    "nav": r"\bnav|menu|breadcrumb|pagination|\bpager\b|\btoc\b",
    "footer": r"foot|copyright|colophon",
    "header": r"\bheader|masthead|topbar|site-title|\blogo\b",
    "side": r"side-?bar|aside|related|widget|recommend|\brail\b|trending|popular",
    "notice": r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|paywall",
    "form": r"\bform|login|sign-?up|search|contact-us",
    "share": r"share|social|\btags?\b|byline|\bmeta\b",
    "main": r"article|content|\bpost\b|entry|\bmain\b|story|\bbody\b|\btext\b",
}
KIND_TESTS = {k: re.compile(p) for k, p in KINDS.items()}


# Tags that say nothing of what the text is, and those looked through for the innermost telling one.
PLAIN = frozenset("html body b i em strong span a".split())
INLINE = frozenset("a b i em strong span small u".split())


@lru_cache(maxsize=4096)
def _short_kinds(names: str) -> frozenset[str]:
    return frozenset(k for k, test in KIND_TESTS.items() if test.search(names))


def _kinds(names: str) -> frozenset[str]:
    return _short_kinds(names) if len(names) <= 200 else _short_kinds.__wrapped__(names)


class _Around(NamedTuple):
    """What the tags open around a block come to."""

    score: float
    kinds: frozenset[str]
    inner: str


def _around(node: Node | None, weights: dict[str, float], known: dict[Node, _Around]) -> _Around:
    """The score of the features of ``node`` and the tags around it; each tag is looked at once a page."""
    new = []
    while node is not None and node not in known:
        new.append(node)
        node = node.parent
    at = known[node] if node is not None else _Around(0.0, frozenset(), "none")
    for node in reversed(new):
        more = _kinds(node.names) - at.kinds
        score = at.score + sum(weights.get(f"kind:{k}", 0.0) for k in sorted(more))
        if node.first and node.tag not in PLAIN:
            score += weights.get(f"in:{node.tag}", 0.0)
        at = known[node] = _Around(score, at.kinds | more if more else at.kinds, at.inner if node.tag in INLINE else node.tag)
    return at


def _own(page: list[Block], i: int, inner: str) -> list[str]:
    """Features of a block's text, links and place."""
    b = page[i]
    words = b.text.count(" ") + 1
    density = b.linked / max(1, len(b.text))
    return [
        "bias", f"tag:{inner}", f"words:{min(6, int(math.log2(words)))}", f"links:{0 if not b.linked else 1 if density < 0.5 else 2}",
        f"ends:{b.text[-1] in '.!?…\"\''}", f"rights:{b.text[:1] == '©' or 'copyright' in b.text[:60].lower()}",
        f"place:{'first' if i == 0 else 'last' if i + 1 == len(page) else 'mid'}",
    ]


def features(page: list[Block]) -> list[list[str]]:
    """The names of each block's features."""
    out = []
    for i, b in enumerate(page):
        found = {f"in:{t}" for t, _ in b.path if t not in PLAIN}
        found |= {f"kind:{k}" for _, names in b.path for k in _kinds(names)}
        inner = next((t for t, _ in reversed(b.path) if t not in INLINE), "none")
        out.append(sorted(found.union(_own(page, i, inner))))
    return out


class Field:
    """Linear-chain conditional random field with labels 0 and 1."""

    def __init__(self, weights: dict[str, float], moves: list[list[float]]):
        self.weights, self.moves = weights, moves  # weights count for label 1; label 0 scores 0

    def label(self, page: list[Block]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        if not page:
            return []
        known: dict[Node, _Around] = {}
        scores = []
        for i, b in enumerate(page):
            around = _around(b.node, self.weights, known)
            scores.append(around.score + sum(self.weights.get(f, 0.0) for f in _own(page, i, around.inner)))
        best = [0.0, scores[0]]
        back: list[tuple[int, int]] = []
        m = self.moves
        for s in scores[1:]:
            from0 = 0 if best[0] + m[0][0] >= best[1] + m[1][0] else 1
            from1 = 0 if best[0] + m[0][1] > best[1] + m[1][1] else 1
            best = [best[from0] + m[from0][0], best[from1] + m[from1][1] + s]
            back.append((from0, from1))
        at = 0 if best[0] > best[1] else 1
        out = [at]
        for step in reversed(back):
            at = step[at]
            out.append(at)
        return out[::-1]

    @classmethod
    def train(cls, pages: Iterable[tuple[list[Block], list[int]]], epochs: int = EPOCHS, penalty: float = 0.01) -> Field:
        """Maximum likelihood with an L2 penalty, over all pages at once, by steps scaled per weight."""
        data = [(features(p), y) for p, y in pages if p]
        index = {f: i for i, f in enumerate(sorted({f for fs, _ in data for b in fs for f in b}))}
        length = max((len(y) for _, y in data), default=0)
        x = np.zeros((len(data), length, len(index)), np.float32)
        y = np.zeros((len(data), length), int)
        real = np.zeros((len(data), length), bool)
        for d, (fs, labels) in enumerate(data):
            for i, (found, label) in enumerate(zip(fs, labels)):
                x[d, i, [index[f] for f in found]] = 1
                y[d, i] = label
                real[d, i] = True
        w, moves = np.zeros(len(index)), np.zeros((2, 2))
        seen_w, seen_m = np.full(len(index), 1e-6), np.full((2, 2), 1e-6)
        for _ in range(epochs):
            emit = np.zeros((len(data), length, 2))
            emit[:, :, 1] = x @ w
            forward, backward = np.zeros_like(emit), np.zeros_like(emit)
            if length:
                forward[:, 0] = emit[:, 0]
            for i in range(1, length):
                step = np.logaddexp.reduce(forward[:, i - 1, :, None] + moves[None], axis=1) + emit[:, i]
                forward[:, i] = np.where(real[:, i, None], step, forward[:, i - 1])
            for i in range(length - 2, -1, -1):
                step = np.logaddexp.reduce(moves[None] + (emit[:, i + 1] + backward[:, i + 1])[:, None, :], axis=2)
                backward[:, i] = np.where(real[:, i + 1, None], step, 0.0)
            total = np.logaddexp.reduce(forward[:, -1], axis=1) if length else np.zeros(0)
            posterior = np.exp(forward + backward - total[:, None, None])[:, :, 1] * real
            gradient = np.einsum("dik,di->k", x, (y - posterior) * real) - penalty * w
            pair = np.zeros((2, 2))
            for i in range(1, length):
                on = real[:, i]
                expected = np.exp(forward[on, i - 1, :, None] + moves[None] + (emit[on, i] + backward[on, i])[:, None, :] - total[on, None, None])
                pair -= expected.sum(axis=0)
                np.add.at(pair, (y[on, i - 1], y[on, i]), 1)
            pair -= penalty * moves
            seen_w += gradient**2
            seen_m += pair**2
            w += 0.5 * gradient / np.sqrt(seen_w)
            moves += 0.5 * pair / np.sqrt(seen_m)
        return cls({f: float(w[i]) for f, i in index.items()}, moves.tolist())


def labelled_pages(n: int, seed: int = 7) -> Iterator[tuple[str, list[int]]]:
    """Invented pages with the labels of their leaf blocks: many layouts, with and without telling tags and names."""
    rng = random.Random(seed)
    syllables = "an be co da el fi go hu in jo ka le mo nu or pa qui re so ti un ve wa xi yo ze".split()

    def sentence(least, most):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(least, most))]
        return " ".join(words).capitalize() + rng.choice([".", ".", ".", "!", "?"])

    def prose():
        return " ".join(sentence(1, 14) for _ in range(rng.choice([1, 1, 2, 4, 8])))

    for _ in range(n):
        labels: list[int] = []

        def say(text, label, labels=labels):
            labels.append(label)
            return text

        def menu():
            items = "".join(f'<li><a href="/x">{say(sentence(1, 2).rstrip(".!?"), 0)}</a></li>' for _ in range(rng.randint(2, 7)))
            return f"<ul>{items}</ul>"

        def wrap(tags, inner):
            tag = rng.choice(tags)
            return f"<{tag}>{inner}</{tag.split()[0]}>"

        def off(kind):
            text = say(prose(), 0)
            return wrap(kind, rng.choice([text, f"<p>{text}</p>", f"<span>{text}</span>"]))

        ad = ['div class="ad"', 'div class="advert box"', 'div id="ads"', 'aside class="sponsored"', 'div class="banner promo"']
        notice = ['div class="cookie-notice"', 'div id="consent"', 'section class="newsletter"', 'div role="alert" class="alert"', 'dialog']
        side = ["aside", 'div class="sidebar"', 'div class="related widget"', 'section id="trending"']
        parts = []
        if rng.random() < 0.4:
            parts.append(off(notice))
        if rng.random() < 0.5:
            parts.append(wrap(["header", 'div class="header"', 'div id="masthead"'], f"<h1>{say(sentence(1, 6), 0)}</h1>" if rng.random() < 0.5 else say(prose(), 0)))
        if rng.random() < 0.9:
            parts.append(wrap(["nav", 'div class="menu"', "nav", 'div id="nav"', 'ul class="nav"'], menu()))
        if rng.random() < 0.7:
            parts.append(off(ad))
        if rng.random() < 0.3:
            parts.append(off(side))
        body = [f"<h1>{say(sentence(2, 10), 1)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.randint(0 if body else 1, 9)):
            r = rng.random()
            if r < 0.08:
                body.append(off(ad))
            elif r < 0.12:
                body.append(off(side))
            elif r < 0.15:
                body.append(off(notice))
            elif r < 0.25:
                body.append(f"<h2>{say(sentence(1, 5), 1)}</h2>")
            elif r < 0.33:
                body.append("<ul>" + "".join(f"<li>{say(sentence(2, 12), 1)}</li>" for _ in range(rng.randint(1, 4))) + "</ul>")
            elif r < 0.38:
                body.append(f"<blockquote>{say(prose(), 1)}</blockquote>")
            elif r < 0.42:
                body.append(f"<div>{say(prose(), 1)}</div>")
            elif r < 0.55:
                body.append(f'<p>{say(sentence(1, 8) + " " + prose(), 1)} <a href="/y">{sentence(1, 3)}</a></p>')
            elif r < 0.65:
                body.append(f"<p><b>{say(prose(), 1)}<br>")
            else:
                body.append(f"<p>{say(prose(), 1)}</p>")
        inner = "".join(body)
        if rng.random() < 0.35:
            talk = "".join(f"<p>{say(prose(), 0)}</p>" for _ in range(rng.randint(1, 4)))
            inner += wrap(['div class="comments"', 'section id="comments"', 'ol class="comment-list"', 'div class="replies"'], talk)
        if rng.random() < 0.2:
            inner += wrap(['div class="share social"', 'div class="tags"'], menu())
        parts.append(wrap(["article", "article", "article", "main", 'div class="content"', 'div id="main"', 'div class="post entry"', "div"], inner))
        if rng.random() < 0.25:
            talk = "".join(f"<div>{say(prose(), 0)}</div>" for _ in range(rng.randint(1, 4)))
            parts.append(wrap(['div class="comments"', 'section id="comments"', 'div id="disqus_thread"'], talk))
        if rng.random() < 0.3:
            parts.append(off(side))
        if rng.random() < 0.25:
            parts.append(f"<form>{say(sentence(1, 5), 0)}<input></form>")
        if rng.random() < 0.9:
            start = rng.choice(["&copy; x.example.org &middot; ", "&copy; ", "Copyright ", ""])
            parts.append(wrap(["footer", "footer", 'div class="footer"', 'div id="footer"'], say(start + prose(), 0)))
        yield "<html><head><title>x</title></head><body>" + "".join(parts) + "</body></html>", labels


def trained(pages: Iterable[tuple[str, list[int]]] | None = None, most: int = TRAINING_PAGES) -> Field:
    """A field from labelled pages (html and its blocks' labels), the first ``most`` of them."""
    ready = []
    for page, labels in pages if pages is not None else labelled_pages(most):
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(found)} blocks")
        ready.append((found, labels))
        if len(ready) == most:
            break
    return Field.train(ready)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return trained()


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    return " ".join(b.text for b, y in zip(found, field.label(found)) if y)


def extract_text(pages: DataFrame, field: Field | None = None, *, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    field = field or default_field()

    def rows(batches):
        for batch in batches:
            texts = [main_text(p, field) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    picked = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    return picked.mapInArrow(rows, "page_id long, url string, text string, n_chars long")
