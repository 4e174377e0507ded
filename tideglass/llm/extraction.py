"""Main text of web pages by a linear-chain conditional random field (operator 6).

The leaf blocks of a page are a chain with the labels boilerplate and content. Features are the
tags and the name parts of a block's ancestors, and properties of its text that hold in any
language. The field is trained, by gradient ascent of its likelihood with forward and backward
sums, on pages that ``labelled_pages`` lays out in many ways, so that the label of each block is
known; the best labels of a page are found by Viterbi's algorithm.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideglass.llm import texts
from tideglass.llm.pages import Block, leaf_blocks

TRAIN_PAGES = 500
STEPS = 120

# Parts of class names, ids and roles that pages commonly use, by what they mark.
NAME_GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip tabs",
    "head": "header masthead topbar logo branding banner toolbar",
    "foot": "footer foot copyright colophon legal imprint contentinfo",
    "side": "sidebar side aside widget related recommended complementary share sharing social tags "
            "teaser trending popular",
    "advert": "ad ads advert advertisement advertising promo promotion sponsor sponsored dfp",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay newsletter subscribe "
              "signup paywall warning banner",
    "form": "form login search contact register feedback",
    "reader": "comment comments reply replies respond disqus discussion reviews",
    "body": "content article post entry story text body main page",
}
_GROUP = {}
for _g, _names in NAME_GROUPS.items():
    for _n in _names.split():
        _GROUP.setdefault(_n, []).append(f"name:{_g}")
_SENTENCE_END = tuple(".!?…:;\"'”»)")


def _path_features(path: tuple) -> tuple[str, ...]:
    found = {f"in:{tag}" for tag, _ in path}
    for _, names in path:
        for name in names:
            found.update(_GROUP.get(name, ()))
    found.add(f"tag:{path[-1][0]}" if path else "tag:")
    return tuple(sorted(found))


def _text_features(block: Block) -> list[str]:
    text = block.text
    n = text.count(" ") + 1
    share = block.linked / len(text)
    out = ["bias", f"words:{min(6, n.bit_length())}",
           "links:" + ("0" if share == 0 else "low" if share < 0.5 else "high")]
    if text.endswith(_SENTENCE_END):
        out.append("ends")
    if "," in text:
        out.append("comma")
    if "©" in text or "|" in text:
        out.append("sign")
    if any(c.isdigit() for c in text):
        out.append("digit")
    return out


@dataclass
class Field:
    """Weights of content against boilerplate by feature; ``step[a][b]`` for neighbouring labels."""

    weight: dict[str, float]
    step: list[list[float]]
    first: list[float]

    def __post_init__(self) -> None:
        self._paths: dict[tuple, float] = {}

    def _path_score(self, path: tuple) -> float:
        score = self._paths.get(path)
        if score is None:
            if len(self._paths) > 20_000:
                self._paths.clear()
            score = self._paths[path] = sum(
                self.weight.get(f, 0.0) for f in _path_features(path))
        return score

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels (1 is content); of two equal ways the one with less content."""
        if not blocks:
            return []
        back, (s0, s1) = [], self.first
        (a, b), (c, d) = self.step
        for k, block in enumerate(blocks):
            if k:
                from0, from1 = (s0 + a, s0 + b), (s1 + c, s1 + d)
                back.append((int(from1[0] > from0[0]), int(from1[1] > from0[1])))
                s0, s1 = max(from0[0], from1[0]), max(from0[1], from1[1])
            s1 += self._path_score(block.path) + sum(
                self.weight.get(f, 0.0) for f in _text_features(block))
        label = int(s1 > s0)
        out = [label]
        for came in reversed(back):
            label = came[label]
            out.append(label)
        return out[::-1]


def main_text(html: str | None, field: Field) -> str:
    blocks = leaf_blocks(html)
    return "\n".join(b.text for b, y in zip(blocks, field.decode(blocks)) if y)


# -- labelled pages ---------------------------------------------------------------------------

_SYLLABLES = "an ble che den er fa gu hin io ja ka li mo ne or pu qua ré sa ti um vo we xy zö ção".split()


class _Layout:
    """Writes pages as (markup, text, label) in turn; each text becomes one block."""

    def __init__(self, rng: random.Random) -> None:
        self.rng, self.html, self.labels = rng, [], []

    def words(self, n: int) -> str:
        r = self.rng
        out = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(n)]
        if r.random() < 0.1:
            out = [w + r.choice(("###", "$$$", "!!", "&amp;", " |")) for w in out]
        if r.random() < 0.05:
            out = [w.upper() for w in out]
        return " ".join(out)

    def prose(self) -> str:
        r, text = self.rng, []
        for _ in range(r.choice((1, 1, 2, 3, 6))):
            s = self.words(r.choice((1, 2, 4, 8, 15, 30)))
            text.append(s[0].upper() + s[1:] + r.choice((".", ".", ".", "?", "")))
        return " ".join(text)

    def raw(self, markup: str) -> None:
        self.html.append(markup)

    def text(self, before: str, text: str, after: str, label: int) -> None:
        self.html += [before, text, after]
        self.labels.append(label)

    def links(self, label: int = 0) -> None:
        r = self.rng
        for _ in range(r.randint(2, 8)):
            word = self.words(r.choice((1, 1, 2, 3)))
            if r.random() < 0.8:
                self.text(f'<li><a href="/{word}">', word, "</a></li>", label)
            else:
                self.text("<div><a href='#'>", word, "</a></div>", label)

    def wrapped(self, choices: list[str], inside, closed: float = 1.0) -> None:
        opening = self.rng.choice(choices)
        self.raw(f"<{opening}>")
        inside()
        if self.rng.random() < closed:
            self.raw(f"</{opening.split()[0]}>")

    def menu(self) -> None:
        self.wrapped(["nav", "div class='menu'", 'ul class="nav-list"', "div id=breadcrumbs",
                      'div role="navigation"'], self.links)

    def page_head(self) -> None:
        def inside() -> None:
            self.text("<div>", self.words(2), "</div>", 0)
            if self.rng.random() < 0.5:
                self.links()
        self.wrapped(["header", 'div id="header"', 'div class="masthead"', "div class=topbar"], inside)

    def advert(self) -> None:
        opening = self.rng.choice(['div class="ad"', "div class='advert'", 'section id="promo-3"',
                                   'aside class="sponsored"', 'div class="ads box"'])
        self.text(f"<{opening}>", self.prose(), f"</{opening.split()[0]}>", 0)

    def notice(self) -> None:
        opening = self.rng.choice(['div class="cookie-notice"', 'div id="consent"',
                                   'section class="alert"', 'div class="newsletter"', "dialog"])
        self.raw(f"<{opening}>")
        self.text("<p>", self.prose(), "</p>", 0)
        if self.rng.random() < 0.5:
            self.text("<button>", self.words(1), "</button>", 0)
        self.raw(f"</{opening.split()[0]}>")

    def side(self) -> None:
        def inside() -> None:
            self.text("<h3>", self.words(2), "</h3>", 0)
            if self.rng.random() < 0.6:
                self.links()
            else:
                self.text("<p>", self.prose(), "</p>", 0)
        self.wrapped(["aside", 'div class="sidebar"', 'div id="related-posts"',
                      'section class="widget"', 'div class="social-share"'], inside)

    def form(self) -> None:
        def inside() -> None:
            self.text("<label>", self.words(1), "</label><input>", 0)
            self.text("<p>", self.prose(), "</p>", 0)
            self.text("<button type=submit>", self.words(1), "</button>", 0)
        self.wrapped(["form", 'form class="search"', 'form id="contact"'], inside)

    def comments(self) -> None:
        def inside() -> None:
            self.text("<h3>", self.words(1), "</h3>", 0)
            for _ in range(self.rng.randint(1, 4)):
                self.text('<div class="comment"><p>', self.prose(), "</p></div>", 0)
        self.wrapped(['section class="comments"', 'div id="comments"', "ol class=comment-list",
                      'div class="discussion"', 'div id="reader-comments"'], inside)

    def foot(self) -> None:
        def inside() -> None:
            self.text(self.rng.choice(("<div>", "<p>", "<small>")),
                      "&copy; " + self.words(2) + self.rng.choice((" &middot; ", " 2021 ", " | "))
                      + self.words(2), "", 0)
        self.wrapped(["footer", 'div id="footer"', 'div class="site-footer"'], inside,
                     0.9)

    def article(self) -> None:
        r = self.rng

        def inside() -> None:
            title = r.choice(("h1", "h1", "h2"))
            inner = r.random() < 0.2
            if r.random() < 0.75:
                self.raw("<header>" if inner else "")
                self.text(f"<{title}>", r.choice((self.words(5), self.prose())), f"</{title}>", 1)
                self.raw("</header>" if inner else "")
            for _ in range(r.choice((1, 2, 4, 8, 16))):
                kind = r.random()
                if kind < 0.55:
                    self.text("<p>", self.prose(), r.choice(("</p>", "</p>", "</p>\n", "")), 1)
                elif kind < 0.7:
                    self.text("<p><b>", self.prose(), "<br>", 1)
                elif kind < 0.78:
                    self.text("<p>", f"{self.prose()} <a href='x'>{self.words(2)}</a> {self.words(4)}",
                              "</p>", 1)
                elif kind < 0.84:
                    self.raw("<ul>")
                    for _ in range(r.randint(1, 4)):
                        self.text("<li>", self.prose(), "</li>", 1)
                    self.raw("</ul>")
                elif kind < 0.88:
                    self.text("<blockquote>", self.prose(), "</blockquote>", 1)
                elif kind < 0.91:
                    self.text("<h2>", self.words(3), "</h2>", 1)
                elif kind < 0.94:
                    self.text("<div>", self.prose(), "</div>", 1)
                elif kind < 0.96:
                    self.raw("<table><tr>")
                    self.text("<td>", self.words(2), "</td>", 1)
                    self.text("<td>", self.words(3), "</td></tr></table>", 1)
                elif kind < 0.98:
                    self.advert()
                else:
                    self.side()
        self.wrapped(["article", "article", "article", "main", 'div class="content"',
                      'div class="post entry"', 'div id="article-body"', 'div class="story text"',
                      'section class="main-content"', "div"], inside)

    def page(self) -> None:
        r = self.rng
        self.raw('<!DOCTYPE html><html><head><title>t</title></head><body class="page">')
        if r.random() < 0.5:
            self.raw("<div id='page'>")
        before = [self.menu, self.page_head, self.advert, self.notice, self.side]
        after = [self.comments, self.side, self.form, self.advert, self.foot, self.notice]
        for part in [p for p in before if r.random() < 0.45]:
            part()
        wide = r.random() < 0.3
        self.raw("<main>" if wide else "")
        self.article()
        self.raw("</main>" if wide else "")
        for part in [p for p in after if r.random() < 0.45]:
            part()
        self.raw("</body></html>" if r.random() < 0.9 else "")


def labelled_pages(n: int = TRAIN_PAGES, seed: int = 3) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels of ``n`` pages of random layout."""
    out = []
    for k in range(n):
        layout = _Layout(random.Random(f"{seed}/{k}"))
        layout.page()
        blocks = leaf_blocks("".join(layout.html))
        if len(blocks) != len(layout.labels):
            raise AssertionError("a laid-out page must have one block a text")
        out.append((blocks, layout.labels))
    return out


# -- training -------------------------------------------------------------------------------

def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS,
          penalty: float = 1e-3) -> Field:
    """Adam on the mean log-likelihood of the pages' labels, all pages at once."""
    rows = [[[*_path_features(b.path), *_text_features(b)] for b in blocks] for blocks, _ in pages]
    names = sorted({f for page in rows for block in page for f in block})
    index = {f: k for k, f in enumerate(names)}
    longest = max(len(p) for p in rows)
    flat = [(p, t, index[f]) for p, page in enumerate(rows) for t, fs in enumerate(page) for f in fs]
    at_page, at_block, at_feature = np.array(flat).T
    label = np.zeros((len(pages), longest), int)
    inside = np.zeros((len(pages), longest), bool)
    for p, (_, y) in enumerate(pages):
        label[p, :len(y)], inside[p, :len(y)] = y, True
    last = inside.sum(axis=1) - 1
    every = np.arange(len(pages))

    w, step, first = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    params = [w, step, first]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    both = inside[:, 1:]
    seen_steps = np.zeros((2, 2))
    np.add.at(seen_steps, (label[:, :-1][both], label[:, 1:][both]), 1)
    seen_first = np.bincount(label[:, 0], minlength=2)
    for it in range(1, steps + 1):
        score = np.zeros((len(pages), longest, 2))
        np.add.at(score[:, :, 1], (at_page, at_block), w[at_feature])
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = first + score[:, 0]
        for t in range(1, longest):
            forward[:, t] = score[:, t] + _log_sum(forward[:, t - 1, :, None] + step, 1)
        for t in range(longest - 2, -1, -1):
            come = _log_sum(step + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], come, 0)
        total = _log_sum(forward[every, last], 1)
        single = np.exp(forward + backward - total[:, None, None]) * inside[:, :, None]
        pair = np.exp(forward[:, :-1, :, None] + step + (score + backward)[:, 1:, None, :]
                      - total[:, None, None, None]) * both[:, :, None, None]
        miss = (label - single[:, :, 1]) * inside
        g = [np.bincount(at_feature, miss[at_page, at_block], len(names)) / len(pages) - penalty * w,
             (seen_steps - pair.sum(axis=(0, 1))) / len(pages) - penalty * step,
             (seen_first - single[:, 0].sum(axis=0)) / len(pages) - penalty * first]
        for k, p in enumerate(params):
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.01 * (g[k] ** 2 - v[k])
            p += 0.1 * (m[k] / (1 - 0.9 ** it)) / (np.sqrt(v[k] / (1 - 0.99 ** it)) + 1e-8)
    if not all(math.isfinite(x) for x in w):
        raise ArithmeticError("training diverged")
    return Field(dict(zip(names, w.tolist())), step.tolist(), first.tolist())


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html", field: Field | None = None) -> DataFrame:
    """One row a page: page_id, url, text (main blocks joined by a line feed) and n_chars.

    ``field`` is trained on ``labelled_pages()`` unless given. NULL and empty pages, and pages
    without content, have the empty text. Repeated rows are extracted each. An empty table gives
    no rows. Other columns of ``pages`` play no part.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field or train(labelled_pages()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, 2):
            found = [main_text(h, shared.value) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")) \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
