"""Main text of web pages by a linear-chain conditional random field over their blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.llm.htmlblocks import Block, blocks
from caselake.llm.rows import text_of, unpacked, with_row

# Bounds of the training set: pages whose words fill it, and labelled pages made of them.
WORD_PAGES, LABELLED_PAGES, EPOCHS = 200, 360, 8
OTHER, MAIN = 0, 1


def features(page: Sequence[Block]) -> list[list[str]]:
    """What is told to the model of each block: its surroundings, its text and its place."""
    out = []
    for i, block in enumerate(page):
        n = len(block.text)
        length = sum(n >= step for step in (25, 60, 140, 400))
        links = sum(block.link_share > step for step in (0.0, 0.3, 0.7))
        own = [f"near {block.nearest}", f"length {length}", f"links {links}", f"near {block.nearest} links {links}"]
        own += [f"in {name}" for name in block.around]
        own.append(f"end {block.text[-1] in '.!?…:;\"”»'} length {length}")
        if block.text[0] in "©®" or "©" in block.text[:40]:
            own.append("copyright")
        if i == 0:
            own.append("first")
        if i == len(page) - 1:
            own.append("last")
        out.append(own)
    return out


@dataclass
class ChainModel:
    """Weights of a two-label chain: a row per feature, and one weight per pair of neighbouring labels."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def scores(self, page: Sequence[Sequence[str]]) -> np.ndarray:
        out = np.zeros((len(page), 2))
        for i, own in enumerate(page):
            known = [self.index[f] for f in own if f in self.index]
            out[i] = self.weights[known].sum(0)
        return out

    def decode(self, page: Sequence[Sequence[str]]) -> list[int]:
        """The most probable labels, by the Viterbi recursion."""
        if not page:
            return []
        scores = self.scores(page).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        best, back = scores[0], []
        for s0, s1 in scores[1:]:
            a, b = best
            from0, from1 = a + m00 >= b + m10, a + m01 >= b + m11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            best = [(a + m00 if from0 else b + m10) + s0, (a + m01 if from1 else b + m11) + s1]
        labels = [int(best[1] > best[0])]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train(pages: Sequence[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS) -> ChainModel:
    """Maximum likelihood by adaptive stochastic gradients, with a small pull towards zero."""
    names = sorted({f for page, _ in pages for own in page for f in own})
    model = ChainModel({f: i for i, f in enumerate(names)}, np.zeros((len(names), 2)), np.zeros((2, 2)))
    seen_w, seen_m = np.full_like(model.weights, 1e-6), np.full((2, 2), 1e-6)
    coded = [([np.array([model.index[f] for f in own]) for own in page], np.array(labels)) for page, labels in pages]
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for at in rng.permutation(len(coded)):
            page, labels = coded[at]
            if not len(labels):
                continue
            scores = np.array([model.weights[own].sum(0) for own in page])
            node, pair = _marginals(scores, model.moves)
            miss = -node
            miss[np.arange(len(labels)), labels] += 1
            flat, times = np.concatenate(page), [len(own) for own in page]
            step = np.zeros_like(model.weights)
            np.add.at(step, flat, np.repeat(miss, times, axis=0))
            step -= 1e-4 * model.weights
            move = -pair - 1e-4 * model.moves
            np.add.at(move, (labels[:-1], labels[1:]), 1)
            seen_w += step**2
            seen_m += move**2
            model.weights += 0.3 * step / np.sqrt(seen_w)
            model.moves += 0.3 * move / np.sqrt(seen_m)
    return model


def _marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each block's label, and expected counts of label pairs, by forward and backward sums."""
    n = len(scores)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = scores[0]
    for i in range(1, n):
        ahead[i] = scores[i] + np.logaddexp(ahead[i - 1, 0] + moves[0], ahead[i - 1, 1] + moves[1])
    for i in range(n - 2, -1, -1):
        later = scores[i + 1] + behind[i + 1]
        behind[i] = np.logaddexp(moves[:, 0] + later[0], moves[:, 1] + later[1])
    whole = np.logaddexp(*ahead[-1])
    node = np.exp(ahead + behind - whole)
    pair = np.zeros((2, 2))
    for i in range(n - 1):
        pair += np.exp(ahead[i][:, None] + moves + (scores[i + 1] + behind[i + 1])[None] - whole)
    return node, pair


class PageMaker:
    """Labelled pages of many layouts, filled with the given words."""

    FRAMES = (
        ("<article>", "</article>"),
        ("<main>", "</main>"),
        ("<main><article>", "</article></main>"),
        ('<div id="content">', "</div>"),
        ('<div class="post"><div class="entry-content">', "</div></div>"),
        ('<div class="article-body">', "</div>"),
        ('<section class="story">', "</section>"),
        ('<div role="main">', "</div>"),
        ("<div>", "</div>"),
    )
    NOTES = (
        ('<div class="ad">', "</div>"),
        ('<div class="advertisement"><p>', "</p></div>"),
        ('<aside class="sidebar"><p>', "</p></aside>"),
        ("<aside><h3>", "</h3></aside>"),
        ('<div class="cookie-notice"><p>', "</p></div>"),
        ('<div id="cookie-banner">', "</div>"),
        ('<div class="consent"><p>', "</p></div>"),
        ('<form action="/s"><label>', "</label><input name=q></form>"),
        ('<form class="newsletter subscribe"><p>', "</p></form>"),
        ('<div class="sponsored promo"><p>', "</p></div>"),
        ('<div class="related"><h4>', "</h4></div>"),
        ('<div class="social-share">', "</div>"),
        ('<div class="notice"><p>', "</p></div>"),
        ('<div class="popup modal">', "</div>"),
        ('<div class="widget">', "</div>"),
    )
    REMARKS = (
        '<div class="comments">',
        '<section id="comments">',
        '<div class="comment-list">',
        '<div id="respond" class="replies">',
    )

    def __init__(self, words: Sequence[str], seed: int = 3) -> None:
        self.words, self.rng = np.array(list(words) or ["word"]), np.random.default_rng(seed)

    def _text(self, low: int, high: int, stop: bool = True) -> str:
        some = self.words[self.rng.integers(len(self.words), size=self.rng.integers(low, high))]
        return " ".join(some.tolist()).strip().capitalize() + "." * bool(stop)

    def _chance(self, p: float) -> bool:
        return self.rng.random() < p

    def page(self) -> tuple[str, list[int]]:
        parts, labels = [], []

        def add(html: str, *own: int) -> None:
            parts.append(html)
            labels.extend(own)

        def note() -> None:
            start, stop = self.NOTES[self.rng.integers(len(self.NOTES))]
            add(start + self._text(3, 40) + stop, OTHER)

        def links(start: str, stop: str) -> None:
            n = int(self.rng.integers(2, 8))
            items = "".join(f'<li><a href="/{i}">{self._text(1, 4, False)}</a></li>' for i in range(n))
            add(f"{start}<ul>{items}</ul>{stop}", *[OTHER] * n)

        if self._chance(0.4):
            add(f"<header>{self._text(1, 6, False)}</header>", OTHER)
        elif self._chance(0.4):
            add(f'<div class="header"><h1>{self._text(1, 5, False)}</h1></div>', OTHER)
        menus = (("<nav>", "</nav>"), ('<div class="menu">', "</div>"), ('<div id="navigation">', "</div>"))
        if self._chance(0.9):
            links(*menus[self.rng.integers(len(menus))])
        for _ in range(self.rng.integers(0, 3)):
            note()
        start, stop = self.FRAMES[self.rng.integers(len(self.FRAMES))]
        parts.append(start)
        if self._chance(0.9):
            title = f"<h1>{self._text(2, 12, False)}</h1>"
            add(f"<header>{title}</header>" if self._chance(0.15) and "article" in start else title, MAIN)
        for _ in range(self.rng.integers(1, 9)):
            kind = self.rng.random()
            if kind < 0.08:
                add(f"<h2>{self._text(1, 7, False)}</h2>", MAIN)
            elif kind < 0.15:
                n = int(self.rng.integers(1, 5))
                add("<ul>" + "".join(f"<li>{self._text(1, 14)}</li>" for _ in range(n)) + "</ul>", *[MAIN] * n)
            elif kind < 0.2:
                add(f"<blockquote><p>{self._text(4, 30)}</p></blockquote>", MAIN)
            elif kind < 0.24:
                add(f"<table><tr><td>{self._text(1, 3)}</td><td>{self._text(1, 3)}</td></tr></table>", MAIN, MAIN)
            elif kind < 0.34:
                note()
            else:
                link = f' <a href="/x">{self._text(1, 4, False)}</a>' if self._chance(0.25) else ""
                add(f"<p>{self._text(1, 90)}{link}</p>", MAIN)
        if self._chance(0.3):
            remarks = self.REMARKS[self.rng.integers(len(self.REMARKS))]
            n = int(self.rng.integers(1, 5))
            every = "".join(f'<div class="comment"><p>{self._text(2, 40)}</p></div>' for _ in range(n))
            add(f"{remarks}<h3>{self._text(1, 3, False)}</h3>{every}</div>", OTHER, *[OTHER] * n)
        parts.append(stop)
        for _ in range(self.rng.integers(0, 3)):
            note()
        if self._chance(0.9):
            end = f"&copy; {self._text(2, 16)}"
            add(f"<footer>{end}</footer>" if self._chance(0.7) else f'<div class="footer"><p>{end}</p></div>', OTHER)
        return "<html><body>" + "".join(parts) + "</body></html>", labels


def labelled_pages(words: Sequence[str], n: int = LABELLED_PAGES) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of ``n`` made pages; a page whose blocks and labels differ in number would be an error."""
    maker, out = PageMaker(words), []
    while len(out) < n:
        html, labels = maker.page()
        found = blocks(html)
        if len(found) != len(labels):
            raise ValueError("a made page has other blocks than labels")
        out.append((features(found), labels))
    return out


def fitted(pages: DataFrame) -> ChainModel:
    """A model trained on made pages with the words of at most ``WORD_PAGES`` different pages, those of the least hashes.

    The hashes are chosen first and without the pages, so that tasks send
    numbers only; then the chosen pages come, one of each hash.
    """
    told = pages.select(F.xxhash64("html").alias("h"), text_of("html").alias("html"))
    chosen = [row["h"] for row in told.select("h").distinct().orderBy("h").limit(WORD_PAGES).collect()]
    drawn = told.filter(F.col("h").isin(chosen)).dropDuplicates(["h"]).collect()
    words = sorted({w for row in drawn for b in blocks(row["html"]) for w in b.text.split() if len(w) < 30})
    return train(labelled_pages(words))


def main_text(html: str, model: ChainModel) -> str:
    found = blocks(html)
    return "\n".join(b.text for b, label in zip(found, model.decode(features(found))) if label == MAIN)


def extract_main_text(pages: DataFrame, model: ChainModel) -> DataFrame:
    """``pages`` with ``text``, the blocks of ``html`` labelled as main text, and ``n_chars``.

    Blocks keep their order and are joined by one line break. A page without
    main text, and a null or empty one, has the empty text. All columns are
    passed on but ``text`` and ``n_chars``, which are replaced; rows are
    independent, so repeated rows and empty tables need no care.
    """
    known = pages.sparkSession.sparkContext.broadcast(model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, known.value) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    rows = with_row(pages, html=text_of("html"))
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(extract, f"row {kind}, text string")
    return unpacked(found, text=F.col("text"), n_chars=F.char_length("text").cast("bigint"))
