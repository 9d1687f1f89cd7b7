"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its leaf blocks (``html_blocks``). Each block becomes a vector of
the hashed elements and names on its tag path, its hashed words, and measures such as length,
links and marks. A bidirectional LSTM in numpy reads the whole sequence both ways and labels
every block by what stands before and after it; blocks labelled as main text, joined, are the
page's text. All blocks are labelled; none is dropped for its length or place.

The labeller is trained when it is asked for, on ``LAYOUTS`` pages that ``layouts`` draws from
texts of a bounded sample (at most ``SAMPLE`` pages of at most ``SAMPLE_CHARS`` characters),
and on those sampled pages whose own markup says which blocks are main text (an ``article`` or
``main`` element, without what lies in menus, asides, forms or comments). The sample only
provides texts and habits; every page is read and labelled whole.

A task holds a slice of pages. Pages of like length are labelled together; a page's arrays
take about half a kilobyte for each of its blocks.

Defined cases: null or empty html, and pages without main text, give an empty text; rows with
equal ids or equal html are each a row; an empty table gives no rows; a page cut off anywhere
is read up to there. Other columns stay where ``with_text`` is used, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.llm.html_blocks import MARK, PATH_SLOTS, Block, blocks
from clickloom.llm.layouts import Layout
from clickloom.llm.textbytes import ALNUM_WORD, Texts, Words, byte_set, slices, text_udf

SAMPLE = 300
SAMPLE_CHARS = 1 << 16
LAYOUTS = 3000
WORD_SLOTS = 96
HIDDEN = 20
EPOCHS = 5
BATCH = 32
RATE = 0.02
#: Share of the path slots that a page lacks when it is trained on, as names that are new lack theirs.
DROPPED = 0.05
#: Blocks, padding included, that are labelled together.
TOGETHER = 1 << 13
_HASHES = 1 << 40

_MARKS = byte_set((0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
_ENDS = byte_set((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
_DIGITS = byte_set((0x30, 0x39))
_UPPER = byte_set((0x41, 0x5A))
MEASURES = 11
INPUTS = PATH_SLOTS + WORD_SLOTS + MEASURES


def inputs(own: list[Block]) -> np.ndarray:
    """A row for each block of one page."""
    raw = [b.text.encode() for b in own]
    data = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(r) for r in raw])
    offsets = np.concatenate([[0], np.cumsum(size)])
    words = Words(Texts(data, offsets), ALNUM_WORD, lower=True)
    n, count = len(own), np.maximum(words.counts, 1)
    out = np.zeros((n, INPUTS), np.float32)
    paths = np.fromiter((s for b in own for s in b.path), np.int64)
    out[np.repeat(np.arange(n), [len(b.path) for b in own]), paths] = 1
    block = np.repeat(np.arange(n), words.counts)
    slots = (words.hashes % np.uint64(WORD_SLOTS)).astype(np.int64)
    hashed = np.bincount(block * WORD_SLOTS + slots, minlength=n * WORD_SLOTS).reshape(n, WORD_SLOTS)
    out[:, PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = hashed / np.sqrt(count)[:, None]

    def share(members: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(members[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    at = np.arange(n)
    links = np.array([b.links / len(b.text) for b in own])
    same = np.array([0, *(a.path == b.path for a, b in zip(own, own[1:]))])
    measures = (
        np.log1p(size) / 8,
        np.log1p(words.counts) / 6,
        links,
        share(_MARKS) * 10,
        share(_DIGITS),
        share(_UPPER),
        _ENDS[data[offsets[1:] - 1]],
        _UPPER[data[offsets[:-1]]],
        same,
        at / n,
        np.minimum(at, 20) / 20,
    )
    out[:, -MEASURES:] = np.column_stack(measures)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Labeller:
    """Weights of both directions (0 forward, 1 backward) and of the label."""

    into: np.ndarray  # 2, INPUTS, 4 * hidden: gates in, forget, out and the new value
    again: np.ndarray  # 2, hidden, 4 * hidden
    bias: np.ndarray  # 2, 4 * hidden
    label: np.ndarray  # 2 * hidden + INPUTS + 1

    @property
    def hidden(self) -> int:
        return self.again.shape[1]

    def parameters(self) -> list[np.ndarray]:
        return [self.into, self.again, self.bias, self.label]

    @classmethod
    def drawn(cls, seed: int, hidden: int = HIDDEN) -> Labeller:
        draw = np.random.default_rng(seed)
        into = draw.normal(0, 0.1, (2, INPUTS, 4 * hidden)).astype(np.float32)
        again = draw.normal(0, 0.5 / np.sqrt(hidden), (2, hidden, 4 * hidden)).astype(np.float32)
        bias = np.zeros((2, 4 * hidden), np.float32)
        bias[:, hidden : 2 * hidden] = 1
        return cls(into, again, bias, np.zeros(2 * hidden + INPUTS + 1, np.float32))

    def _reads(self, way: int, rows: np.ndarray, inside: np.ndarray, keep: bool):
        """The hidden values of one direction; rows are (time, page, input), inside says which are no padding."""
        times, pages, _ = rows.shape
        h = self.hidden
        entered = (rows.reshape(-1, INPUTS) @ self.into[way] + self.bias[way]).reshape(times, pages, 4 * h)
        out = np.zeros((times, pages, h), np.float32)
        value, cell, kept = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32), []
        for t in range(times) if way == 0 else range(times - 1, -1, -1):
            gates = entered[t] + value @ self.again[way]
            opened, new = _sigmoid(gates[:, : 3 * h]), np.tanh(gates[:, 3 * h :])
            before, before_value = cell, value
            cell = (opened[:, h : 2 * h] * cell + opened[:, :h] * new) * inside[t]
            shown = np.tanh(cell)
            value = opened[:, 2 * h :] * shown
            out[t] = value
            if keep:
                kept.append((t, opened, new, before, before_value, shown))
        return out, kept

    def scores(self, rows: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """The log odds of main text, by time and page."""
        both = [self._reads(way, rows, inside, False)[0] for way in (0, 1)]
        return self._odds(both, rows)

    def _odds(self, both: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        h = self.hidden
        return both[0] @ self.label[:h] + both[1] @ self.label[h : 2 * h] + rows @ self.label[2 * h : -1] + self.label[-1]

    def gradients(self, rows: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean logistic loss over all blocks."""
        h = self.hidden
        read = [self._reads(way, rows, inside, True) for way in (0, 1)]
        error = (_sigmoid(self._odds([out for out, _ in read], rows)) - labels) * inside[:, :, 0]
        error = (error / inside.sum()).astype(np.float32)
        label = np.concatenate(
            [*(np.einsum("tp,tph->h", error, out) for out, _ in read), np.einsum("tp,tpi->i", error, rows), [error.sum()]]
        ).astype(np.float32)
        into, again, bias = np.zeros_like(self.into), np.zeros_like(self.again), np.zeros_like(self.bias)
        for way, (_, kept) in enumerate(read):
            weight = self.label[way * h : (way + 1) * h]
            to_value = np.zeros((rows.shape[1], h), np.float32)
            to_cell = np.zeros_like(to_value)
            entered = np.zeros((*rows.shape[:2], 4 * h), np.float32)
            for t, opened, new, before, before_value, shown in reversed(kept):
                to_value = to_value + error[t][:, None] * weight
                enter, forget, show = opened[:, :h], opened[:, h : 2 * h], opened[:, 2 * h :]
                to_cell = (to_cell + to_value * show * (1 - shown**2)) * inside[t]
                gates = np.concatenate(
                    [
                        to_cell * new * enter * (1 - enter),
                        to_cell * before * forget * (1 - forget),
                        to_value * shown * show * (1 - show),
                        to_cell * enter * (1 - new**2),
                    ],
                    axis=1,
                )
                entered[t] = gates
                again[way] += before_value.T @ gates
                to_value = gates @ self.again[way].T
                to_cell = to_cell * forget
            into[way] = rows.reshape(-1, INPUTS).T @ entered.reshape(-1, 4 * h)
            bias[way] = entered.sum(axis=(0, 1))
        return [into, again, bias, label]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    rows = np.zeros((longest, len(pages), INPUTS), np.float32)
    inside = np.zeros((longest, len(pages), 1), np.float32)
    for k, page in enumerate(pages):
        rows[: len(page), k], inside[: len(page), k] = page, 1
    return rows, inside


def _together(sizes: list[int], most: int) -> Iterator[list[int]]:
    """Pages of like length, as many as fit with their padding; those without blocks are left out."""
    group: list[int] = []
    for i in sorted((i for i, n in enumerate(sizes) if n), key=lambda i: sizes[i]):
        if group and (len(group) + 1) * sizes[i] > most:
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def fit(pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 7, epochs: int = EPOCHS) -> Labeller:
    """A labeller of pages given as their blocks' inputs, by Adam over batches of like length."""
    model = Labeller.drawn(seed)
    draw = np.random.default_rng(seed)
    order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
    batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    step, steps = 0, epochs * len(batches)
    for _ in range(epochs):
        for b in draw.permutation(len(batches)):
            rows, inside = _padded([pages[i] for i in batches[b]])
            rows[:, :, :PATH_SLOTS] *= draw.random((1, len(batches[b]), PATH_SLOTS)) >= DROPPED
            wanted = np.zeros(rows.shape[:2], np.float32)
            for k, i in enumerate(batches[b]):
                wanted[: len(labels[i]), k] = labels[i]
            step += 1
            rate = RATE * (1 - 0.9 * step / steps)
            for p, g, m, v in zip(model.parameters(), model.gradients(rows, inside, wanted), first, second):
                g = np.clip(g, -1, 1)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def labelled(html: str) -> tuple[list[Block], np.ndarray]:
    """The blocks of a drawn page, marks removed, and which were marked."""
    own = blocks(html)
    marked = np.array([MARK in b.text for b in own], np.float32)
    return [Block(b.text.replace(MARK, ""), b.path, b.links) for b in own if b.text != MARK], marked[[b.text != MARK for b in own]]


def _by_markup(html: str) -> tuple[list[Block], np.ndarray] | None:
    """The blocks of a page whose elements say which of them are main text; None if they don't."""
    own = blocks(html)
    labels = np.array([b.told for b in own], np.float32)
    return (own, labels) if labels.any() else None


def training_pages(sample: list[str], count: int = LAYOUTS, seed: int = 11) -> list[tuple[list[Block], np.ndarray]]:
    read = [_by_markup(html.replace(MARK, "")) for html in sample]
    texts = [b.text for html in sample for b in blocks(html.replace(MARK, ""))]
    layout = Layout(seed, texts)
    drawn = [labelled(layout.page()) for _ in range(count)]
    return [p for p in drawn + [r for r in read if r] if len(p[0])]


def train(pages: DataFrame, html: str = "html", most: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Labeller:
    """Train on at most ``most`` pages' texts; which ones follows from the rows alone.

    A row's hash says whether it is drawn, with a bound that about twice as many reach, so
    tasks send no more than those, whatever the number of tasks and of equal pages.
    """
    plain = [f.name for f in pages.schema if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType, T.VariantType))]
    reach = int(_HASHES * min(1.0, 2 * most / max(1, pages.count())))
    sample = pages.select(F.col(html).alias("html"), F.xxhash64(*plain).alias("key"))
    sample = sample.filter((F.pmod("key", F.lit(_HASHES)) < reach) & (F.char_length("html") <= chars))
    sample = sample.orderBy("key", "html").limit(most)
    own = training_pages([r["html"] for r in sample.collect()])
    return fit([inputs(b) for b, _ in own], [labels for _, labels in own])


def _main(model: Labeller):
    def make():
        def main(texts: pa.Array) -> pa.Array:
            out: list[str] = []
            for part in slices(texts):
                pages = [blocks(part.text(i)) for i in range(len(part))]
                told = labels_of(model, pages)
                out += ["\n\n".join(b.text for b, yes in zip(own, which) if yes) for own, which in zip(pages, told)]
            return pa.array(out, pa.string())

        return main

    return make


def labels_of(model: Labeller, pages: list[list[Block]]) -> list[np.ndarray]:
    """Which blocks of each page are main text."""
    out = [np.zeros(0, bool)] * len(pages)
    for group in _together([len(p) for p in pages], TOGETHER):
        rows, inside = _padded([inputs(pages[i]) for i in group])
        odds = model.scores(rows, inside)
        for k, i in enumerate(group):
            out[i] = odds[: len(pages[i]), k] > 0
    return out


def main_text(html: Column, model: Labeller) -> Column:
    """The main text of each page: its blocks in order, an empty line between."""
    return text_udf(_main(model), "string")(html)


def with_text(pages: DataFrame, model: Labeller | None = None, html: str = "html", into: str = "text") -> DataFrame:
    """The pages with a column of their main text."""
    return pages.withColumn(into, main_text(pages[html], model or train(pages, html)))
