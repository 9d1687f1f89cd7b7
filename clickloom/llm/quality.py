"""Quality rules: gradient-boosted trees over document statistics, under fixed base rules.

The statistics of whole texts come from one pass over their bytes. Trees are fitted on a
bounded sample of labelled documents (at most ``LABELLED`` labels, those with the smallest
hashes of their ids, and at most twice as many rows, should ids repeat) and may only move
against more symbols, more repeated lines and more repeated words. The threshold keeps all but
``MISSED`` of the good documents of held-out folds, and is never above one half: what the trees
take for more likely good than not is kept.

Windows and lines are compared by 64-bit hashes within their document.

Defined cases: a null or empty text has no words and fails the base rules; a very long one is
read whole. Rows with equal ids are each judged on their own text; a label without a document or without a value is
left out; a document labelled twice counts twice. With labels of one class only, or none,
the base rules alone decide. Other columns stay, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import boosting
from clickloom.llm.textbytes import SPACED_WORD, Texts, Words, byte_set, mixed, slices, span_hashes, text_udf, window_hashes

LABELLED = 4000
MISSED = 0.005
FOLDS = 4
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_chars", "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_ends", "n_marks")
#: Features of the trees and the way each may move the score.
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "upper_share": 0,
    "digit_share": 0,
    "ends_per_word": 0,
    "marks_per_word": 0,
    "words_per_line": 0,
}

_SYMBOLS = byte_set(*((ord(c), ord(c)) for c in "#*$%&|<>"))
_ENDS = byte_set(*((ord(c), ord(c)) for c in ".!?"))
_MARKS = byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_UPPER, _DIGITS = byte_set((0x41, 0x5A)), byte_set((0x30, 0x39))
_FIRST_BYTES = ~byte_set((0x80, 0xBF))


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _of_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mixed(hashes + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _lines(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines of each text, and those with a word that equal an earlier line of it."""
    breaks = np.flatnonzero(texts.data == 10)
    of = np.searchsorted(texts.offsets, breaks, "right") - 1
    n_lines = np.bincount(of, minlength=len(texts)) + 1
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([texts.offsets[1:], breaks]), kind="stable")
    text = np.repeat(np.arange(len(texts)), n_lines)
    filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, text = starts[filled], ends[filled], text[filled]
    keys = _of_text(span_hashes(texts.data, starts, ends), text)
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return n_lines, np.bincount(text[again], minlength=len(texts))


def _repeated(words: Words, n_texts: int) -> np.ndarray:
    text = np.repeat(np.arange(n_texts), words.counts)
    windows = window_hashes(words.hashes, WINDOW)
    at = np.flatnonzero(text[: len(windows)] == text[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    _, which, count = np.unique(_of_text(windows[at], text[at]), return_inverse=True, return_counts=True)
    at = at[count[which] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    cover[at] += 1
    cover[at + WINDOW] -= 1
    return np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n_texts)


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    words = Words(texts, SPACED_WORD, lower=False)
    text = np.repeat(np.arange(len(texts)), words.counts)
    inside = SPACED_WORD[texts.data]
    n_lines, dup = _lines(texts, words)
    distinct = np.unique(_of_text(words.hashes, text), return_index=True)[1]
    data, offsets = texts.data, texts.offsets
    return {
        "n_words": words.counts,
        "word_chars": _per_text(inside & _FIRST_BYTES[data], offsets),
        "n_symbols": _per_text(_SYMBOLS[data], offsets),
        "n_dup_lines": dup,
        "n_repeat_words": _repeated(words, len(texts)),
        "n_chars": _per_text(_FIRST_BYTES[data], offsets),
        "n_lines": n_lines,
        "n_distinct_words": np.bincount(text[distinct], minlength=len(texts)),
        "n_upper": _per_text(_UPPER[data], offsets),
        "n_digits": _per_text(_DIGITS[data], offsets),
        "n_ends": _per_text(_ENDS[data], offsets),
        "n_marks": _per_text(_MARKS[data], offsets),
    }


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["n_chars"], 1)
    return np.column_stack(
        [
            np.log1p(s["n_words"]),
            s["word_chars"] / words,
            s["n_symbols"] / words,
            s["n_dup_lines"] / s["n_lines"],
            s["n_repeat_words"] / words,
            s["n_distinct_words"] / words,
            s["n_upper"] / chars,
            s["n_digits"] / chars,
            s["n_ends"] / words,
            s["n_marks"] / words,
            s["n_words"] / s["n_lines"],
        ]
    ).astype(float)


@dataclass(frozen=True)
class QualityModel:
    trees: boosting.Trees
    threshold: float


def fit_quality(rows: np.ndarray, labels: np.ndarray) -> QualityModel:
    """Trees on all rows; the threshold from scores that each fold gets of trees without it."""
    signs = np.array(list(FEATURES.values()))
    labels = np.asarray(labels)
    scores, fold = np.full(len(labels), np.nan), np.arange(len(labels)) % FOLDS
    for k in range(FOLDS):
        if 0 < labels[fold != k].sum() < (fold != k).sum():
            scores[fold == k] = boosting.fit(rows[fold != k], labels[fold != k], signs).probability(rows[fold == k])
    good = scores[(labels == 1) & ~np.isnan(scores)]
    threshold = float(np.quantile(good, MISSED, method="lower")) if len(good) and (labels == 0).any() else 0.0
    return QualityModel(boosting.fit(rows, labels, signs), min(threshold, 0.5))


def _judge(model: QualityModel | None):
    kinds = [(name, pa.int64()) for name in (*COUNTS, *MORE_COUNTS)]
    kinds += [("score", pa.float64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]

    def make():
        def judge(texts: pa.Array) -> pa.Array:
            parts = [_judged(part, model) for part in slices(texts)]
            columns = [pa.concat_arrays([pa.array(p[n], t) for p in parts]) if parts else pa.array([], t) for n, t in kinds]
            return pa.StructArray.from_arrays(columns, names=[n for n, _ in kinds])

        return judge

    return make


def _judged(texts: Texts, model: QualityModel | None) -> dict[str, np.ndarray]:
    s = statistics(texts)
    failed = (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED_PERCENT * s["n_words"])
    score = model.trees.probability(features(s)) if model else np.zeros(len(failed))
    return s | {"score": score, "base_failed": failed, "kept": ~failed & (score >= (model.threshold if model else 0))}


JUDGED = (
    "struct<" + ", ".join(f"{n}: bigint" for n in (*COUNTS, *MORE_COUNTS)) + ", score: double, base_failed: boolean, kept: boolean>"
)


def judged(text: Column, model: QualityModel | None) -> Column:
    """The statistics, score and verdict of each text, as a column ``JUDGED``."""
    return text_udf(_judge(model), JUDGED)(text)


def train_quality(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "quality",
    most: int = LABELLED,
) -> QualityModel:
    """Fit on at most ``most`` labelled documents. The sample's bound lets it be broadcast and collected."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label).cast("int").alias("label")).dropna()
    sample = known.orderBy(F.xxhash64("id"), "label").limit(most)
    own = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = own.join(F.broadcast(sample), "id").select("id", "label", judged(F.col("text"), None).alias("s"))
    rows = found.select("id", "label", "s.*").orderBy(F.xxhash64("id"), *COUNTS, "label").limit(2 * most).toPandas()
    s = {n: rows[n].to_numpy() for n in (*COUNTS, *MORE_COUNTS)}
    return fit_quality(features(s), rows["label"].to_numpy())


def quality(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its id and all of ``JUDGED``."""
    model = train_quality(documents, labels, doc_id, text, **options)
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return own.select("doc_id", judged(F.col("text"), model).alias("s")).select("doc_id", "s.*")


def good_documents(documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are kept, with all their columns."""
    model = train_quality(documents, labels, doc_id, text, **options)
    marked = documents.select(F.struct("*").alias("row"), judged(documents[text], model).alias("s"))
    return marked.filter("s.kept").select("row.*")
