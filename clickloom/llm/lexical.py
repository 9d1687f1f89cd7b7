"""Ranked lexical search: documents scanned by an Aho-Corasick automaton of all item terms.

A term is a run of letters, digits and characters above U+007F, A-Z lower-cased. Every byte
between terms becomes one guard byte, and each term stands in the automaton between two
guards, so what it finds are whole terms; two neighbours share a guard, which overlapping
matches allow. A term's number leads to the items that hold it. No index of the documents is
built: a first scan counts in how many documents each term occurs, a second one counts terms
again and turns the counts into scores at once.

Scores of a part of the documents against all items of a block lie in one array of integers.
A task keeps, for each item, what can still be among its ``k`` best: it never holds more than
a slice of texts, that array and a bounded number of candidates. The best of all tasks are
then ranked in two steps, by (item, part of the documents) and by item, so that no task reads
all candidates of an item, however many tasks there were.

Items reach the tasks in blocks of about ``block_bytes`` of distinct terms, an item in one
block; the driver holds one block at a time, and what a block finds is written below the
shared folder before the next is read.

Defined cases: a null or empty text has no terms, and a document without terms counts
neither as a document nor as a partner; an item without terms has no row. Rows of items with
an equal id are one item with the terms of all of them, a null id being an id. Each row of
documents is a document, so rows with an equal id may rank one after the other; a null id
comes before others. No documents or no items: no rows. Other columns are ignored, whatever
their names. Very long texts are scanned whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickloom.llm.textbytes import ALNUM_WORD, LOWER, Texts, Words, lists_of, slices, text_udf
from clickloom.session import scratch_path

K = 20
BLOCK_BYTES = 4 << 20
#: Scores, and contributions to them, that a task holds at a time.
MOST_SCORES = 1 << 20
#: Candidates after which a task sorts out those that can't be among the best any more.
MOST_CANDIDATES = 1 << 16
#: Parts into which the candidates of one item are dealt before they are ranked as a whole.
PARTS = 64
GUARD = 0x20

_GUARDED = np.where(ALNUM_WORD[LOWER], LOWER, GUARD).astype(np.uint8).tobytes()


def _terms():
    def terms(texts: pa.Array) -> pa.Array:
        values, counts = [], []
        for part in slices(texts):
            words = Words(part, ALNUM_WORD, lower=True)
            values += [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
            counts += words.counts.tolist()
        return lists_of(values, np.array(counts, np.int64), pa.string())

    return terms


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, term, times``: each item's distinct terms and how often they occur in it."""
    own = items.select(F.col(item_id).alias("item"), text_udf(_terms, "array<string>")(F.col(text)).alias("terms"))
    return own.select("item", F.explode("terms").alias("term")).groupBy("item", "term").agg(F.count("*").alias("times"))


@dataclass(frozen=True)
class Block:
    """Items 0 to n_items - 1; term t occurs times[i] times in item[i], i from first[t] to first[t + 1]."""

    terms: list[str]
    first: np.ndarray
    item: np.ndarray
    times: np.ndarray
    n_items: int

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        guard = chr(GUARD)
        for number, term in enumerate(self.terms):
            out.add_word(guard + term.encode().decode("latin-1") + guard, number)
        out.make_automaton()
        return out


def _block(rows: list, items: dict) -> Block:
    rows = sorted((r["term"], items[r["item"]], r["times"]) for r in rows)
    terms, first = [], []
    for at, (term, _, _) in enumerate(rows):
        if not terms or terms[-1] != term:
            terms.append(term)
            first.append(at)
    numbers = np.array([r[1:] for r in rows], np.int64).reshape(-1, 2)
    return Block(terms, np.array([*first, len(rows)], np.int64), numbers[:, 0], numbers[:, 1], len(items))


def _counts(texts: Texts, automaton, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each text; text, term and times of each pair that occurs), pairs in order."""
    sizes = Words(texts, ALNUM_WORD, lower=True).counts
    guarded = texts.data.tobytes().translate(_GUARDED)
    ends, found, starts = [], [], texts.offsets
    for i in np.flatnonzero(sizes).tolist():
        # guards around each text keep terms of neighbours apart
        own = f" {guarded[starts[i] : starts[i + 1]].decode('latin-1')} "
        numbers = [number for _, number in automaton.iter(own)]
        ends.append(len(numbers))
        found += numbers
    text = np.repeat(np.flatnonzero(sizes), np.array(ends, np.int64)) if ends else np.zeros(0, np.int64)
    keys, times = np.unique(text * n_terms + np.array(found, np.int64), return_counts=True)
    return sizes, keys // n_terms, keys % n_terms, times


def _frequencies(block: Block):
    """Of each partition: (term, documents it occurs in); term -1 counts documents, -2 all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, n = block.automaton(), len(block.terms)
        held, documents, length = np.zeros(n, np.int64), 0, 0
        for batch in batches:
            for part in slices(batch.column(0)):
                sizes, _, term, _ = _counts(part, automaton, n)
                held += np.bincount(term, minlength=n)
                documents += int((sizes > 0).sum())
                length += int(sizes.sum())
        some = np.flatnonzero(held)
        values = [pa.array([-1, -2, *some.tolist()], pa.int64()), pa.array([documents, length, *held[some].tolist()], pa.int64())]
        yield pa.RecordBatch.from_arrays(values, ["term", "n"])

    return run


@dataclass(frozen=True)
class Weights:
    """What scores depend on beside the document: counts over all documents and a weight for each term."""

    documents: int
    length: int
    weight: np.ndarray

    def terms(self, size: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """What tf occurrences of a term add to a document of ``size`` terms."""
        m = 75 + (25 * size * self.documents) // self.length
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _scores(block: Block, size, text, term, added) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, scores by text and item) of runs of texts."""
    step = max(1, MOST_SCORES // block.n_items)
    cuts = np.searchsorted(text, np.arange(0, len(size) + step, step))
    for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        n = min(step, len(size) - k * step)
        out = np.zeros(n * block.n_items, np.int64)
        upto = np.cumsum(block.first[term[low:high] + 1] - block.first[term[low:high]])
        while low < high:
            before = upto[-(high - low) - 1] if high - low < len(upto) else 0
            end = low + max(1, int(np.searchsorted(upto[len(upto) - (high - low) :], before + MOST_SCORES, "right")))
            own = term[low:end]
            many = block.first[own + 1] - block.first[own]
            at = np.repeat(block.first[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
            where = np.repeat(text[low:end] - k * step, many) * block.n_items + block.item[at]
            np.add.at(out, where, np.repeat(added[low:end], many) * block.times[at])
            low = end
        yield k * step, out.reshape(n, block.n_items)


class _Best:
    """Candidates of a task: whatever can still be among an item's k best."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows: list[pa.Table] = []
        self.held = 0

    def add(self, ids: pa.Array, scores: np.ndarray) -> None:
        least = self.least
        if len(scores) > self.k:
            least = np.maximum(least, np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k])
        doc, item = np.nonzero(scores >= least)
        if len(doc):
            own = {"item": pa.array(item), "score": pa.array(scores[doc, item]), "doc_id": ids.take(pa.array(doc))}
            self.rows.append(pa.table(own))
            self.held += len(doc)
        if self.held > MOST_CANDIDATES + len(self.least) * self.k:
            self.best()

    def best(self) -> pa.Table | None:
        """The k best of each item; from now on only what reaches them is a candidate."""
        if not self.rows:
            return None
        rows = pa.concat_tables(self.rows)
        order = [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_start"))
        item = rows["item"].to_numpy()
        starts = np.searchsorted(item, np.arange(len(self.least)))
        nth = np.arange(len(item)) - starts[item]
        full = nth == self.k - 1
        self.least[item[full]] = rows["score"].to_numpy()[full]
        rows = rows.filter(pa.array(nth < self.k)).combine_chunks()
        self.rows, self.held = [rows], len(rows)
        return rows


def _ranker(block: Block, weights: Weights, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, n = block.automaton(), len(block.terms)
        best = _Best(block.n_items, k)
        for batch in batches:
            start = 0
            for part in slices(batch.column(0)):
                ids = batch.column(1).slice(start, len(part))
                start += len(part)
                size, text, term, tf = _counts(part, automaton, n)
                added = weights.terms(size[text], term, tf)
                some = added > 0
                for first, scores in _scores(block, size, text[some], term[some], added[some]):
                    best.add(ids.slice(first, len(scores)), scores)
        rows = best.best()
        if rows is not None:
            yield from rows.to_batches()

    return run


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    some = rows.withColumn("nth", F.row_number().over(Window.partitionBy("item_id", part).orderBy(*order))).filter(F.col("nth") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return some.select("item_id", rank.alias("rank"), "doc_id", "score").filter(F.col("rank") <= k)


def search(
    documents: DataFrame,
    items: DataFrame,
    k: int = K,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: ``item_id, rank, doc_id, score``.

    The documents are scanned twice for each block of items when this is called.
    """
    spark = documents.sparkSession
    folder = scratch_path(spark, "search")
    item_terms(items, item_id, item_text).write.parquet(f"{folder}/terms")
    terms = spark.read.parquet(f"{folder}/terms")
    blocks = max(1, -(-(terms.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0) // block_bytes))
    part = F.pmod(F.xxhash64("item"), F.lit(blocks))
    texts = documents.select(F.col(text).cast("string").alias("text"), F.col(doc_id).alias("doc_id"))
    kinds = [documents.select(doc_id).schema[0].dataType, items.select(item_id).schema[0].dataType]
    out = spark.createDataFrame([], f"item_id {kinds[1].simpleString()}, score bigint, doc_id {kinds[0].simpleString()}")
    out.write.parquet(f"{folder}/found")
    for b in range(blocks):
        rows = terms.filter(part == b).collect()
        if not rows:
            continue
        names = {name: i for i, name in enumerate(dict.fromkeys(r["item"] for r in rows))}
        block = _block(rows, names)
        counts = texts.select("text").mapInArrow(_frequencies(block), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        held = {r["term"]: r["n"] for r in counts.collect()}
        if not held.get(-1):
            continue
        weights = _weights(held, len(block.terms))
        ids = pa.array(list(names), to_arrow_type(kinds[1]))
        texts.mapInArrow(_named(_ranker(block, weights, k), ids), out.schema).write.mode("append").parquet(f"{folder}/found")
    return _ranked(spark.read.parquet(f"{folder}/found"), k)


def _named(rank, ids: pa.Array):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rank(batches):
            yield pa.RecordBatch.from_arrays([ids.take(rows.column(0)), rows.column(1), rows.column(2)], ["item_id", "score", "doc_id"])

    return run


def _weights(held: dict, n: int) -> Weights:
    documents, length = held[-1], held[-2]
    df = np.array([held.get(t, 0) for t in range(n)], np.float64)
    return Weights(documents, length, np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64))
