"""Benchmark decontamination by Wu-Manber search over words.

Test strings are windows of ``width`` consecutive words of benchmark items; an item with
fewer words, but not none, is one string. Symbols are words and a block is two of them. A
table gives for each block how far the search may move on without missing a string; where
it may not move, the block's bucket selects test strings, those with another first block
are put aside, and what remains is compared byte by byte. Strings of each length have
tables of their own, so one short item doesn't shorten everyone's steps.

Documents' texts are never shuffled. Test strings are written below the shared folder, in
numbered blocks of about ``block_strings``, and the items that hold a string beside them. The
driver and a task hold one block at a time, whatever the size of the benchmark: a pass over
the documents searches one block, and writes for each document what it found, as numbers of
strings. With more than one block the documents are written first, with a number for each
row, and each block has a pass of its own. Which items it was is then a join of the strings
found, that is of contaminated documents alone.

Defined cases: a null or empty text has no words and no hits, and a very long one is searched
whole; rows with equal ids are searched each on its own; an empty benchmark contaminates
nothing; a null item text has no strings; an item id that occurs on several rows is one item.
Items with a null id are searched and together are one item without a name. Ids may be of any
type and are compared as strings. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.textbytes import ALNUM_WORD, Words, lists_of, mixed, slices, text_udf
from clickloom.session import scratch_path

WIDTH = 10
BLOCK_STRINGS = 100_000
TABLE_BITS = 18
#: Words of a text that one lane of the search walks over.
LANE = 64

FOUND = "struct<n_words: bigint, hits: array<int>, strings: array<int>>"
_FOUND = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("strings", pa.list_(pa.int32()))])


def _windows_of(width: int):
    def make():
        def windows(texts: pa.Array) -> pa.Array:
            values, counts = [], []
            for part in slices(texts):
                words = Words(part, ALNUM_WORD, lower=True)
                for a, b in zip(words.first[:-1], words.first[1:]):
                    ends = range(min(a + width, b), b + 1) if b > a else ()
                    own = {words.bytes(max(a, end - width), end).decode() for end in ends}
                    values.extend(sorted(own))
                    counts.append(len(own))
            return lists_of(values, np.array(counts, np.int64), pa.string())

        return windows

    return make


def test_strings(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``string, item``: each test string with each item that holds it."""
    split = text_udf(_windows_of(width), "array<string>")
    rows = items.select(F.col(item_id).cast("string").alias("item"), split(F.col(text)).alias("strings"))
    return rows.select(F.explode("strings").alias("string"), "item").distinct()


class Benchmark:
    """Test strings below the shared folder: ``block, nth, string``, and the items of each, ``block, nth, item``."""

    def __init__(self, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WIDTH, block_strings: int = BLOCK_STRINGS):
        self.spark = spark = items.sparkSession
        folder = scratch_path(spark, "benchmark")
        test_strings(items, item_id, text, width).write.parquet(f"{folder}/pairs")
        pairs = spark.read.parquet(f"{folder}/pairs")
        distinct = pairs.select("string").distinct()
        self.blocks = max(1, -(-distinct.count() // block_strings))
        block = F.pmod(F.xxhash64("string"), F.lit(self.blocks)).cast("int")
        nth = F.row_number().over(Window.partitionBy("block").orderBy("string")) - 1
        distinct.withColumn("block", block).withColumn("nth", nth).write.parquet(f"{folder}/strings")
        self.strings = spark.read.parquet(f"{folder}/strings")
        self.members = pairs.join(self.strings, "string").select("block", "nth", "item")

    def search(self, text: Column, block: int) -> Column:
        """What a block's strings hit in each text, as a column ``FOUND``.

        ``hits`` holds the start and end of each run of hit words, in order. The block is read when this is called.
        """
        rows = self.strings.filter(F.col("block") == block).orderBy("nth").collect()
        return text_udf(_searcher([r["string"] for r in rows]), FOUND)(text)


class Patterns:
    """Wu-Manber tables of test strings of one length in words."""

    def __init__(self, strings: list[bytes], numbers: np.ndarray):
        self.size = strings[0].count(b" ") + 1
        self.block = min(2, self.size)
        data = np.frombuffer(b"\n".join(strings), np.uint8)
        ends = np.cumsum([len(s) + 1 for s in strings])
        words = Words(_Lines(data, np.concatenate([[0], ends - 1])), ALNUM_WORD, lower=False)
        hashes = words.hashes.reshape(len(strings), self.size)
        self.shift = np.full(1 << TABLE_BITS, self.size - self.block + 1, np.int32)
        for end in range(self.block - 1, self.size):
            slots = self._slots(hashes[:, end - self.block + 1], hashes[:, end])
            np.minimum.at(self.shift, slots, self.size - 1 - end)
        order = np.argsort(slots, kind="stable")
        self.bucket = np.searchsorted(slots[order], np.arange((1 << TABLE_BITS) + 1))
        self.strings = [strings[i] for i in order]
        self.numbers = numbers[order]
        self.prefix = self._pairs(hashes[:, 0], hashes[:, self.block - 1])[order]

    def _pairs(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mixed(first * np.uint64(3) + last) if self.block == 2 else last

    def _slots(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return (self._pairs(first, last) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, words: Words) -> Iterator[tuple[int, int]]:
        """(first word, test string) of every occurrence."""
        hashes, m, back = words.hashes, self.size, self.block - 1
        low, high = words.first[:-1] + m - 1, words.first[1:]  # where a test string may end
        lanes = np.maximum(0, -(-(high - low) // LANE))
        text = np.repeat(np.arange(len(lanes)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = low[text] + nth * LANE
        until = np.minimum(at + LANE, high[text])
        while len(at):
            slots = self._slots(hashes[at - back], hashes[at])
            step = self.shift[slots]
            stop = step == 0
            if stop.any():
                yield from self._confirm(words, at[stop] - m + 1, slots[stop])
            at = at + np.maximum(step, 1)
            going = at < until
            at, until = at[going], until[going]

    def _confirm(self, words: Words, begins: np.ndarray, slots: np.ndarray) -> Iterator[tuple[int, int]]:
        first, count = self.bucket[slots], self.bucket[slots + 1] - self.bucket[slots]
        begins = np.repeat(begins, count)
        rank = np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(begins))
        hashes = words.hashes
        same = self.prefix[rank] == self._pairs(hashes[begins], hashes[begins + self.block - 1])
        for begin, i in zip(begins[same].tolist(), rank[same].tolist()):
            if words.bytes(begin, begin + self.size) == self.strings[i]:
                yield begin, self.numbers[i]


class _Lines:
    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _searcher(strings: list[str]):
    def make():
        groups: dict[int, list[int]] = {}
        raw = [s.encode() for s in strings]
        for i, s in enumerate(raw):
            groups.setdefault(s.count(b" ") + 1, []).append(i)
        tables = [Patterns([raw[i] for i in of], np.array(of)) for of in groups.values()]

        def search(texts: pa.Array) -> pa.Array:
            counts, hits, found = [], [], []
            for part in slices(texts):
                words = Words(part, ALNUM_WORD, lower=True)
                own: dict[int, tuple[list, set]] = {}
                for table in tables:
                    for begin, i in table.search(words):
                        text = int(np.searchsorted(words.first, begin, "right")) - 1
                        spans, strings_in = own.setdefault(text, ([], set()))
                        at = begin - int(words.first[text])
                        spans.append((at, at + table.size))
                        strings_in.add(i)
                counts.extend(words.counts.tolist())
                for text in range(len(part)):
                    spans, strings_in = own.get(text, ((), ()))
                    hits.append(_merged(spans))
                    found.append(sorted(strings_in))
            columns = [pa.array(counts, pa.int64()), pa.array(hits, _FOUND[1].type), pa.array(found, _FOUND[2].type)]
            return pa.StructArray.from_arrays(columns, names=["n_words", "hits", "strings"])

        return search

    return make


def _union(texts: pa.Array) -> pa.Array:
    """Runs of several blocks, one list after another, as runs that don't meet."""
    return pa.array([_merged(list(zip(x[::2], x[1::2]))) for x in texts.to_pylist()], pa.list_(pa.int32()))


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_strings: int = BLOCK_STRINGS,
) -> DataFrame:
    """One row per document: its id, ``n_words``, the ``hits``, the ``items`` found in it, and whether items without a name were."""
    spark = documents.sparkSession
    wanted = Benchmark(benchmark, item_id, item_text, width, block_strings)
    folder = scratch_path(spark, "contamination")
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    if wanted.blocks > 1:
        own.write.parquet(f"{folder}/documents")
        own = spark.read.parquet(f"{folder}/documents")
    for block in range(wanted.blocks):
        found = own.select("row", "doc_id", F.lit(block).alias("block"), wanted.search(F.col("text"), block).alias("found"))
        found.select("row", "doc_id", "block", "found.*").write.mode("append").parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")
    strings = found.select("row", "block", F.explode("strings").alias("nth")).join(wanted.members, ["block", "nth"])
    items = strings.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"), F.bool_or(F.col("item").isNull()).alias("unnamed"))
    if wanted.blocks > 1:
        found = _gathered(found)
    rows = found.select("row", "doc_id", "n_words", "hits").join(items, "row", "left")
    none = F.array().cast("array<string>")
    return rows.select("doc_id", "n_words", "hits", F.coalesce("items", none).alias("items"), F.coalesce("unnamed", F.lit(False)).alias("unnamed"))


def _gathered(found: DataFrame) -> DataFrame:
    """What all blocks hit in each row."""
    lists = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits")
    )
    return lists.withColumn("hits", F.arrow_udf(_union, "array<int>")("hits"))


def without_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_strings: int = BLOCK_STRINGS,
) -> DataFrame:
    """The documents, all their columns kept, in which no test string occurs."""
    wanted = Benchmark(benchmark, item_id, item_text, width, block_strings)
    rows = documents.select(F.struct("*").alias("row"), documents[text].alias("text"))
    for block in range(wanted.blocks):
        if block:  # what one block left is written before the next is read
            path = scratch_path(wanted.spark, "clean")
            rows.write.parquet(path)
            rows = wanted.spark.read.parquet(path)
        found = rows.select("row", "text", wanted.search(F.col("text"), block).alias("found"))
        rows = found.filter(F.size("found.hits") == 0).select("row", "text")
    return rows.select("row.*")
