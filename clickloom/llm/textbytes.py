"""Words of UTF-8 text as arrays, and whole-text functions as Arrow UDFs.

A batch of texts is read as one run of bytes with a list of offsets; where words start and
end, and what they hash to, is then computed for all texts of a slice at once. Slices keep
the arrays small; a text longer than a slice is a slice of its own, so no text is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ and, as bytes above 0x7F belong to words, of UTF-8.
ALNUM_WORD = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes of words [^\x20\x09-\x0D]+.
SPACED_WORD = ~byte_set((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Texts:
    """Texts of one slice: ``data`` holds their bytes, text i being data[offsets[i]:offsets[i+1]]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> str:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().decode()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts (null: empty) in order, about ``most`` bytes at a time."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        own = offsets[start : end + 1]
        yield Texts(data[own[0] : own[-1]], own - own[0])
        start = end


class Words:
    """Runs of word bytes: word w is data[starts[w]:ends[w]]; those of text i are first[i] to first[i+1]."""

    def __init__(self, texts: Texts, members: np.ndarray, lower: bool):
        data = LOWER[texts.data] if lower else texts.data
        inside = members[data]
        opens, closes = inside.copy(), inside.copy()
        if len(data):
            opens[1:] &= ~inside[:-1]
            closes[:-1] &= ~inside[1:]
            edges = texts.offsets[1:-1]
            edges = edges[(edges > 0) & (edges < len(data))]
            opens[edges] = inside[edges]
            closes[edges - 1] = inside[edges - 1]
        self.data = data
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, texts.offsets)
        self._hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.data, self.starts, self.ends)
        return self._hashes

    def bytes(self, start: int, end: int) -> bytes:
        """Words start to end, one space between."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[start:end], self.ends[start:end]))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n + 1:
        for k, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end], for each pair: a polynomial whose prefix sums are shared."""
    up, down = _powers_to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n word hashes; those that cross texts are the caller's to leave out."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = out * _P + words[k : len(words) - n + 1 + k]
    return mixed(out)


#: Bytes of the first column that a function of a batch gets at a time.
CALL_BYTES = 1 << 22


def _cuts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of rows of about ``CALL_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(sizes)
    start = 0
    while start < len(column):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + CALL_BYTES, "right")))
        yield start, end - start
        start = end


def text_udf(make: Callable[[], Callable[..., pa.Array]], schema: str) -> Callable[..., Column]:
    """A column function of whole columns in Arrow form, the first of text or bytes.

    ``make`` runs once in each task and returns the function of some rows, so that tables are
    built once. Spark's batches are bounded in rows, not in bytes, so they are passed on in
    parts. Spark keeps the other columns of the row to itself, whatever their names.
    """

    def run(batches):
        function = make()
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            if not len(columns[0]):
                yield function(*columns)
            for start, length in _cuts(columns[0]):
                yield function(*(c.slice(start, length) for c in columns))

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(batches)

    def many(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        yield from run(batches)

    def apply(*columns: Column) -> Column:
        udf = F.arrow_udf(one if len(columns) == 1 else many, schema).asNondeterministic()
        return udf(*columns)

    return apply


def lists_of(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
