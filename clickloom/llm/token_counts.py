"""Token counts by a tokenizer file, with overlap resynchronisation for huge texts.

Texts of up to ``CHUNK`` characters are encoded whole, many in a call. A longer one is encoded
in chunks that overlap, with offsets. Two neighbours are joined at a stable common boundary:
a place in the overlap where the split pattern of byte-level tokenizers begins a piece whatever
comes before, with no token of either chunk across it and the same tokens about it in both.
What the left chunk has before it and the right chunk after it are then the tokens of the whole
text. Stable are places before a space that follows no white space and precedes a letter, and
places between letters, digits and punctuation, as a piece holds one of these kinds alone;
the one exception, an apostrophe before a letter, is not taken. The pattern finds such a place
before anything is encoded. An overlap reaches a little further back than the last one, and is
doubled where the chunks don't agree about it; where there is none, the left chunk is doubled.
A text is therefore encoded a bounded number of times, whatever it consists of.

The proof asks for a byte-level tokenizer without normaliser whose added tokens hold no
space and take none from their neighbours. Files of another kind encode every text whole.

Defined cases: a null or empty text has no bytes and no tokens. Rows with equal ids are
counted each on its own, very long texts whole; other columns stay, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textbytes import slices, text_udf

CHUNK = 1 << 16
OVERLAP = 1 << 9
#: Tokens on either side of a boundary that both chunks must agree on.
AGREE = 4

_MARKS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~、。，！？；：（）《》「」")
_STABLE = re.compile(
    rf"(?<=\S)(?= [^\W\d_])|(?<=[{_MARKS}])(?=[^\W_])|(?<=[A-Za-z\u00c0-\u024f])(?=[0-9'{_MARKS}])|(?<=[0-9])(?=[A-Za-z'{_MARKS}])"
    rf"|(?<=[\u4e00-\u9fff])(?=[{_MARKS}])"
)


class Counter:
    def __init__(self, file: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        parts = json.loads(file)
        added = parts.get("added_tokens") or []
        plain = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"]) for t in added)
        splitter = parts.get("pre_tokenizer") or {}
        byte_level = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        self.stable = plain and byte_level and not parts.get("normalizer")
        #: Chunks encoded and overlaps doubled, for tests.
        self.encoded = self.widened = 0

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        whole = [i for i, t in enumerate(texts) if len(t) <= self.chunk or not self.stable]
        done = self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)
        for i, encoding in zip(whole, done):
            out[i] = len(encoding)
        for i, t in enumerate(texts):
            if len(t) > self.chunk and self.stable:
                out[i] = self._long(t)
        return out

    def _encode(self, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.encoded += 1
        encoding = self.tokenizer.encode(text[start:end], add_special_tokens=False)
        offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2) + start
        return np.array(encoding.ids, np.int64), offsets[:, 0], offsets[:, 1]

    def _long(self, text: str) -> int:
        total, since, start, end = 0, 0, 0, min(self.chunk, len(text))
        left = None
        while end < len(text):
            last = self._last_place(text, since, end)
            joined = None
            if last is not None:
                left = left or self._encode(text, start, end)
                joined = self._joined(text, left, since, last, end)
            if joined is None:  # no place to join: a chunk of twice the length
                end, left = min(start + 2 * (end - start), len(text)), None
                continue
            place, begin, until, right = joined
            total += _before(left, place) - _before(left, since)
            since, start, end, left = place, begin, until, right
        left = left or self._encode(text, start, end)
        return total + len(left[0]) - _before(left, since)

    def _joined(self, text: str, left, since: int, last: int, end: int):
        """(place, begin, end, chunk) of a right chunk that agrees with the left one about a place; None if none does."""
        back = self.overlap // 2
        while last - back > since:
            begin = last - back
            until = min(max(end + self.chunk // 2, begin + self.chunk), len(text))
            right = self._encode(text, begin, until)
            place = self._common(text, left, right, begin, end)
            if place is not None:
                return place, begin, until, right
            self.widened += 1
            back *= 2
        return None

    def _last_place(self, text: str, since: int, end: int) -> int | None:
        """The last stable place before ``end`` that leaves room for an overlap behind ``since``."""
        low, back = end, self.overlap
        while low > since + 1:
            low, high = max(since + 1, end - back), low
            found = [m.start() for m in _STABLE.finditer(text, low, min(high + 2, end - 1))]
            if found:
                return found[-1]
            back *= 2
        return None

    def _common(self, text: str, left, right, begin: int, end: int) -> int | None:
        places = [m.start() for m in _STABLE.finditer(text, begin + 1, end - 1)]
        middle = (begin + end) // 2
        for place in sorted(places, key=lambda p: abs(p - middle)):
            a, b = _before(left, place), _before(right, place)
            clean = all(np.searchsorted(x[2], place, "right") == n for x, n in ((left, a), (right, b)))
            back, ahead = min(AGREE, a, b), min(AGREE, len(left[0]) - a, len(right[0]) - b)
            same = (left[0][a - back : a] == right[0][b - back : b]).all()
            if clean and same and (left[0][a : a + ahead - 1] == right[0][b : b + ahead - 1]).all():
                return place
        return None


def _before(chunk, place: int) -> int:
    return int(np.searchsorted(chunk[1], place, "left"))


@lru_cache(maxsize=2)
def counter(file: str) -> Counter:
    return Counter(file)


def _counted(file: str):
    def make():
        own = counter(file)

        def counted(texts: pa.Array) -> pa.Array:
            n_bytes, n_tokens = [], []
            for part in slices(texts):
                n_bytes.extend(np.diff(part.offsets).tolist())
                n_tokens.extend(own.counts([part.text(i) for i in range(len(part))]))
            columns = [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            return pa.StructArray.from_arrays(columns, names=["n_bytes", "n_tokens"])

        return counted

    return make


def read_tokenizer(path: str) -> str:
    """A tokenizer file. It is read on the driver and travels with the tasks: a vocabulary's size is bounded."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def counted(text: Column, tokenizer: str) -> Column:
    """``n_bytes`` and ``n_tokens`` of each text."""
    return text_udf(_counted(tokenizer), "struct<n_bytes: bigint, n_tokens: bigint>")(text)


def token_counts(documents: DataFrame, tokenizer: str, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_bytes``, ``n_tokens`` and whether they are over the limit."""
    own = documents.select(F.col(doc_id).alias("doc_id"), counted(F.col(text), tokenizer).alias("n"))
    return own.select("doc_id", "n.n_bytes", "n.n_tokens", (F.col("n.n_tokens") > limit).alias("over_limit"))
