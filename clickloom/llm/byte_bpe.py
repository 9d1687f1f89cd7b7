"""Byte-level BPE with a segment tree over byte positions.

The leaf of a position holds rank * size + position of the pair that begins there, or a
number above all others; the root of the minima is then the leftmost pair of the lowest
rank. A merge touches three leaves, of the merged pair, of what it swallowed and of the live
neighbour before, and the nodes above them. Pieces of up to ``WIDE`` bytes are merged many
at a time, each a row of one array of trees; a longer piece has a tree of its own.

Pieces are the matches of the split pattern, each encoded separately, without special
tokens. What a letter or number is, is asked of the tokenizer library when the job is planned
and travels with the tasks, so it follows neither the version of the package that matches the
pattern nor what is installed on executors: a character that the package takes for something
else is replaced, for matching alone, by one that both take for what the library does. Within
a task, the ids of pieces seen before are remembered (``REMEMBERED`` pieces at most, then it
starts over); what is remembered changes nothing but time.

Defined cases: a null or empty text has no ids and decodes to nothing; rows with equal ids
are encoded each on its own; ids come as little-endian unsigned 32-bit integers; decoding
null gives no bytes, and an id outside the vocabulary raises an error. Other columns stay,
whatever their names.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.textbytes import text_udf

WIDE = 64
REMEMBERED = 200_000
TOGETHER = 1 << 20
NONE = np.int64(1) << 62

_CLASS = re.compile(r"\\p\{(\w+)\}")

#: Fixed value: the characters with Unicode's White_Space property, which \s stands for.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern with \\s and \\S read as the White_Space property."""
    inside = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}")
    return regex.compile(inside.replace(r"\s", f"[{WHITE_SPACE}]").replace(r"\S", f"[^{WHITE_SPACE}]"))


Classes = tuple[tuple[str, tuple[tuple[int, int], ...]], ...]


def _every() -> str:
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


@lru_cache(maxsize=8)
def library_classes(pattern: str) -> Classes:
    """The ranges of code points that the tokenizer library takes for each class ``\\p{...}`` of a pattern."""
    bytes_alone = {bytes([b]): b for b in range(256)}
    out = []
    for name in sorted(set(_CLASS.findall(pattern))):
        probe = tiktoken.Encoding("probe", pat_str=rf"\p{{{name}}}", mergeable_ranks=bytes_alone, special_tokens={})
        points = np.frombuffer(bytes(probe.encode_ordinary(_every())).decode().encode("utf-32-le"), "<u4").astype(np.int64)
        first = np.flatnonzero(np.diff(points, prepend=-2) > 1)
        last = np.append(first[1:], len(points)) - 1
        out.append((name, tuple(zip(points[first].tolist(), points[last].tolist()))))
    return tuple(out)


class Splitter:
    """Splits text by a pattern whose classes hold what ``classes`` says."""

    def __init__(self, pattern: str, classes: Classes):
        own = split_pattern(pattern)
        self.find, self.finditer = own.findall, own.finditer
        every = _every()
        theirs = np.zeros((len(classes), 0x110000), bool)
        ours = np.zeros_like(theirs)
        for k, (name, ranges) in enumerate(classes):
            for low, high in ranges:
                theirs[k, low : high + 1] = True
            ours[k, list(map(ord, regex.findall(rf"\p{{{name}}}", every)))] = True
        odd = (theirs != ours).any(axis=0)
        places = 1 << np.arange(len(classes))
        kinds = (theirs * places[:, None]).sum(axis=0)
        plain = ~odd
        plain[[*range(0xA1), *range(0xD800, 0xE000), *map(ord, regex.findall(f"[{WHITE_SPACE}]", every))]] = False
        instead = {int(k): int(np.flatnonzero(plain & (kinds == k))[0]) for k in np.unique(kinds[odd])}
        self.table = {int(c): instead[int(kinds[c])] for c in np.flatnonzero(odd)}
        # a first glance at the range that odd characters lie in passes most texts
        self.glance = re.compile(f"[{chr(min(self.table))}-{chr(max(self.table))}]").search if self.table else lambda text: None

    def pieces(self, text: str) -> list[str]:
        if self.glance(text) is None:
            return self.find(text)
        return [text[slice(*m.span())] for m in self.finditer(text.translate(self.table))]


class Vocabulary:
    """Ranks of byte strings (``base64 rank`` lines), and the rank of each pair of ranks that merges."""

    @staticmethod
    def ranks_of(lines: bytes) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}

    def __init__(self, lines: bytes):
        self.ranks = ranks = self.ranks_of(lines)
        self.bytes = dict(zip(ranks.values(), ranks))
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(rank)
        order = np.argsort(keys)
        self.pairs = np.append(np.array(keys, np.int64)[order], NONE)
        self.merged = np.append(np.array(merged, np.int64)[order], -1)
        self._of_pair: dict[int, int] | None = None

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where there is none; b may be -1."""
        key = (a << np.int64(32)) | np.maximum(b, 0)
        at = np.searchsorted(self.pairs, key)
        return np.where((self.pairs[at] == key) & (b >= 0), self.merged[at], -1)

    @property
    def of_pair(self) -> dict[int, int]:
        if self._of_pair is None:
            self._of_pair = dict(zip(self.pairs[:-1].tolist(), self.merged[:-1].tolist()))
        return self._of_pair


def merge_many(vocabulary: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """The ids of pieces of 2 to ``WIDE`` bytes, packed."""
    out: list[bytes] = [b""] * len(pieces)
    lengths = np.array([len(p) for p in pieces])
    size = 2
    while size <= WIDE:
        own = np.flatnonzero((lengths <= size) & (lengths > size // 2))
        if len(own):
            for i, ids in zip(own.tolist(), _merge_rows(vocabulary, [pieces[i] for i in own], size)):
                out[i] = ids
        size *= 2
    return out


def _merge_rows(vocabulary: Vocabulary, pieces: list[bytes], size: int) -> list[bytes]:
    n = len(pieces)
    data = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
    lengths = np.array([len(p) for p in pieces])
    live = np.arange(size) < lengths[:, None]
    ids = np.full((n, size + 1), -1, np.int64)  # the last column stands for "no token"
    ids[:, :size] = np.where(live, vocabulary.of_byte[data], -1)
    after = np.broadcast_to(np.arange(1, size + 2), (n, size + 1)).copy()
    after[np.arange(n), lengths - 1] = size
    before = np.broadcast_to(np.arange(-1, size), (n, size + 1)).copy()
    before[:, 0] = size
    tree = np.full((n, 2 * size), NONE)
    rank = vocabulary.merge(np.maximum(ids[:, :-1], 0), ids[:, 1:])
    tree[:, size:] = np.where((rank >= 0) & live, rank * size + np.arange(size), NONE)
    width = size
    while width > 1:
        half = width // 2
        tree[:, half:width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
        width = half
    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        token, at = np.divmod(tree[rows, 1], size)
        gone = after[rows, at]
        far = after[rows, gone]
        near = before[rows, at]
        ids[rows, at], ids[rows, gone] = token, -1
        after[rows, at] = far
        before[rows, far] = np.where(far < size, at, before[rows, far])
        right = vocabulary.merge(token, ids[rows, far])
        left = vocabulary.merge(np.maximum(ids[rows, near], 0), token)
        tree[rows, size + at] = np.where(right >= 0, right * size + at, NONE)
        tree[rows, size + gone] = NONE
        has = near < size
        behind, place = rows[has], near[has]
        tree[behind, size + place] = np.where(left[has] >= 0, left[has] * size + place, NONE)
        for at_rows, node in ((rows, size + at), (rows, size + gone), (behind, size + place)):
            while node[0:1].size and node[0] > 1:
                node = node >> 1
                tree[at_rows, node] = np.minimum(tree[at_rows, 2 * node], tree[at_rows, 2 * node + 1])
        rows = rows[tree[rows, 1] < NONE]
    ids = ids[:, :size]
    kept = ids >= 0
    packed = ids[kept].astype("<u4").tobytes()
    ends = np.cumsum(kept.sum(axis=1)) * 4
    return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def merge_long(vocabulary: Vocabulary, piece: bytes) -> bytes:
    """The ids of one piece of any length, packed."""
    n, none, of_pair = len(piece), int(NONE), vocabulary.of_pair
    size = 1 << max(1, (n - 1).bit_length())
    ids = vocabulary.of_byte[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [none] * (2 * size)
    for i in range(n - 1):
        rank = of_pair.get(ids[i] << 32 | ids[i + 1])
        if rank is not None:
            tree[size + i] = rank * size + i
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, rank: int | None) -> None:
        node = size + i
        tree[node] = none if rank is None else rank * size + i
        node >>= 1
        while node:
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low
            node >>= 1

    while tree[1] < none:
        token, at = divmod(tree[1], size)
        gone = after[at]
        far, near = after[gone], before[at]
        ids[at], ids[gone], after[at] = token, -1, far
        put(gone, None)
        if far < n:
            before[far] = at
        put(at, of_pair.get(token << 32 | ids[far]) if far < n else None)
        if near >= 0:
            put(near, of_pair.get(ids[near] << 32 | token))
    return np.array([i for i in ids if i >= 0], "<u4").tobytes()


class Encoder:
    def __init__(self, lines: bytes, pattern: str, classes: Classes):
        self.vocabulary = Vocabulary(lines)
        self.pieces = Splitter(pattern, classes).pieces
        self.whole = {k: np.uint32(v).tobytes() for k, v in self.vocabulary.ranks.items()}
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text. New pieces of about ``TOGETHER`` characters are merged in one go."""
        out: list[bytes] = []
        waiting: list[list[str]] = []
        chars = 0
        for k, text in enumerate(texts):
            waiting.append(self.pieces(text) if text else [])
            chars += len(text or "")
            if chars >= TOGETHER or k == len(texts) - 1:
                if len(self.known) > REMEMBERED:
                    self.known = {}
                self._learn(set().union(*waiting).difference(self.known))
                out.extend(b"".join(map(self.known.__getitem__, pieces)) for pieces in waiting)
                waiting, chars = [], 0
        return out

    def _learn(self, pieces: set[str]) -> None:
        short: list[tuple[str, bytes]] = []
        for piece in pieces:
            raw = piece.encode()
            whole = self.whole.get(raw)
            if whole is not None:
                self.known[piece] = whole
            elif len(raw) <= WIDE:
                short.append((piece, raw))
            else:
                self.known[piece] = merge_long(self.vocabulary, raw)
        if short:
            self.known.update(zip((p for p, _ in short), merge_many(self.vocabulary, [raw for _, raw in short])))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoder(lines: bytes, pattern: str, classes: Classes) -> Encoder:
    return Encoder(lines, pattern, classes)


def _encoded(lines: bytes, pattern: str, classes: Classes):
    def make():
        own = encoder(lines, pattern, classes)
        return lambda texts: pa.array(own.encode(texts.to_pylist()), pa.binary())

    return make


def _decoded(lines: bytes, pattern: str, classes: Classes):
    def make():
        own = encoder(lines, pattern, classes)
        return lambda ids: pa.array([own.decode(x or b"") for x in ids.to_pylist()], pa.binary())

    return make


def read_ranks(path: str) -> bytes:
    """A rank file. It is read on the driver and travels with the tasks: a vocabulary's size is bounded."""
    with open(path, "rb") as file:
        return file.read()


def encode(text: Column, ranks: bytes, pattern: str) -> Column:
    """The ids of each text, packed as little-endian unsigned 32-bit integers."""
    return text_udf(_encoded(ranks, pattern, library_classes(pattern)), "binary")(text)


def decode(ids: Column, ranks: bytes, pattern: str) -> Column:
    """The bytes that packed ids stand for."""
    return text_udf(_decoded(ranks, pattern, library_classes(pattern)), "binary")(ids)


def _both(lines: bytes, pattern: str, classes: Classes):
    def make():
        own = encoder(lines, pattern, classes)

        def both(texts: pa.Array) -> pa.Array:
            ids = own.encode(texts.to_pylist())
            columns = [pa.array(ids, pa.binary()), pa.array([own.decode(x) for x in ids], pa.binary())]
            return pa.StructArray.from_arrays(columns, names=["ids", "decoded"])

        return both

    return make


def round_trip(documents: DataFrame, ranks: bytes, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, its packed ``ids`` and the bytes ``decoded`` from them."""
    both = text_udf(_both(ranks, pattern, library_classes(pattern)), "struct<ids: binary, decoded: binary>")
    own = documents.select(F.col(doc_id).alias("doc_id"), both(F.col(text)).alias("r"))
    return own.select("doc_id", "r.ids", "r.decoded")
