"""Token ids packed into rows of equal length by best-fit decreasing.

Each task packs the documents it reads, about ``WINDOW`` tokens at a time, so nothing is
shuffled and memory is bounded whatever the input. Texts longer than a row are split into
full rows and a rest, without loss. Pieces go from the longest to the shortest into the
row with the least room that still takes them; a segment tree over the capacities 0..length
finds it. Rows of a window that stay open are padded.

Each packed row has the ids (little-endian, ``id_bytes`` wide, padded), the cumulative
segment lengths, the positions, which start anew at every segment, and for each segment its
document and where in the document's ids it begins.

The query writes the packed rows below the shared folder and reads them from there.

Defined cases: null and empty ids make no segment. Rows with equal ids are packed each on
its own. Which documents share a row follows from how the input is dealt to tasks; a task
that runs again packs the same rows again. An id too large for ``id_bytes`` raises an error.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clickloom.llm.byte_bpe import Vocabulary
from clickloom.llm.textbytes import slices, text_udf

LENGTH = 2048
WINDOW = 1 << 21


class Capacities:
    """Open rows by the room they have left; ``take`` finds the least room that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.open: list[list[int]] = [[] for _ in range(most + 1)]
        self.count = [0] * (2 * self.size)

    def put(self, room: int, row: int) -> None:
        self.open[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row with room for ``least``; it is no longer open."""
        count, node = self.count, self.size + least
        while not count[node]:
            while node & 1:  # a right child: what is left of the level lies further up
                node >>= 1
            if not node:
                return None
            node += 1  # the right sibling holds the next larger rooms
        while node < self.size:
            node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.open[room].pop()

    def _add(self, room: int, change: int) -> None:
        node = self.size + room
        while node:
            self.count[node] += change
            node >>= 1


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Rows of pieces, by number, from the longest piece to the shortest; equal ones in order."""
    rows: list[list[int]] = []
    rooms = Capacities(most)
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[piece])
        room, row = found if found else (most, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        rooms.put(room - lengths[piece], row)
    return rows


def _packed(pieces: list[tuple[object, int, np.ndarray]], length: int, kind: str, pad: int) -> Iterator[dict]:
    for row in best_fit([len(p[2]) for p in pieces], length):
        own = [pieces[i] for i in row]
        lengths = [len(p[2]) for p in own]
        ids = np.full(length, pad, kind)
        ids[: sum(lengths)] = np.concatenate([p[2] for p in own])
        positions = np.zeros(length, "<u4")
        positions[: sum(lengths)] = np.concatenate([np.arange(n) for n in lengths])
        yield {
            "ids": ids.tobytes(),
            "positions": positions.tobytes(),
            "cu_seqlens": np.concatenate([[0], np.cumsum(lengths)]).tolist(),
            "doc_ids": [p[0] for p in own],
            "doc_offsets": [p[1] for p in own],
        }


def _packer(schema: pa.Schema, length: int, window: int, id_bytes: int, end_id: int | None, pad: int):
    kind = f"<u{id_bytes}"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list = []
        waiting = 0
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(raw.as_py() or b"", "<u4")
                if not len(ids):
                    continue
                if end_id is not None:
                    ids = np.append(ids, np.uint32(end_id))
                if int(ids.max()) >= 1 << (8 * id_bytes):
                    raise ValueError(f"token id {int(ids.max())} needs more than {id_bytes} bytes")
                for at in range(0, len(ids), length):
                    pieces.append((doc, at, ids[at : at + length].astype(kind)))
                    waiting += len(pieces[-1][2])
                    if waiting >= window:
                        yield pa.RecordBatch.from_pylist(list(_packed(pieces, length, kind, pad)), schema)
                        pieces, waiting = [], 0
        if pieces:
            yield pa.RecordBatch.from_pylist(list(_packed(pieces, length, kind, pad)), schema)

    return pack


def pack(
    tokens: DataFrame,
    doc_id: str = "doc_id",
    ids: str = "ids",
    length: int = LENGTH,
    window: int = WINDOW,
    id_bytes: int = 2,
    end_id: int | None = None,
    pad: int = 0,
) -> DataFrame:
    """Packed rows of documents whose ids are packed as little-endian unsigned 32-bit integers."""
    own = tokens.select(F.col(doc_id).alias("doc"), F.col(ids).cast("binary").alias("ids"))
    kind = own.schema["doc"].dataType
    fields = "ids binary, positions binary, cu_seqlens array<int>, doc_ids array<{}>, doc_offsets array<bigint>"
    arrow = pa.schema(
        [
            ("ids", pa.binary()),
            ("positions", pa.binary()),
            ("cu_seqlens", pa.list_(pa.int32())),
            ("doc_ids", pa.list_(to_arrow_type(kind))),
            ("doc_offsets", pa.list_(pa.int64())),
        ]
    )
    packer = _packer(arrow, length, window, id_bytes, end_id, pad)
    return own.mapInArrow(packer, fields.format(kind.simpleString()))


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: a file's ``ids``, one after another, are a matrix of equal rows.

    Positions rise by one within a segment, which the files' compression makes little of.
    """
    packed.write.mode("error").option("compression", "zstd").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``write_packed`` wrote."""
    return spark.read.parquet(path)


def unpacked(packed: DataFrame, id_bytes: int = 2) -> DataFrame:
    """The segments of packed rows: ``doc_id, doc_offset, ids``, ids as little-endian unsigned integers of ``id_bytes``.

    A document's segments, in the order of their offsets, are all of its ids.
    """
    pieces = F.posexplode(F.arrays_zip("doc_ids", "doc_offsets")).alias("nth", "piece")
    rows = packed.select("ids", "cu_seqlens", pieces)
    start, end = F.get("cu_seqlens", F.col("nth")), F.get("cu_seqlens", F.col("nth") + 1)
    cut = F.substring(F.col("ids"), start * id_bytes + 1, (end - start) * id_bytes)
    return rows.select(F.col("piece.doc_ids").alias("doc_id"), F.col("piece.doc_offsets").alias("doc_offset"), cut.alias("ids"))


def read_matrix(rows: list, column: str = "ids", id_bytes: int = 2) -> np.ndarray:
    """The matrix of some collected rows."""
    return np.stack([np.frombuffer(r[column], f"<u{id_bytes}") for r in rows])


_LIBRARY: dict[tuple[bytes, str], tiktoken.Encoding] = {}


def _library_ids(ranks: bytes, pattern: str):
    def make():
        if (ranks, pattern) not in _LIBRARY:
            _LIBRARY.clear()
            own = Vocabulary.ranks_of(ranks)
            _LIBRARY[ranks, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own, special_tokens={})
        encoding = _LIBRARY[ranks, pattern]

        def encoded(texts: pa.Array) -> pa.Array:
            out = []
            for part in slices(texts):
                for i in range(len(part)):
                    ids = encoding.encode_to_numpy(part.text(i), disallowed_special=())
                    out.append(ids.astype("<u4", copy=False).tobytes())
            return pa.array(out, pa.binary())

        return encoded

    return make


def library_ids(text: Column, ranks: bytes, pattern: str) -> Column:
    """The ids that the tokenizer library gives for each text, packed."""
    return text_udf(_library_ids(ranks, pattern), "binary")(text)
