"""MinHash near-dedup by a chosen-path similarity join.

A document's set holds the hashes of its distinct word shingles. Documents of one set are one
class, and only classes are compared. Each tree sends a class down the paths that chosen
minhash coordinates make: two classes stay together in a child where they agree on its
coordinate. A node of at most ``LEAF`` classes and ``LEAF_SHINGLES`` shingles is a leaf. A larger one that ``BLOCKS``
blocks can hold, or that is large by its shingles alone, is cut into blocks of which every
pair is a leaf, so that no pair is left out. Any other branches into two children, by
coordinates drawn from the node's own key, so that more of a pair at the threshold goes on
than was there (2 x 0.8); what is still larger after ``DEPTH`` levels is cut into blocks too.
In a leaf, sketches of one byte a coordinate pick the classes that may have
a partner; those of all leaves, each group once, are then compared exhaustively on their full
sets. Links of a group leave it as a forest, so a group of copies gives no more links than
members. The joins are sort-merge joins at every size, so that a small input shows what a
large one will shuffle. Independent trees repeat the search; ``miss_rate`` gives the chance that
a pair is found in no tree or agrees on fewer than ``AGREE`` coordinates.

No group of documents meets in one task: classes come from a partial aggregation, leaves are
bounded, and joins whose keys may be hot are joins of two exchanges, which Spark splits. What
later steps share is written to the shared folder; building the frame starts jobs.

Defined cases: without words or text, a set is empty and linked with nothing; with fewer words
than a shingle, the sequence is the one shingle. Rows with equal ids are judged each on its
own set, and keep or go alike if the sets are alike. Rows without an id are nobody's copy:
component_id is null and they are kept. Other columns stay, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.textbytes import SPACED_WORD, Texts, Words, mixed, slices, text_udf, window_hashes
from clickloom.session import ensure_checkpoints, scratch_path

PERCENT = 80
SHINGLE = 4
COORDINATES = 64
TREES = 12
LEAF = 2048
#: Shingles that the classes of a leaf have together, at most.
LEAF_SHINGLES = 1 << 22
#: Blocks into which a node is cut at once, at most; what needs more branches first.
BLOCKS = 8
DEPTH = 6
#: Agreeing coordinates of 64 that a pair needs to be compared; at 80 percent, fewer come up once in a million pairs.
AGREE = 36

SIGNED = "struct<n: bigint, fp: binary, mh: array<int>>"
PACKED = "struct<fp: binary, packed: binary>"


def _sets(texts: Texts, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, SPACED_WORD, lower=True)
    windows = window_hashes(words.hashes, size)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            yield window_hashes(words.hashes[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def _fingerprint(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _multipliers(coordinates: int) -> np.ndarray:
    return mixed(np.arange(1, coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _minhashes(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of 32-bit minima for each set; zeros for an empty one."""
    out = np.zeros((len(sets), coordinates), np.int32)
    filled = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if len(filled):
        values = np.concatenate([sets[i] for i in filled])
        starts = np.cumsum([0] + [len(sets[i]) for i in filled[:-1]])
        for k, m in enumerate(_multipliers(coordinates)):
            spread = ((values ^ (values >> np.uint64(32))) * m) >> np.uint64(32)
            out[filled, k] = np.minimum.reduceat(spread.astype(np.uint32), starts).view(np.int32)
    return out


def _signer(size: int, coordinates: int):
    def make():
        def signed(texts: pa.Array) -> pa.Array:
            n, prints, rows = [], [], []
            for part in slices(texts):
                sets = list(_sets(part, size))
                n.extend(map(len, sets))
                prints.extend(_fingerprint(s) if len(s) else None for s in sets)
                rows.append(_minhashes(sets, coordinates))
            flat = np.concatenate(rows).ravel() if rows else np.zeros(0, np.int32)
            ends = np.arange(len(n) + 1, dtype=np.int32) * coordinates
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            columns = [pa.array(n, pa.int64()), pa.array(prints, pa.binary()), lists]
            return pa.StructArray.from_arrays(columns, names=["n", "fp", "mh"])

        return signed

    return make


def _text_packer(size: int):
    def make():
        def packed(texts: pa.Array) -> pa.Array:
            prints, bodies = [], []
            for part in slices(texts):
                sets = list(_sets(part, size))
                prints.extend(_fingerprint(s) if len(s) else None for s in sets)
                for a, b in zip(part.offsets[:-1].tolist(), part.offsets[1:].tolist()):
                    body = part.data[a:b].tobytes()
                    bodies.append(len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True))
            columns = [pa.array(prints, pa.binary()), pa.array(bodies, pa.binary())]
            return pa.StructArray.from_arrays(columns, names=["fp", "packed"])

        return packed

    return make


def _unpacked(bodies: list[bytes], size: int) -> list[np.ndarray]:
    raw = [pa.decompress(b[8:], int.from_bytes(b[:8], "little"), "zstd", asbytes=True) for b in bodies]
    data = np.frombuffer(b"".join(raw), np.uint8)
    return list(_sets(Texts(data, np.cumsum([0, *map(len, raw)])), size))


def _saved(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Trees


def _first_children(trees: int, coordinates: int) -> list[tuple[int, int]]:
    """(tree, coordinate) of the first level: different coordinates while there are enough."""
    order = np.argsort(mixed(np.arange(coordinates, dtype=np.uint64) + np.uint64(7)))
    children = [(tree, branch) for tree in range(trees) for branch in range(1 + (tree % 4 == 3))]
    return [(tree, int(order[k % coordinates])) for k, (tree, _) in enumerate(children)]


def _child(node: Column, coordinate: Column, mh: Column) -> Column:
    return F.xxhash64(node, coordinate, F.get(mh, coordinate))


def _grown(rows: DataFrame, coordinates: int) -> DataFrame:
    """``node, fp, n`` of the two children of each of ``node, fp, n, mh``, by different coordinates."""
    first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(coordinates)).cast("int")
    further = 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(coordinates - 1)).cast("int")
    second = F.pmod(first + further, F.lit(coordinates))
    children = F.array(*(_child(F.col("node"), chosen, F.col("mh")) for chosen in (first, second)))
    return rows.select(F.explode(children).alias("node"), "fp", "n")


def miss_rate(similarity: float, trees: int = TREES, depth: int = DEPTH, agree: int = AGREE) -> float:
    """The chance that a pair whose nodes all branch to the last level is not compared.

    It agrees on k of the coordinates; at the last level, blocks hold every pair.
    """
    c, total = COORDINATES, 0.0
    roots = len(_first_children(trees, c))
    for k in range(c + 1):
        lost = 0.0  # below a node that the pair shares
        both, one = k * (k - 1) / (c * (c - 1)), 2 * k * (c - k) / (c * (c - 1))
        for _ in range(depth - 1):
            lost = both * lost**2 + one * lost + (1 - both - one)
        ways = ((comb(k, a) * comb(c - k, roots - a), lost**a) for a in range(roots + 1))
        missed = sum(w * x for w, x in ways) / comb(c, roots) if k >= agree else 1.0
        total += comb(c, k) * similarity**k * (1 - similarity) ** (c - k) * missed
    return total


def _sized(rows: DataFrame, label: str) -> DataFrame:
    """``node, size, shingles, fp, n`` of the rows that are not alone in their node."""
    sizes = rows.groupBy("node").agg(F.count("fp").alias("size"), F.sum("n").alias("shingles"))
    sizes = sizes.filter("size > 1").checkpoint()
    return _saved(rows.join(sizes.hint("merge"), "node"), label)


def _block_count(leaf: int) -> Column:
    blocks = F.ceil(2 * F.greatest(F.col("size") / leaf, F.col("shingles") / LEAF_SHINGLES))
    return F.least(blocks, F.col("size")).cast("int")


def _blocks(rows: DataFrame, leaf: int) -> DataFrame:
    """Every pair of blocks of a large node, as a node of its own."""
    dealt = rows.withColumn("blocks", _block_count(leaf)).withColumn("own", F.pmod(F.xxhash64("fp", F.lit(5)), "blocks").cast("int"))
    paired = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return paired.select(F.xxhash64("node", low, high).alias("node"), "fp")


def leaves(classes: DataFrame, trees: int = TREES, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """``node, fp``: the classes of each leaf of every tree, leaves of one left out."""
    coordinates = COORDINATES
    roots = [
        F.xxhash64(F.lit(tree), F.lit(k), F.get("mh", F.lit(k))) for tree, k in _first_children(trees, coordinates)
    ]
    rows = classes.select(F.explode(F.array(*roots)).alias("node"), "fp", "n")
    found = None
    for level in range(1, depth + 1):
        sized = _sized(rows, f"near-level-{level}")
        is_leaf = (F.col("size") <= leaf) & (F.col("shingles") <= LEAF_SHINGLES)
        small = sized.filter(is_leaf).select("node", "fp")
        found = small if found is None else found.unionByName(small)
        is_cut = (F.col("size") <= leaf) | (_block_count(leaf) <= BLOCKS) | F.lit(level == depth)
        found = found.unionByName(_blocks(sized.filter(~is_leaf & is_cut), leaf))
        large = sized.filter(~is_leaf & ~is_cut)
        if large.isEmpty():
            return found
        rows = _grown(large.join(classes.select("fp", "mh").hint("merge"), "fp").select("node", "fp", "n", "mh"), coordinates)
    return found


# Comparing


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[pa.RecordBatch]]]:
    """(key, its parts) of batches sorted by their first column; one key is held at a time."""
    key, parts = None, []
    for batch in batches:
        column = batch.column(0)
        if not len(column):
            continue
        edges = [0, *(i for i, (a, b) in enumerate(zip(column[:-1], column[1:]), 1) if a != b), len(column)]
        for a, b in zip(edges, edges[1:]):
            own = column[a].as_py()
            if parts and own != key:
                yield key, parts
                parts = []
            key = own
            parts.append(batch.slice(a, b - a))
    if parts:
        yield key, parts


def _column(parts: list[pa.RecordBatch], k: int) -> list:
    return [x for p in parts for x in p.column(k).to_pylist()]


def _connected(links: np.ndarray) -> np.ndarray:
    """The smallest member that each one reaches."""
    label = np.arange(len(links))
    while True:
        least = np.where(links, label, len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _likely(agree: int):
    """Groups of classes that sketches connect, from leaves: ``gid, fp``."""
    schema = pa.schema([("gid", pa.binary()), ("fp", pa.binary())])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gids, prints = [], []
        for _, parts in _by_key(batches):
            fps = _column(parts, 1)
            sketch = np.frombuffer(b"".join(_column(parts, 2)), np.uint8).reshape(len(fps), -1)
            same = np.zeros((len(fps), len(fps)), np.uint8)
            for k in range(sketch.shape[1]):
                same += sketch[:, k, None] == sketch[None, :, k]
            links = same >= agree
            np.fill_diagonal(links, False)
            label = _connected(links)
            for root in np.flatnonzero(np.bincount(label, minlength=len(fps)) > 1):
                members = sorted(fps[i] for i in np.flatnonzero(label == root))
                gids.extend([hashlib.blake2b(b"".join(members), digest_size=16).digest()] * len(members))
                prints.extend(members)
            if len(gids) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(gids, pa.binary()), pa.array(prints, pa.binary())], schema=schema)
                gids, prints = [], []
        yield pa.RecordBatch.from_arrays([pa.array(gids, pa.binary()), pa.array(prints, pa.binary())], schema=schema)

    return groups


#: Cells of the matrix of members and shingles that are compared at a time.
CELLS = 1 << 22


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of every two sets."""
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    kept = shared[column]
    member, column = member[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    n, width = len(sets), max(1, CELLS // len(sets))
    out = np.zeros((n, n), np.float64)
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        cells = np.zeros((n, width), np.float32)
        cells[member[a:b], column[a:b] - start] = 1
        out += cells @ cells.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out.astype(np.int64)


def _compared(size: int, percent: int):
    """Links of groups, exhaustively compared, as a forest: ``a, b``."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for _, parts in _by_key(batches):
            fps = _column(parts, 1)
            if len(fps) > 1:
                sets = _unpacked(_column(parts, 2), size)
                both = intersections(sets)
                n = np.diag(both)
                linked = 100 * both >= percent * (n[:, None] + n[None, :] - both)
                label = _connected(linked)
                for i in np.flatnonzero(label != np.arange(len(fps))):
                    left.append(fps[i])
                    right.append(fps[label[i]])
            if len(left) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], schema=schema)
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], schema=schema)

    return links


def _links(documents: DataFrame, classes: DataFrame, trees: int, leaf: int, size: int, percent: int) -> DataFrame:
    """Links ``a, b`` between the sets of different classes."""
    pairs_of_digits = F.transform("mh", lambda x: F.lpad(F.hex(x.bitwiseAND(255)), 2, "0"))
    sketches = classes.select("fp", F.unhex(F.array_join(pairs_of_digits, "")).alias("sketch"))
    members = leaves(classes, trees, leaf).join(sketches.hint("merge"), "fp").select("node", "fp", "sketch")
    groups = members.repartition("node").sortWithinPartitions("node").mapInArrow(_likely(AGREE), "gid binary, fp binary")
    groups = _saved(groups.dropDuplicates(["gid", "fp"]), "near-groups")
    packed = documents.select(text_udf(_text_packer(size), PACKED)(F.col("text")).alias("p")).select("p.*")
    packed = packed.filter("fp IS NOT NULL").groupBy("fp").agg(F.first("packed").alias("packed"))
    met = groups.join(packed.hint("merge"), "fp").select("gid", "fp", "packed")
    return met.repartition("gid").sortWithinPartitions("gid").mapInArrow(_compared(size, percent), "a binary, b binary")


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    size: int = SHINGLE,
    trees: int = TREES,
    leaf: int = LEAF,
    extra: str | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, and ``extra``, a column to carry along."""
    ensure_checkpoints(documents.sparkSession)
    carried = [F.col(extra).alias("extra")] if extra else []
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *carried)
    carried = ["extra"] if extra else []
    signed = own.select("doc_id", *carried, text_udf(_signer(size, COORDINATES), SIGNED)(F.col("text")).alias("s"))
    known = F.when(F.col("doc_id").isNotNull(), F.col("s.fp"))
    signed = signed.select("doc_id", *carried, F.col("s.n").alias("n"), known.alias("fp"), F.col("s.mh").alias("mh"))
    ids = _saved(signed, "near-ids")
    classes = (
        ids.filter("fp IS NOT NULL")
        .groupBy("fp")
        .agg(F.first("mh").alias("mh"), F.first("n").cast("int").alias("n"), F.min("doc_id").alias("first_id"))
    )
    classes = _saved(classes, "near-classes")
    with_id = own.filter("doc_id IS NOT NULL")
    links = _links(with_id, classes.select("fp", "n", "mh"), trees, leaf, size, percent)
    labels = components(_saved(links.distinct(), "near-links")).withColumnRenamed("vertex", "fp")
    labelled = classes.select("fp", "first_id").join(labels.hint("merge"), "fp", "left")
    alone = labelled.filter("label IS NULL").select("fp", F.col("first_id").alias("component_id"))
    grouped = labelled.filter("label IS NOT NULL")
    least = grouped.groupBy("label").agg(F.min("first_id").alias("component_id")).checkpoint()
    component = alone.unionByName(grouped.join(least.hint("merge"), "label").select("fp", "component_id")).checkpoint()
    return (
        ids.select("doc_id", *carried, "n", "fp")
        .join(component.hint("merge"), "fp", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
            *carried,
        )
    )


def without_near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are kept, with all their columns: of each group those with its smallest id.

    Rows of that id which are in the group all stay; of rows with equal ids in different
    groups, each goes with its own group, told apart by the fingerprint of its text.
    """
    tag = F.md5(F.coalesce(F.col("text"), F.lit("")))
    rows = documents.select(
        F.struct("*").alias("row"), documents[doc_id].alias("doc_id"), documents[text].alias("text")
    ).withColumn("tag", tag)
    keyed = rows.select("text", F.struct("doc_id", "tag").alias("key"), "doc_id")
    judged = near_duplicates(keyed, "doc_id", "text", extra="key", **options)
    gone = judged.filter("NOT kept").select("extra").distinct().checkpoint()
    gone = gone.select(F.col("extra.doc_id").alias("gone_id"), F.col("extra.tag").alias("gone_tag"))
    met = (F.col("doc_id") == F.col("gone_id")) & (F.col("tag") == F.col("gone_tag"))
    return rows.join(gone, met, "left_anti").select("row.*")
