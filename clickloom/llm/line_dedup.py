"""Line dedup: lines that several documents share stay only in the first of them.

Lines are exploded and brought to a key, keys are hashed (128 bits), the distinct documents
of each hash are counted, and each document is put together again from the positions that
stay. Only hashes travel to be counted; texts move once, to meet their own positions.

A line that a third of all documents holds is counted by (hash, document) first, so no task
gets all its rows. Line hashes are written to the shared folder once and read twice; so are
the shared hashes and the positions to drop, so that both joins are plain joins of two exchanges, in which Spark splits a hot
key's rows; building the frame therefore starts jobs.

Defined cases: a null or empty text is one empty line, and comes back as an empty text.
Rows with equal ids are one document when holders are counted, and each keeps its own text;
the lines of its own document are not dropped for one another. Rows with a null id are one
document, the last in order. Lines shorter than ``min_chars`` always stay. All other
columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import ensure_checkpoints, scratch_path

MIN_CHARS = 10
MIN_DOCUMENTS = 2

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def folded(text: Column) -> Column:
    """A-Z in lower case. Where a text is ASCII, ``lower`` does that, and faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def keyed_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, tag, pos, hash`` for each line that is long enough; (id, tag) tells texts apart."""
    return (
        documents.select("id", "tag", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .select("id", "tag", "pos", F.btrim("line", F.lit(SPACE)).alias("stripped"))
        .filter(F.char_length("stripped") >= min_chars)
        .select("id", "tag", "pos", F.unhex(F.md5(folded(F.col("stripped")))).alias("hash"))
    )


def shared_hashes(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``hash, first_id`` of the lines that at least ``min_documents`` documents hold."""
    return (
        lines.groupBy("hash", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash")
        .agg(F.count("one").alias("documents"), F.min("id").alias("first_id"))
        .filter(F.col("documents") >= min_documents)
        .select("hash", "first_id")
    )


def dropped_positions(
    documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``id, tag, positions`` of the texts that lose lines."""
    ensure_checkpoints(documents.sparkSession)
    path = scratch_path(documents.sparkSession, "line-hashes")
    keyed_lines(documents, min_chars).write.parquet(path)
    lines = documents.sparkSession.read.parquet(path)
    shared = shared_hashes(lines, min_documents).checkpoint()
    return (
        lines.join(shared, "hash")
        .filter(~F.col("id").eqNullSafe(F.col("first_id")))
        .groupBy("id", "tag")
        .agg(F.collect_set("pos").alias("positions"))
    )


def dedup_lines(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``row`` (a struct of the document's own columns), ``lines``, and the positions ``kept``, for every row."""
    rows = documents.select(
        F.struct("*").alias("row"),
        documents[doc_id].alias("id"),
        F.unhex(F.md5(F.coalesce(documents[text], F.lit("")))).alias("tag"),
        documents[text].alias("text"),
    )
    gone = dropped_positions(rows, min_chars, min_documents).checkpoint()
    gone = gone.select(F.col("id").alias("gone_id"), F.col("tag").alias("gone_tag"), "positions")
    met = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("tag") == F.col("gone_tag"))
    split = rows.join(gone, met, "left").select("row", "positions", lines_of(F.col("text")).alias("lines"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.when(F.col("positions").isNull(), every).otherwise(F.array_except(every, "positions"))
    return split.select("row", "lines", kept.alias("kept"))


def reassembled(lines: str = "lines", kept: str = "kept") -> Column:
    return F.array_join(F.transform(kept, lambda at: F.get(lines, at)), "\n")


def without_repeated_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with their texts shortened, all other columns as they were."""
    done = dedup_lines(documents, doc_id, text, **options).select("row", reassembled().alias("shorter"))
    same = [F.col("row").getField(c).alias(c) if c != text else F.col("shorter").alias(c) for c in documents.columns]
    return done.select(*same)
