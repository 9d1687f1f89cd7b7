"""The training-text pipeline: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage is a function of (spark, docs, sf_dir). What it returns is written to the shared
folder and read again as the next one's documents. All but the last return the columns of
``documents``; the last returns one row per document with its token ids and the bytes they
decode to.

Cases that are the same in all stages: other columns stay as they are (but for the last stage,
which returns none of them), whatever their names; rows with equal ids are judged each on its
own text; very long texts are worked on whole; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import byte_bpe
from clickloom.llm.decontaminate import without_contaminated
from clickloom.llm.line_dedup import without_repeated_lines
from clickloom.llm.near_dedup import without_near_duplicates
from clickloom.llm.quality import good_documents
from clickloom.session import scratch_path

#: Near-duplicates of the pipeline share this percentage of their shingles of so many words.
NEAR_PERCENT, NEAR_WORDS = 80, 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep.

    A null or empty text has no words and goes. A null id is judged like any other, but no label
    speaks of it. Without labels of both kinds the base rules alone decide. Ties: a text at the
    threshold stays.
    """
    return good_documents(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one has; n_chars follows the text.

    A null text becomes an empty one. Earlier is whose id is smaller; rows with equal ids are one
    document here and keep a line they share, and rows without an id are the last document. A
    text whose lines all go stays, empty.
    """
    return without_repeated_lines(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id.

    A null or empty text, and a row without an id, is like nothing and stays. Rows that share
    the smallest id of their group all stay.
    """
    return without_near_duplicates(docs, percent=NEAR_PERCENT, size=NEAR_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no test string of the benchmark occurs.

    A null or empty text holds none and stays, whatever its id. Items without an id count, items
    without a text don't; without items all documents stay.
    """
    return without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: its id, its number of tokens, the packed ids and the text decoded from them.

    A null or empty text has no tokens and decodes to an empty one; ids may be null or repeat.
    """
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    done = byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.col("decoded").cast("string").alias("text"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Quality rules are a fitted model and token ids follow from a vocabulary file: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result but the last written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
