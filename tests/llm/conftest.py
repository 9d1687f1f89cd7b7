import pytest
from pyspark.sql import types as T

#: Columns that clash with names the operators use inside or return.
CLASHING = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        *(T.StructField(n, T.StringType()) for n in ("id", "tag", "row", "kept", "fp", "hash", "pos", "n_words", "spans", "s", "label")),
    ]
)


@pytest.fixture
def documents(spark):
    """Make documents of (doc_id, text) with further columns of clashing names."""

    def make(*rows):
        filled = [(i, t, *(f"x{k}" for k in range(len(CLASHING) - 2))) for i, t in rows]
        return spark.createDataFrame(filled, CLASHING)

    return make


@pytest.fixture
def benchmark_items(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "item_id bigint, text string")

    return make
