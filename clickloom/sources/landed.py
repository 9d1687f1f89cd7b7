"""The landed event table: Parquet in folders, numbered batches.

Layout below the table's path, all of it partition columns that Spark's reader knows::

    batch_rows=N/slice_batches=M/slice=S/landing=F_W_T/*.parquet

Batches have ``batch_rows`` rows each. They may be small and many, so they have no folder of
their own: a slice holds ``slice_batches`` of them, sorted, and a range of batches is found by
partition pruning on the slice and row-group pruning on ``batch_no``. As every slice but the
last is full, the table's length is the last slice's place and the rows in its footers.

A landing is written by dynamic partition overwrite, so that it appears when it is committed.
Its name has the number of rows before it, its writer and the writer's step: when it is tried
again, it takes the same numbers and replaces its own folders, and a crash neither loses nor
repeats any. What it was trying comes from the stream's own checkpoint. A table takes one
writer at a time. A landing that spans slices is committed folder by folder; one that a crash
interrupts there is seen in part until it is tried again.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.batching import assign_batches
from clickloom.schema import BATCH_SIZE, EVENT_COLUMNS, EVENT_SCHEMA
from clickloom.sources.files import child_names

log = logging.getLogger(__name__)

BATCHES_PER_SLICE = 1_000

_FOLDERS = ("batch_rows", "slice_batches", "slice", "landing")
_LANDED_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField("batch_no", T.LongType()),
        *(T.StructField(name, T.LongType()) for name in _FOLDERS[:3]),
        T.StructField("landing", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Extent:
    """How a table is cut, and how long it is."""

    size: int
    batches_per_slice: int
    total_rows: int

    @property
    def full_batches(self) -> int:
        return self.total_rows // self.size


def land_batches(
    df: DataFrame,
    path: str,
    order_by: str | Sequence[str],
    size: int = BATCH_SIZE,
    batches_per_slice: int = BATCHES_PER_SLICE,
) -> None:
    """Append the events of ``df``; numbering goes on where the table ends."""
    land(df, path, order_by, size, f"job-{uuid.uuid4().hex}", 0, batches_per_slice)


def land(
    df: DataFrame,
    path: str,
    order_by: str | Sequence[str],
    size: int,
    writer: str,
    step: int,
    batches_per_slice: int = BATCHES_PER_SLICE,
    again: bool = False,
) -> None:
    """Land ``df`` as step ``step`` of a writer; with ``again`` it may have been tried before.

    ``df`` is computed more than once and must give the same rows each time.
    """
    spark = df.sparkSession
    table = extent(spark, path)
    if table and (table.size, table.batches_per_slice) != (size, batches_per_slice):
        raise ValueError(f"{path} has batches of {table.size} rows, {table.batches_per_slice} to a slice")
    before = table.total_rows if table else 0
    if table and again:
        before = _rows_before(spark, path, writer, step, before)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    folders = {
        "batch_rows": F.lit(size),
        "slice_batches": F.lit(batches_per_slice),
        "slice": F.call_function("div", F.col("batch_no") - 1, F.lit(batches_per_slice)),
        "landing": F.lit(f"{before:015d}_{writer}_{step}"),
    }
    (
        assign_batches(df, order, size, rows_before=before)
        .withColumns(folders)
        .sortWithinPartitions("slice", "batch_no")
        .select(*EVENT_COLUMNS, "batch_no", *_FOLDERS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_FOLDERS)
        .parquet(path)
    )


def _rows_before(spark: SparkSession, path: str, writer: str, step: int, otherwise: int) -> int:
    """The rows before a landing as its folders say, if there are any."""
    own = _table(spark, path).filter(F.col("landing").endswith(f"_{writer}_{step}")).select("landing").first()
    return int(own[0].split("_")[0]) if own else otherwise


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_LANDED_SCHEMA).parquet(path)


def _number(spark: SparkSession, path: str, column: str) -> int | None:
    """The largest number that a column's folders directly below ``path`` have."""
    start = f"{column}="
    return max((int(n.removeprefix(start)) for n in child_names(spark, path) if n.startswith(start)), default=None)


def extent(spark: SparkSession, path: str) -> Extent | None:
    """How long the table is; only the footers of its last slice are read."""
    folder, numbers = path.rstrip("/"), []
    for column in _FOLDERS[:3]:
        number = _number(spark, folder, column)
        if number is None:
            return None
        folder = f"{folder}/{column}={number}"
        numbers.append(number)
    size, per_slice, last = numbers
    rows = spark.read.schema(_LANDED_SCHEMA).option("basePath", path).parquet(folder).count()
    return Extent(size, per_slice, last * per_slice * size + rows)


def read_batches(
    spark: SparkSession,
    path: str,
    start: int,
    end: int,
    include_final: bool = False,
) -> DataFrame:
    """Events of batches ``start`` to ``end``, both included, with ``batch_no`` and ``is_final``.

    A range that reaches past the table is a warning, and the rows it does have are read.
    The last batch, while not full, is read on request only.
    """
    table = extent(spark, path)
    if table is None:
        log.warning("no batches below %s", path)
        return spark.createDataFrame([], _LANDED_SCHEMA).select(
            *EVENT_COLUMNS, "batch_no", F.lit(False).alias("is_final")
        )
    last = table.full_batches
    if include_final and table.total_rows % table.size:
        last += 1
    if end > last:
        log.warning("%s ends at batch %d; asked for %d to %d", path, last, start, end)
        end = last
    per_slice = table.batches_per_slice
    return (
        _table(spark, path)
        .filter(F.col("slice").between((start - 1) // per_slice, (end - 1) // per_slice))
        .filter(F.col("batch_no").between(start, end))
        .select(*EVENT_COLUMNS, "batch_no", (F.col("batch_no") > table.full_batches).alias("is_final"))
    )
