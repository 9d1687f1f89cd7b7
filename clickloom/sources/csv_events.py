"""Event files with a header: whole files, and numbered batches of them."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import batch_file_name, lost_id, restored_id
from clickloom.schema import EVENT_COLUMNS, EVENT_SCHEMA, ID_TYPES, WIRE_SCHEMA
from clickloom.sources.files import child_names

log = logging.getLogger(__name__)

_CORRUPT = "_corrupt_record"
_FOLDER_KEY = "batch_file="  # a partitioned write puts this before the batch's name


def read_events_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The five event columns. Columns are checked against the header, not bound by position.

    Any number of files is one scan, so small ones share a task and big ones are split.
    """
    return _restored(_reader(spark, WIRE_SCHEMA).csv(_as_list(paths)))


def corrupt_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row, ``n_rows`` and ``n_corrupt``: lines, and those with too few or too many
    values or with one that does not fit its column.
    """
    return _lines(spark, paths).agg(F.count("*").alias("n_rows"), F.count_if(_misfit()).alias("n_corrupt"))


def load_events_csv(spark: SparkSession, paths: str | Sequence[str], out: str) -> tuple[DataFrame, DataFrame]:
    """Write events and corrupt lines below ``out`` in one pass, and return them: five columns; ``file, line``.

    A line with too few or too many values is kept as it is; one with a value that does not fit
    its column as its values, joined by commas.
    """
    spelled = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in EVENT_COLUMNS])
    marked = _lines(spark, paths).withColumns(
        {
            "broken": _misfit(),
            "file": F.when(_misfit(), F.col("_file")),
            "line": F.when(_misfit(), F.coalesce(_CORRUPT, spelled)),
        }
    )
    values = [F.when(~F.col("broken"), _fitted(f)).alias(f.name) for f in EVENT_SCHEMA.fields]
    marked.select(*values, "file", "line", "broken").write.partitionBy("broken").parquet(out)
    schema = T.StructType([*EVENT_SCHEMA.fields, *(T.StructField(c, T.StringType()) for c in ("file", "line"))])
    rows = spark.read.schema(schema.add("broken", T.BooleanType())).parquet(out)
    return rows.filter("NOT broken").select(*EVENT_COLUMNS), rows.filter("broken").select("file", "line")


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All lines with their values as text, which are tried afterwards: the reader only checks columns a query asks for."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*EVENT_COLUMNS, _CORRUPT]])
    lines = (
        _reader(spark, schema)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False)
        .csv(_as_list(paths))
    )
    return lines.select(*EVENT_COLUMNS, _CORRUPT, F.col("_metadata.file_path").alias("_file"))


def _fitted(field: T.StructField) -> Column:
    return restored_id(field.name, field.dataType) if field.name in ID_TYPES else F.col(field.name).try_cast(field.dataType)


def _misfit() -> Column:
    """Whether a line of ``_lines`` is corrupt."""
    misfits = [F.col(f.name).isNotNull() & _fitted(f).isNull() for f in WIRE_SCHEMA.fields if f.name not in ID_TYPES]
    misfits += [lost_id(name, kind) for name, kind in ID_TYPES.items()]
    return reduce(Column.__or__, misfits, F.col(_CORRUPT).isNotNull())


def read_batch_files(
    spark: SparkSession,
    base: str,
    start: int,
    end: int,
    prefix: str = "batch_",
    include_final: bool = False,
) -> DataFrame:
    """Batches ``start`` to ``end`` of the files ``batch_001.csv``, ``batch_002.csv``, ... below ``base``.

    A missing batch is a warning. With no batch at all the frame is empty and has the
    event columns. The unfinished ``_final`` batch is read on request only.
    """
    present = {name.removeprefix(_FOLDER_KEY): name for name in child_names(spark, base)}
    chosen = []
    for number in range(start, end + 1):
        stem = f"{prefix}{number:03d}"
        endings = [".csv", "_final.csv"] if include_final else [".csv"]
        found = [present[stem + e] for e in endings if stem + e in present]
        if not found:
            log.warning("no batch %d below %s", number, base)
        chosen += [f"{base.rstrip('/')}/{name}" for name in found]
    if not chosen:
        return spark.createDataFrame([], EVENT_SCHEMA)
    return read_events_csv(spark, chosen)


def write_batch_files(numbered: DataFrame, base: str) -> None:
    """Write numbered events as CSV, one folder per batch, readable with ``read_batch_files``.

    Numbered events lie in order within their tasks, so a batch comes from few tasks and
    the write needs no shuffle.
    """
    (
        numbered.select(*EVENT_COLUMNS, batch_file_name().alias("batch_file"))
        .write.partitionBy("batch_file")
        .option("header", True)
        .csv(base)
    )


def _reader(spark: SparkSession, schema: T.StructType):
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False)


def _restored(lines: DataFrame) -> DataFrame:
    return lines.withColumns({name: restored_id(name, kind) for name, kind in ID_TYPES.items()})


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
