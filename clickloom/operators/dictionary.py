"""Numbers for ids of any type, for models that take 32-bit integers alone.

Distinct ids are dealt to buckets by hash, counted, and numbered within their bucket from
where the buckets before it end: numbers run from 0 without gaps, and no task sees more than
some buckets. A dictionary is kept beside the model that was fitted with it, since another
input, or another number of buckets, numbers ids differently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BUCKETS_PER_PARTITION = 8
#: Fixed value: the largest number a model takes.
MOST_IDS = 2**31 - 1


def number_ids(ids: DataFrame, column: str) -> DataFrame:
    """``id, number`` of each distinct value of a column; null has none. More than 2**31 - 1 ids stop the job."""
    buckets = _BUCKETS_PER_PARTITION * int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = ids.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    own = own.withColumn("_bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    # over one row for each bucket
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = own.groupBy("_bucket").agg(F.count("*").alias("_n"))
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy("id")) - 1
    number = F.col("_start") + F.col("_nth")
    too_many = F.raise_error(F.lit(f"more than {MOST_IDS} ids")).cast("int")
    numbered = own.withColumn("_nth", nth).join(F.broadcast(starts), "_bucket")
    return numbered.select("id", F.when(number < MOST_IDS, number.cast("int")).otherwise(too_many).alias("number"))


@dataclass(frozen=True)
class IdDictionary:
    """Numbers of visitors and of items: frames ``id, number``."""

    visitors: DataFrame
    items: DataFrame

    @classmethod
    def of(cls, events: DataFrame) -> IdDictionary:
        """A dictionary of all ids in ``visitorid`` and ``itemid``."""
        return cls(number_ids(events, "visitorid"), number_ids(events, "itemid"))

    def save(self, path: str) -> IdDictionary:
        """Write it, in place of one that is there, and return it as written."""
        spark = self.visitors.sparkSession
        for name in ("visitors", "items"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        return self.load(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IdDictionary:
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("visitors", "items")))

    def numbered(self, rows: DataFrame) -> DataFrame:
        """The rows with numbers for ``visitorid`` and ``itemid``, where they have these; null for an id it doesn't know."""
        for column, side in (("visitorid", self.visitors), ("itemid", self.items)):
            if column in rows.columns:
                rows = _replaced(rows, column, side, "id", "number")
        return rows

    def restored(self, rows: DataFrame) -> DataFrame:
        """The rows with ids for the numbers in ``visitorid`` and ``itemid``, where they have these."""
        for column, side in (("visitorid", self.visitors), ("itemid", self.items)):
            if column in rows.columns:
                rows = _replaced(rows, column, side, "number", "id")
        return rows


def _replaced(rows: DataFrame, column: str, side: DataFrame, old: str, new: str) -> DataFrame:
    pairs = side.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    columns: list[Column] = [F.col("_new").alias(c) if c == column else F.col(c) for c in rows.columns]
    return rows.join(pairs, F.col(column) == F.col("_old"), "left").select(*columns)
