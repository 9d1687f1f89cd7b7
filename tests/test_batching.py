import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom import operators as ops
from clickloom.operators.batching import _BUCKETS_PER_PARTITION, _KEYS, _with_buckets


def brute_force(keys, size, before=0):
    total = before + len(keys)
    expected = {}
    for i, key in enumerate(sorted(keys)):
        number = (before + i) // size + 1
        expected[key] = (number, number > total // size)
    return expected


def check(df, order, size, before=0):
    result = ops.assign_batches(df, order, size, rows_before=before).select(*order, "batch_no", "is_final").collect()
    got = {tuple(r[: len(order)]): (r.batch_no, r.is_final) for r in result}
    assert len(result) == len(got) == df.count()
    assert got == brute_force([tuple(r) for r in df.select(*order).collect()], size, before)


@pytest.mark.parametrize("n, size", [(1, 10), (10, 10), (1001, 100), (1000, 100), (500, 1)])
def test_dense_key(numbered_log, n, size):
    check(numbered_log(n), ["event_id"], size)


def test_numbering_goes_on(numbered_log):
    check(numbered_log(250), ["event_id"], 100, before=170)


def test_outliers_and_gaps(spark):
    keys = [-(2**62), 2**62, *range(0, 3000, 7), *range(10**12, 10**12 + 500)]
    check(spark.createDataFrame([(k,) for k in keys], "k long").repartition(5), ["k"], 64)


def test_ties_are_cut_by_the_tie_break(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100).alias("lead"), F.col("id").alias("tie")
    )
    check(df, ["lead", "tie"], 77)


def test_one_value_holds_every_row(spark):
    df = spark.range(5000).select(F.lit(4).alias("lead"), (5000 - F.col("id")).alias("tie"))
    check(df, ["lead", "tie"], 300)


def test_topic_partitions(spark):
    df = spark.range(6000).select((F.col("id") % 6).cast("int").alias("partition"), F.floor(F.col("id") / 6).alias("offset"))
    check(df, ["partition", "offset"], 1000)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.sets(st.tuples(st.integers(-3, 3), st.integers(-(2**50), 2**50)), min_size=1, max_size=60),
    size=st.integers(1, 20),
    before=st.integers(0, 50),
)
def test_any_keys(spark, keys, size, before):
    check(spark.createDataFrame(sorted(keys, key=hash), "a long, b long"), ["a", "b"], size, before)


def test_no_bucket_is_hot(spark):
    """A third of the rows in one value of the lead, another third in a burst of near values."""
    n = 90_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 3 == 1, 10**6 + F.col("id") % 50)
        .otherwise(F.col("id") * 10**7)
        .alias("lead"),
        F.col("id").alias("tie"),
    )
    largest = _with_buckets(df, ["lead", "tie"]).groupBy(*_KEYS).count().agg(F.max("count"))
    assert largest.first()[0] <= n / 32 * 3


def _bucket_rows(df, order):
    return [r["count"] for r in _with_buckets(df, order).groupBy(*_KEYS).count().collect()]


@pytest.mark.parametrize("partitions", [1, 8, 60, 500])
def test_buckets_are_bounded_with_topic_partitions(spark, partitions):
    n = 60_000
    df = spark.range(n).select((F.col("id") % partitions).alias("partition"), F.floor(F.col("id") / partitions).alias("offset"))
    rows = _bucket_rows(df, ["partition", "offset"])
    buckets = _BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(rows) <= 2 * buckets
    assert max(rows) <= 8 * n / buckets


def test_hot_nanoseconds(spark):
    """Half of the rows in one value beyond 2**53, where neighbours are one double."""
    n, start = 90_000, 1_700_000_000_000_000_000
    df = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, start + 45_001).otherwise(start + F.col("id")).alias("ns"), F.col("id").alias("tie")
    )
    rows = _bucket_rows(df, ["ns", "tie"])
    buckets = _BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(rows) <= 2 * buckets
    assert max(rows) <= 8 * n / buckets
    check(df, ["ns", "tie"], 1000)


def test_no_rows(numbered_log):
    assert ops.assign_batches(numbered_log(0), "event_id").isEmpty()


def test_missing_key_stops_the_job(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k long")
    with pytest.raises(Exception, match="order column k is null or NaN"):
        ops.assign_batches(df, "k").collect()


def test_arguments(numbered_log):
    with pytest.raises(ValueError):
        ops.assign_batches(numbered_log(1), "event_id", size=0)
    with pytest.raises(ValueError):
        ops.assign_batches(numbered_log(1), ["timestamp", "event_id", "itemid"])


def test_select_and_summary(numbered_log):
    numbered = ops.assign_batches(numbered_log(25), "event_id", 10)
    assert ops.select_batches(numbered, 2, 3).count() == 10
    assert ops.select_batches(numbered, 2, 3, include_final=True).count() == 15
    assert sorted(map(tuple, ops.batch_summary(numbered).collect())) == [
        (1, False, 10, "batch_001.csv"), (2, False, 10, "batch_002.csv"), (3, True, 5, "batch_003_final.csv"),
    ]
