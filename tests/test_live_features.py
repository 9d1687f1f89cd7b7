"""Features of a stream against those of a batch, through restarts and crashes; sketches against exact counts."""

import pytest
from pyspark.sql import functions as F

from clickloom import operators as ops
from clickloom import streaming
from clickloom.schema import EVENT_SCHEMA

KINDS = ("view", "addtocart", "transaction", None, "signup")


@pytest.fixture
def parts(spark, events, tmp_path):
    """Three parts of a log with nulls, unknown kinds and pairs that come again in later parts."""
    rows = [(n, None if n % 13 == 0 else n * 7 % 9 - 1, KINDS[n % 5], None if n % 11 == 0 else n * n % 17) for n in range(300)]
    folder = str(tmp_path / "arrived")

    class Log:
        df = events(*rows)

        def arrive(self, start, end):
            events(*rows[start:end]).coalesce(1).write.mode("append").parquet(folder)

        def stream(self):
            return spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)

        def upto(self, n):
            return events(*rows[:n])

    return Log()


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def same(spark, path, df, **how):
    read = streaming.read_feature_parts(spark, path)
    assert rows_of(ops.transaction_features_of(read, **how)) == rows_of(ops.transaction_features(df, **how))
    assert rows_of(ops.segment_features_of(read, **how)) == rows_of(ops.segment_features(df, **how))


@pytest.mark.parametrize("distinct", ["exact", "approximate"])
def test_stream_equals_batch_after_restarts(spark, parts, tmp_path, distinct):
    path, checkpoint = str(tmp_path / "features"), str(tmp_path / "c")
    for start, end in ((0, 90), (90, 91), (91, 300), (300, 300)):
        if end > start:
            parts.arrive(start, end)
        streaming.stream_features(parts.stream(), path, checkpoint, distinct).awaitTermination()
        same(spark, path, parts.upto(end))
    same(spark, path, parts.df, null_visitors="drop")
    assert ops.transaction_features_of(streaming.read_feature_parts(spark, path)).dtypes == ops.transaction_features(parts.df).dtypes


@pytest.mark.parametrize("distinct", ["exact", "approximate"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_crash_inside_a_step(spark, parts, tmp_path, monkeypatch, distinct, when):
    path, checkpoint = str(tmp_path / "features"), str(tmp_path / "c")
    parts.arrive(0, 120)
    streaming.stream_features(parts.stream(), path, checkpoint, distinct).awaitTermination()
    parts.arrive(120, 200)
    module = streaming.features
    name = "_sums" if distinct == "exact" else "feature_parts"
    whole = getattr(module, name)

    def crashing(batch):
        if when == "after":
            whole(batch).write.parquet(f"{path}/step=1")
        raise RuntimeError("machine lost")

    monkeypatch.setattr(module, name, crashing)
    with pytest.raises(Exception, match="machine lost"):
        streaming.stream_features(parts.stream(), path, checkpoint, distinct).awaitTermination()
    monkeypatch.setattr(module, name, whole)
    parts.arrive(200, 300)
    streaming.stream_features(parts.stream(), path, checkpoint, distinct).awaitTermination()
    same(spark, path, parts.df)


def test_another_checkpoint_would_count_again(spark, parts, tmp_path):
    path = str(tmp_path / "features")
    parts.arrive(0, 50)
    streaming.stream_features(parts.stream(), path, str(tmp_path / "c")).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        streaming.stream_features(parts.stream(), path, str(tmp_path / "d"))
    with pytest.raises(ValueError, match="distinct"):
        streaming.stream_features(parts.stream(), path, str(tmp_path / "c"), "roughly")


def test_no_features_yet(spark, tmp_path):
    assert ops.transaction_features_of(streaming.read_feature_parts(spark, str(tmp_path / "none"))).count() == 0


def test_sketches_stay_within_their_error(spark):
    """Exact up to 4,096 items; beyond, within four standard errors, and the same however parts are cut."""
    ids = spark.range(60_000).select(
        F.lit(None).cast("bigint").alias("timestamp"),
        F.when(F.col("id") < 4_000, 1).when(F.col("id") < 9_000, 2).otherwise(3).alias("visitorid"),
        F.lit("view").alias("event"),
        F.col("id").cast("int").alias("itemid"),
    )
    twice = ids.unionByName(ids)
    got = {r.visitorid: r.distinct_items_interacted for r in ops.transaction_features(twice, distinct="approximate").collect()}
    assert got[1] == 4_000
    bound = 4 / (2**ops.features.SKETCH_LG - 1) ** 0.5
    assert abs(got[2] / 5_000 - 1) < bound and abs(got[3] / 51_000 - 1) < bound
    for modulus in (2, 7):
        cut = [ops.feature_parts(twice.filter(F.col("itemid") % modulus == k)) for k in range(modulus)]
        merged = cut[0]
        for part in cut[1:]:
            merged = merged.unionByName(part)
        again = {r.visitorid: r.distinct_items_interacted for r in ops.transaction_features_of(merged).collect()}
        assert again == got
    with pytest.raises(ValueError, match="distinct"):
        ops.transaction_features(twice, distinct="roughly")
