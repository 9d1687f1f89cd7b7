import shutil

import pytest
from pyspark.sql import functions as F

from clickloom import operators as ops
from clickloom import plans, sources
from clickloom.schema import SEGMENT_COUNTS, TRANSACTION_FEATURES
from clickloom.sources import landed
from clickloom.streaming import BAD_COLUMN, land_stream


@pytest.fixture
def topic(spark, numbered_log, tmp_path):
    """A folder of messages with partition and offset, standing in for a Kafka topic."""
    path = str(tmp_path / "topic")

    class Topic:
        next = 0

        def send(self, n):
            rows = numbered_log(n, start=self.next).withColumnRenamed("event_id", "offset")
            rows = rows.withColumn("partition", F.lit(0))
            messages = sources.encode_events(rows, keep=("partition", "offset"))
            messages.coalesce(1).write.mode("append").parquet(path)
            self.schema = messages.schema
            self.next += n

        def stream(self, files_per_trigger=1):
            raw = (
                spark.readStream.schema(self.schema)
                .option("maxFilesPerTrigger", files_per_trigger)
                .parquet(path)
            )
            return sources.decode_events(raw, keep=("partition", "offset"))

    return Topic()


def landed_rows(spark, path):
    df = sources.read_batches(spark, path, 1, 10**9, include_final=True)
    return sorted((r.batch_no, r.is_final, r.timestamp) for r in df.collect())


def expected(n, size):
    return [(i // size + 1, i // size + 1 > n // size, i) for i in range(n)]


def test_stream_lands_like_a_batch_job(spark, topic, numbered_log, tmp_path):
    for n in (130, 40, 255):
        topic.send(n)
    path = str(tmp_path / "t")
    land_stream(topic.stream(), path, str(tmp_path / "c"), size=100).awaitTermination()
    assert landed_rows(spark, path) == expected(425, 100)
    batch = ops.assign_batches(numbered_log(425), "event_id", 100)
    assert landed_rows(spark, path) == sorted((r.batch_no, r.is_final, r.timestamp) for r in batch.collect())


def test_restart_neither_loses_nor_repeats(spark, topic, tmp_path):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    topic.send(150)
    for total in (150, 380, 380):
        if topic.next < total:
            topic.send(total - topic.next)
        land_stream(topic.stream(), path, checkpoint, size=100).awaitTermination()
        assert landed_rows(spark, path) == expected(total, 100)


@pytest.mark.parametrize("when", ["before the commit", "within the commit", "after the commit"])
def test_crash_inside_a_landing(spark, topic, tmp_path, monkeypatch, when):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    how = {"size": 10, "batches_per_slice": 3}
    topic.send(50)
    land_stream(topic.stream(), path, checkpoint, **how).awaitTermination()

    topic.send(120)
    whole = landed.land

    def crashing(*args, **kwargs):
        if when != "before the commit":
            whole(*args, **kwargs)
        if when == "within the commit":
            for kept in (tmp_path / "t").glob("*/*/slice=[24]/landing=000000000000050_*"):
                shutil.rmtree(kept)
        raise RuntimeError("machine lost")

    monkeypatch.setattr("clickloom.streaming.landing.land_step", crashing)
    with pytest.raises(Exception, match="machine lost"):
        land_stream(topic.stream(), path, checkpoint, **how).awaitTermination()
    if when == "before the commit":
        assert landed_rows(spark, path) == expected(50, 10)

    monkeypatch.setattr("clickloom.streaming.landing.land_step", whole)
    topic.send(10)
    land_stream(topic.stream(), path, checkpoint, **how).awaitTermination()
    assert landed_rows(spark, path) == expected(180, 10)


def test_new_checkpoint_does_not_overwrite(spark, topic, tmp_path):
    """It is a new writer, which reads from the earliest message on and lands after what is there."""
    path = str(tmp_path / "t")
    topic.send(50)
    for checkpoint in ("c1", "c2"):
        land_stream(topic.stream(), path, str(tmp_path / checkpoint), size=100).awaitTermination()
    rows = landed_rows(spark, path)
    assert {r[0] for r in rows} == {1}
    assert sorted(r[2] for r in rows) == sorted([*range(50), *range(50)])


@pytest.fixture
def streamed(spark, tmp_path):
    """Run a frame through an operator as a stream; give the rows that come out."""

    def run(rows, operator, name):
        rows.write.parquet(str(tmp_path / name))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / name))
        query = operator(stream).writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(spark.table(name).collect())

    return run


def test_predicting_on_a_stream(spark, streamed):
    rows = [(i, i % 9, i % 4, i % 5, int(i % 9 > 4)) for i in range(60)]
    features = spark.createDataFrame(rows, f"visitorid int, {' long, '.join(TRANSACTION_FEATURES)} long, has_transaction int")
    model = plans.fit_transaction_predictor(features)
    requests = features.drop("has_transaction")
    got = streamed(requests, lambda df: ops.score_transactions(model, df), "predict_requests")
    assert got == sorted(ops.score_transactions(model, requests).collect())


def test_segmenting_on_a_stream(spark, streamed):
    rows = [(i, 10 + i % 7, i % 5, i % 3, i % 2) for i in range(60)]
    counts = spark.createDataFrame(rows, f"visitorid int, {' long, '.join(SEGMENT_COUNTS)} long")
    model = plans.fit_segments(ops.with_segment_ratios(counts))
    got = streamed(counts, lambda df: ops.segment_users(model, df), "segment_requests")
    assert got == sorted(ops.segment_users(model, counts).collect())


def test_stream_goes_on_after_a_batch_landing_and_with_a_new_checkpoint(spark, topic, numbered_log, tmp_path):
    path = str(tmp_path / "t")
    sources.land_batches(numbered_log(70, start=0), path, "event_id", size=100)
    topic.next = 70
    topic.send(180)
    land_stream(topic.stream(), path, str(tmp_path / "c"), size=100).awaitTermination()
    assert landed_rows(spark, path) == expected(250, 100)
    before = topic.stream().schema
    later = str(tmp_path / "later")
    rows = numbered_log(60, start=250).withColumnRenamed("event_id", "offset").withColumn("partition", F.lit(0))
    messages = sources.encode_events(rows, keep=("partition", "offset"))
    messages.write.parquet(later)
    arrived = sources.decode_events(spark.readStream.schema(messages.schema).parquet(later), keep=("partition", "offset"))
    assert arrived.schema == before
    for _ in range(2):
        land_stream(arrived, path, str(tmp_path / "new"), size=100).awaitTermination()
        assert landed_rows(spark, path) == expected(310, 100)


def test_landing_goes_on_past_a_broken_message(spark, topic, tmp_path):
    topic.send(40)
    folder, path, bad = str(tmp_path / "topic"), str(tmp_path / "t"), str(tmp_path / "bad")
    broken = [(0, 40, "{oops"), (0, 41, '{"visitorid": 2.5}')]
    spark.createDataFrame(broken, "partition int, offset long, value string").write.mode("append").parquet(folder)
    raw = spark.readStream.schema(topic.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stream = sources.decode_events(raw, ("partition", "offset"), "PERMISSIVE", BAD_COLUMN)
    land_stream(stream, path, str(tmp_path / "c"), size=10, bad_path=bad).awaitTermination()
    assert landed_rows(spark, path) == expected(40, 10)
    kept = spark.read.parquet(bad).select("partition", "offset", BAD_COLUMN).collect()
    assert sorted(map(tuple, kept)) == broken
    with pytest.raises(ValueError, match="needs bad_path"):
        land_stream(stream, path, str(tmp_path / "other"), size=10)
