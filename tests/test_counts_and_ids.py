"""Counts of micro-batches, stopping when idle, corrupt lines, and ids of any type."""

import time

import pytest
from pyspark.sql import functions as F

from clickloom import operators as ops
from clickloom import plans, sources, streaming
from clickloom.schema import EVENT_COLUMNS, EVENT_SCHEMA


@pytest.fixture
def arrived(spark, numbered_log, tmp_path):
    """Messages in a folder, and a stream of them."""
    folder = str(tmp_path / "messages")

    class Arrived:
        def send(self, start, n, *broken):
            rows = numbered_log(n, start).withColumnRenamed("event_id", "offset").withColumn("partition", F.lit(0))
            messages = sources.encode_events(rows, keep=("partition", "offset"))
            if broken:
                messages = messages.unionByName(spark.createDataFrame([(0, start + n + k, text) for k, text in enumerate(broken)], messages.schema))
            messages.coalesce(1).write.mode("append").parquet(folder)
            self.schema = messages.schema

        def stream(self):
            raw = spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(folder)
            return sources.decode_events(raw, ("partition", "offset"), "PERMISSIVE", streaming.BAD_COLUMN)

    return Arrived()


def test_micro_batches_tell_their_rows(spark, arrived, tmp_path):
    for start, n, broken in ((0, 70, ()), (70, 20, ("{oops",)), (91, 5, ())):
        arrived.send(start, n, *broken)
        time.sleep(1.1)  # files are taken in the order of their times
    query = streaming.land_stream(arrived.stream(), str(tmp_path / "t"), str(tmp_path / "c"), size=40, bad_path=str(tmp_path / "bad"))
    query.awaitTermination()
    assert streaming.batch_counts(query) == [(0, 70, 0), (1, 21, 1), (2, 5, 0)]


def test_idle_stop_loses_nothing(spark, arrived, tmp_path):
    setting = "spark.sql.streaming.noDataProgressEventInterval"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "300")
    try:
        path, total = str(tmp_path / "t"), 0
        for n in (50, 30):
            arrived.send(total, n)
            query = streaming.land_stream(
                arrived.stream(), path, str(tmp_path / "c"), size=20, bad_path=str(tmp_path / "bad"), processing_time="200 milliseconds", idle_stop=2
            )
            arrived.send(total + n, 7)  # arrives while it runs
            total += n + 7
            assert query.awaitTermination(90), "the query should have stopped by itself"
            assert query.exception() is None
            rows = sources.read_batches(spark, path, 1, 10**9, include_final=True)
            assert sorted((r.batch_no, r.timestamp) for r in rows.collect()) == [(i // 20 + 1, i) for i in range(total)]
    finally:
        spark.conf.set(setting, before)


HEADER = ",".join(EVENT_COLUMNS) + "\n"


def test_corrupt_lines_are_kept_with_their_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,2,view,3,\nsoon,2,view,3,\n5,4000.0,view,NaN,7.0\n")
    (tmp_path / "b.csv").write_text(HEADER + "6,2.5,view,3,\n7,8,view\n8,9,transaction,1,12\n9,1,view,2,3,4\n")
    good, bad = sources.load_events_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], str(tmp_path / "out"))
    assert good.schema == EVENT_SCHEMA
    assert sorted(map(tuple, good.collect())) == [(1, 2, "view", 3, None), (5, 4000, "view", None, 7), (8, 9, "transaction", 1, 12)]
    kept = sorted((r.file.rsplit("/", 1)[1], r.line) for r in bad.collect())
    assert kept == [("a.csv", "soon,2,view,3,"), ("b.csv", "6,2.5,view,3,"), ("b.csv", "7,8,view"), ("b.csv", "9,1,view,2,3,4")]
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert tuple(sources.corrupt_rows(spark, paths).first()) == (7, 4)


def test_files_without_corrupt_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,2,view,3,\n")
    good, bad = sources.load_events_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    assert (good.count(), bad.count()) == (1, 0)


def test_numbers_have_no_gaps(spark):
    rows = [(f"id-{n % 700}",) for n in range(5_000)] + [(None,), ("",)]
    numbered = ops.number_ids(spark.createDataFrame(rows, "v string"), "v").collect()
    assert sorted(r.number for r in numbered) == list(range(701))
    assert {r.id for r in numbered} == {v for (v,) in rows if v is not None}
    assert ops.number_ids(spark.createDataFrame([], "v string"), "v").count() == 0


def test_more_ids_than_numbers(spark, monkeypatch):
    monkeypatch.setattr(ops.dictionary, "MOST_IDS", 20)
    assert ops.number_ids(spark.range(20), "id").count() == 20
    with pytest.raises(Exception, match="more than 20 ids"):
        ops.number_ids(spark.range(21), "id").collect()


LOG = "timestamp bigint, visitorid string, event string, itemid string, transactionid bigint"


@pytest.fixture
def spelled(spark):
    """A log whose ids are text, one visitor's wider than 32 bits."""
    rows = [(n, "99999999999" if n % 8 == 0 else f"v{n % 8}", "view" if n % 4 else "transaction", f"item/{n * n % 13}", None) for n in range(160)]
    return spark.createDataFrame(rows + [(1, None, "view", "x", None), (2, "v1", "signup", "y", None)], LOG)


def test_recommending_to_ids_of_any_type(spark, spelled, tmp_path):
    store = str(tmp_path / "models")
    model, ids = plans.fit_recommender_by_id(spelled, store)
    users = spark.createDataFrame([("v1", 1), ("99999999999", 2), ("nobody", 3), (None, 4), ("v1", 5)], "visitorid string, request int")
    got = {r.request: r.recommendations for r in ops.recommend_by_id(model, ids, users, 4).collect()}
    assert got[3] == got[4] == [] and got[1] == got[5]
    numbers, plain = {r.id: r.number for r in ids.visitors.collect()}, {r.number: r.id for r in ids.items.collect()}
    assert "x" not in plain.values() and "y" not in plain.values()
    vectors = {r.id: r.features for r in model.userFactors.collect()}
    for request, visitor in ((1, "v1"), (2, "99999999999")):
        own = vectors[numbers[visitor]]
        scores = {plain[r.id]: sum(a * b for a, b in zip(own, r.features)) for r in model.itemFactors.collect()}
        assert [x.rating for x in got[request]] == pytest.approx(sorted(scores.values(), reverse=True)[:4], rel=1e-5)
        assert [scores[x.itemid] for x in got[request]] == pytest.approx([x.rating for x in got[request]], rel=1e-5)

    loaded, warnings = sources.load_models(store)
    again = ops.IdDictionary.load(spark, f"{store}/recommender_ids_v1")
    assert not [w for w in warnings if "model recommender " in w]
    assert {r.request: r.recommendations for r in ops.recommend_by_id(loaded["recommender"], again, users, 4).collect()} == got

    seen = spelled.filter("visitorid = 'v1'")
    left = ops.recommend_by_id(model, ids, users.filter("request = 1"), 20, exclude_seen=seen).first().recommendations
    assert {x.itemid for x in left} == set(plain.values()) - {r.itemid for r in seen.collect()}


def test_numbering_and_restoring(spark, spelled):
    ids = ops.IdDictionary.of(spelled)
    both = ids.restored(ids.numbered(spelled))
    assert both.columns == spelled.columns
    assert sorted(map(str, both.collect())) == sorted(map(str, spelled.collect()))


def test_no_ratings_no_model(spark, spelled, tmp_path):
    assert plans.fit_recommender_by_id(spelled.filter("event = 'signup'"), str(tmp_path)) is None
