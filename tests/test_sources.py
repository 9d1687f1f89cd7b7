import logging
import shutil

import pytest
from pyspark.errors import AnalysisException

from clickloom import operators as ops
from clickloom import sources
from clickloom.schema import EVENT_COLUMNS, EVENT_SCHEMA
from clickloom.sources.landed import extent, land

HEADER = ",".join(EVENT_COLUMNS) + "\n"


def write(path, text):
    path.write_text(text)
    return str(path)


# CSV


def test_id_spellings_in_csv(spark, tmp_path):
    path = write(tmp_path / "e.csv", HEADER + "1,2,transaction,3,4000.0\n1,2,view,3,NaN\n1,2,view,3,\n1,2,transaction,3,4000\n")
    df = sources.read_events_csv(spark, path)
    assert df.schema == EVENT_SCHEMA
    assert [r.transactionid for r in df.collect()] == [4000, None, None, 4000]


def test_reordered_header_is_an_error(spark, tmp_path):
    path = write(tmp_path / "e.csv", "visitorid,timestamp,event,itemid,transactionid\n1,2,view,3,\n")
    with pytest.raises(Exception, match="does not conform to the schema"):
        sources.read_events_csv(spark, path).collect()


def test_corrupt_lines_are_counted(spark, tmp_path):
    bad = ["x,2,view,3,", "1,2,view", "1,2,view,3,4,5", "1,2,transaction,3,abc", "1,99999999999,view,3,"]
    good = ["1,2,view,3,", "1,2,transaction,3,4000.0", "1,2,view,3,NaN", ",,,,"]
    path = write(tmp_path / "e.csv", HEADER + "\n".join(bad + good) + "\n")
    assert tuple(sources.corrupt_rows(spark, path).first()) == (9, 5)


def test_batch_files_by_range(spark, tmp_path, caplog):
    for name, item in [("batch_001", 1), ("batch_002", 2), ("batch_004", 4), ("batch_005_final", 5)]:
        write(tmp_path / f"{name}.csv", HEADER + f"1,1,view,{item},\n")
    read = lambda *a, **k: sorted(r.itemid for r in sources.read_batch_files(spark, str(tmp_path), *a, **k).collect())
    with caplog.at_level(logging.WARNING):
        assert read(2, 5) == [2, 4]
    assert [r.args[0] for r in caplog.records] == [3, 5]
    assert read(1, 5, include_final=True) == [1, 2, 4, 5]


def test_no_batch_file_gives_no_rows(spark, tmp_path):
    for base in (tmp_path, tmp_path / "nowhere"):
        df = sources.read_batch_files(spark, str(base), 1, 3)
        assert df.schema == EVENT_SCHEMA and df.isEmpty()


def test_batch_files_are_one_scan(spark, tmp_path):
    for i in range(1, 13):
        write(tmp_path / f"batch_{i:03d}.csv", HEADER + f"1,1,view,{i},\n")
    df = sources.read_batch_files(spark, str(tmp_path), 1, 12)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") == 1
    assert df.count() == 12


def test_written_batch_files_can_be_read(spark, numbered_log, tmp_path):
    base = str(tmp_path / "batches")
    sources.write_batch_files(ops.assign_batches(numbered_log(25), "event_id", 10), base)
    assert sources.read_batch_files(spark, base, 1, 2).count() == 20
    got = sources.read_batch_files(spark, base, 2, 3, include_final=True)
    assert sorted(r.timestamp for r in got.collect()) == list(range(10, 25))


# messages


def test_id_spellings_in_json(spark):
    texts = ['"transactionid": 4000.0', '"transactionid": NaN', '"transactionid": null', '"itemid": 4']
    values = [('{"timestamp": 1, "visitorid": 2, "event": "view", %s}' % t,) for t in texts]
    df = sources.decode_events(spark.createDataFrame(values, "value string"))
    assert df.schema == EVENT_SCHEMA
    assert [r.transactionid for r in df.collect()] == [4000, None, None, None]


def test_encoded_events_decode_to_themselves(spark, events):
    df = events((1, 2, 'vi"ew', 3, 2**53 + 1), (2, None, None, None))
    encoded = sources.encode_events(df)
    assert encoded.collect()[1].value == (
        '{"timestamp":2,"visitorid":null,"event":null,"itemid":null,"transactionid":null}'
    )
    assert sources.decode_events(encoded).collect() == df.collect()
    binary = encoded.select(encoded.value.cast("binary").alias("value"))
    assert sources.decode_events(binary).collect() == df.collect()


def test_float_spellings_of_every_id(spark, tmp_path):
    value = '{"timestamp": 1, "visitorid": 257597.0, "event": "view", "itemid": 4e1, "transactionid": NaN}'
    df = sources.decode_events(spark.createDataFrame([(value,)], "value string"))
    assert df.schema == EVENT_SCHEMA
    assert tuple(df.first()) == (1, 257597, "view", 40, None)
    path = write(tmp_path / "e.csv", HEADER + "1,257597.0,view,3.0,\n1,NaN,view,3,\n1,2.5,view,3,\n1,2,view,3,4000.5\n")
    assert [tuple(r)[1:] for r in sources.read_events_csv(spark, path).collect()] == [
        (257597, "view", 3, None), (None, "view", 3, None), (None, "view", 3, None), (2, "view", 3, None),
    ]
    assert tuple(sources.corrupt_rows(spark, path).first()) == (4, 2)


@pytest.mark.parametrize("text", ['{"visitorid": 2.5}', '{"itemid": "abc"}', '{"visitorid": 99999999999}', '{"timestamp": "soon"}', "[1"])
def test_messages_with_broken_values(spark, text):
    df = spark.createDataFrame([(text,), ('{"visitorid": 3}',), (None,)], "value string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sources.decode_events(df).collect()
    rows = sources.decode_events(df, mode="PERMISSIVE", bad="bad").collect()
    assert [(r.visitorid, r.bad) for r in rows] == [(None, text), (3, None), (None, None)]


def test_message_that_is_no_json(spark):
    df = spark.createDataFrame([("{oops",)], "value string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sources.decode_events(df).collect()
    assert tuple(sources.decode_events(df, mode="PERMISSIVE").first()) == (None,) * 5


def test_topics_need_the_kafka_connector(spark, events):
    """Without the connector's jar both ends say so; with it they would try to connect."""
    try:
        sources.stream_events(spark, "nowhere:9092", "events")
    except AnalysisException as problem:
        assert "kafka" in str(problem).lower()
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            sources.publish_events(events((1, 2, "view", 3)), "events", "nowhere:9092")


# landed table


def read(spark, path, *args, **kwargs):
    df = sources.read_batches(spark, path, *args, **kwargs)
    return sorted((r.batch_no, r.timestamp) for r in df.collect())


def test_landings_continue_the_numbering(spark, numbered_log, tmp_path):
    path = str(tmp_path / "t")
    sources.land_batches(numbered_log(25), path, "event_id", size=10)
    assert read(spark, path, 1, 9) == [(i // 10 + 1, i) for i in range(20)]
    assert read(spark, path, 3, 3, include_final=True) == [(3, i) for i in range(20, 25)]
    sources.land_batches(numbered_log(20, start=25), path, "event_id", size=10)
    assert read(spark, path, 1, 9) == [(i // 10 + 1, i) for i in range(40)]
    assert read(spark, path, 1, 9, include_final=True) == [(i // 10 + 1, i) for i in range(45)]


def test_range_past_the_end_is_a_warning(spark, numbered_log, tmp_path, caplog):
    path = str(tmp_path / "t")
    sources.land_batches(numbered_log(20), path, "event_id", size=10)
    with caplog.at_level(logging.WARNING):
        assert len(read(spark, path, 2, 5)) == 10
        assert read(spark, path, 3, 5) == []
    assert len(caplog.records) == 2


def test_no_table_gives_no_rows(spark, tmp_path):
    df = sources.read_batches(spark, str(tmp_path / "nowhere"), 1, 3)
    assert df.columns == [*EVENT_COLUMNS, "batch_no", "is_final"] and df.isEmpty()


def test_landing_again_changes_nothing(spark, numbered_log, tmp_path):
    path = str(tmp_path / "t")
    land(numbered_log(25), path, "event_id", 10, "w", 0)
    for again in (False, True, True):
        land(numbered_log(7, start=25), path, "event_id", 10, "w", 1, again=again)
    assert read(spark, path, 1, 9, include_final=True) == [(i // 10 + 1, i) for i in range(32)]
    assert extent(spark, path).total_rows == 32


def test_uncommitted_landing_is_not_seen(spark, numbered_log, tmp_path):
    path = str(tmp_path / "t")
    land(numbered_log(20), path, "event_id", 10, "w", 0)
    staged = tmp_path / "t" / ".spark-staging-1" / "batch_rows=10" / "slice_batches=1000" / "slice=7" / "landing=x"
    staged.mkdir(parents=True)
    (staged / "part-0.parquet").write_bytes(b"cut off")
    assert len(read(spark, path, 1, 9, include_final=True)) == 20
    land(numbered_log(3, start=20), path, "event_id", 10, "w", 1)
    assert len(read(spark, path, 1, 9, include_final=True)) == 23


@pytest.mark.parametrize("left", ["first", "last"])
def test_landing_that_was_committed_in_part(spark, numbered_log, tmp_path, left):
    """Of the landing's four slices only one got its folder; trying again gives all rows their numbers."""
    path, other = str(tmp_path / "t"), str(tmp_path / "whole")
    for table in (path, other):
        land(numbered_log(15), table, "event_id", 10, "w", 0, batches_per_slice=2)
    land(numbered_log(60, start=15), other, "event_id", 10, "w", 1, batches_per_slice=2)
    below = "batch_rows=10/slice_batches=2"
    chosen = f"{below}/slice={0 if left == 'first' else 3}/landing=000000000000015_w_1"
    shutil.copytree(f"{other}/{chosen}", f"{path}/{chosen}")
    land(numbered_log(60, start=15), path, "event_id", 10, "w", 1, batches_per_slice=2, again=True)
    assert read(spark, path, 1, 99, include_final=True) == [(i // 10 + 1, i) for i in range(75)]


def test_tables_keep_their_cut(spark, numbered_log, tmp_path):
    path = str(tmp_path / "t")
    sources.land_batches(numbered_log(20), path, "event_id", size=10)
    for how in ({"size": 11}, {"size": 10, "batches_per_slice": 3}):
        with pytest.raises(ValueError, match="batches of 10 rows"):
            sources.land_batches(numbered_log(20), path, "event_id", **how)


def test_a_range_prunes_folders(spark, numbered_log, tmp_path):
    path = str(tmp_path / "t")
    sources.land_batches(numbered_log(400), path, "event_id", size=10, batches_per_slice=10)
    df = sources.read_batches(spark, path, 11, 20)
    assert len(df.inputFiles()) >= 4  # every slice, before pruning
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "slice" in scan.split("PartitionFilters")[1] and "batch_no" in scan.split("PushedFilters")[1]
    assert sorted(r.timestamp for r in df.collect()) == list(range(100, 200))


def test_length_comes_from_the_last_slice(spark, numbered_log, tmp_path):
    """No other slice's files are read for it: here they can't be."""
    path = str(tmp_path / "t")
    sources.land_batches(numbered_log(47), path, "event_id", size=10, batches_per_slice=2)
    for file in (tmp_path / "t").glob("*/*/slice=0/*/*.parquet"):
        file.write_bytes(b"unreadable")
    assert extent(spark, path).total_rows == 47
    assert read(spark, path, 3, 4) == [(i // 10 + 1, i) for i in range(20, 40)]


def test_passes_over_the_input_of_a_landing(spark, numbered_log, tmp_path):
    """A count, a sample, the bucket counts and the numbering; the rows landed are counted from their files."""
    source = str(tmp_path / "source")
    numbered_log(500).write.parquet(source)
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(source)
    sources.land_batches(df.mapInArrow(counted, df.schema), str(tmp_path / "t"), "event_id", size=100)
    assert rows.value <= 4 * 500
