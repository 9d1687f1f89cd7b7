"""What the physical plans must and must not contain to hold at scale."""

import pytest
from tables_at import TESTDATA

import __spark_entry__ as entry_module
from clickloom import operators as ops
from clickloom.schema import EVENT_COLUMNS
from clickloom.sources.tables import clickstream

SF = f"{TESTDATA}/sf0.01"
RELATIONAL = [
    "known_events", "keyed_events", "event_weight", "ratings", "ratings_deduped", "merge_batches",
    "assign_batches", "assign_batches_by_kind", "batch_summary", "visitor_counts", "distinct_items",
    "transaction_label", "transaction_features", "segment_counts", "segment_features", "encode_events",
    "decode_events",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(entry_module.queries()[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize(
    "name, exchanges",
    [("ratings", 0), ("ratings_deduped", 1), ("segment_features", 1), ("transaction_features", 2), ("known_events", 0)],
)
def test_number_of_shuffles(spark, name, exchanges):
    assert plan_of(entry_module.queries()[name](spark, SF)).count("Exchange") == exchanges


def test_only_needed_columns_are_read(spark):
    plan = plan_of(entry_module.segment_features(spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    clickstream(spark, SF).write.parquet(path)
    plan = plan_of(ops.ratings(spark.read.parquet(path)))
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    for part in ("In(event", "IsNotNull(visitorid)", "IsNotNull(itemid)"):
        assert part in pushed
    assert "timestamp" not in plan.split("ReadSchema:")[1]


def test_rows_are_numbered_in_parallel(spark):
    """The event rows are shuffled once, by bucket; only the bucket counts meet in one task."""
    df = ops.assign_batches(clickstream(spark, SF, ["event_id"]), "event_id", 300)
    exchanges = [line for line in plan_of(df).splitlines() if "Exchange " in line]
    with_events = [line for line in exchanges if "visitorid" in line]
    assert all("SinglePartition" not in line for line in with_events)
    single = [line for line in exchanges if "SinglePartition" in line]
    assert len(single) == 1
    assert df.columns == ["event_id", *EVENT_COLUMNS, "batch_no", "is_final"]


def test_recommending_pairs_no_tables(spark):
    plan = plan_of(entry_module.recommend_topk(spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_session_time_zone_does_not_matter(spark):
    want = entry_module.event_scan(spark, SF).collect()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert sorted(entry_module.event_scan(spark, SF).collect(), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
