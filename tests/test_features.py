import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from clickloom import operators as ops
from clickloom.schema import EVENT_SCHEMA


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=repr)


def test_null_visitor_becomes_a_second_zero(events):
    df = events((1, None, "view", 1), (2, 0, "view", None), (3, 0, "addtocart", 2))
    result = ops.transaction_features(df).collect()
    assert [(r.visitorid, r.num_views, r.distinct_items_interacted) for r in result] == [(0, 1, 1), (0, 1, 1)]
    assert sorted(r.num_addtocart for r in result) == [0, 1]


def test_null_visitor_can_be_dropped(events):
    df = events((1, None, "view", 1), (2, 0, "view", None))
    assert ops.transaction_features(df, null_visitors="drop").count() == 1
    assert ops.segment_counts(df, null_visitors="drop").count() == 1
    with pytest.raises(ValueError):
        ops.segment_counts(df, null_visitors="keep")


def test_null_and_unknown_events_count_in_the_total_only(events):
    df = events((4, 5, None, 3), (5, 5, "signup", 4))
    (t,) = ops.transaction_features(df).collect()
    assert (t.num_views, t.num_addtocart, t.distinct_items_interacted, t.has_transaction) == (0, 0, 2, 0)
    (s,) = ops.segment_features(df).collect()
    assert (s.total_events, s.total_views, s.total_addtocart, s.total_transactions) == (2, 0, 0, 0)
    assert ops.ratings(df).count() == 0


def test_transaction_ratio_is_per_view(events):
    df = events(
        (1, 1, "transaction", 1, 7),
        (2, 2, "view", 1), (3, 2, "transaction", 1, 8), (4, 2, "transaction", 2, 9),
    )
    result = {r.visitorid: r for r in ops.segment_features(df).collect()}
    assert result[1].transaction_ratio == 0.0
    assert result[2].transaction_ratio == 2.0
    assert result[2].view_ratio == pytest.approx(1 / 3)


def test_schemas(events):
    df = events((1, 1, "view", 1))
    assert ops.transaction_features(df).dtypes == [
        ("visitorid", "int"), ("num_views", "bigint"), ("num_addtocart", "bigint"),
        ("distinct_items_interacted", "bigint"), ("has_transaction", "int"),
    ]
    assert ops.segment_features(df).dtypes == [
        ("visitorid", "int"), ("total_events", "bigint"), ("total_views", "bigint"),
        ("total_addtocart", "bigint"), ("total_transactions", "bigint"), ("view_ratio", "double"),
        ("addtocart_ratio", "double"), ("transaction_ratio", "double"),
    ]
    assert ops.ratings(df).dtypes == [("visitorid_int", "int"), ("itemid_int", "int"), ("rating", "double")]


def test_repeated_pairs_stay_repeated(events):
    df = events((1, 1, "view", 9), (2, 1, "view", 9), (3, 1, "transaction", 9, 1), (4, None, "view", 9))
    assert sorted(r.rating for r in ops.ratings(df).collect()) == [1.0, 1.0, 5.0]
    assert [tuple(r) for r in ops.ratings(df, dedupe="max").collect()] == [(1, 9, 5.0)]
    with pytest.raises(ValueError):
        ops.ratings(df, dedupe="mean")


def test_zero_weight_is_no_rating(events):
    df = events((1, 1, "view", 9), (2, 1, "addtocart", 9))
    assert [r.rating for r in ops.ratings(df, weights={"view": 0, "addtocart": 2}).collect()] == [2.0]


def test_ids_beyond_32_bits_stop_the_job(events):
    wide = events((1, 1, "view", 1)).withColumn("visitorid", F.lit(2**40))
    with pytest.raises(ArithmeticException):
        ops.ratings(wide).collect()


def test_no_events(spark):
    none = spark.createDataFrame([], EVENT_SCHEMA)
    for result in (ops.transaction_features(none), ops.segment_features(none), ops.ratings(none)):
        assert result.isEmpty()


def test_union_matches_names_and_keeps_duplicates(events):
    df = events((1, 2, "view", 3))
    other = df.select(*reversed(df.columns))
    assert [tuple(r) for r in ops.merge_batches(df, other, df).collect()] == [(1, 2, "view", 3, None)] * 3


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "a double, b double")
    got = [r.features.toArray().tolist() for r in ops.scaled_features(df, ["a", "b"]).collect()]
    assert [v[1] for v in got] == [0.0, 0.0]
    assert [v[0] for v in got] == pytest.approx([-(0.5**0.5), 0.5**0.5])


def test_invalid_rows_stop_or_skip(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "a double")
    assert ops.assembled_features(df, ["a"], "skip").count() == 2
    with pytest.raises(Exception, match="(?i)null|invalid"):
        ops.assembled_features(df, ["a"]).collect()


def test_a_visitor_with_a_third_of_all_rows(spark):
    """Against counts known from how the rows are made."""
    n = 60_000
    df = spark.range(n).select(
        F.col("id").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000 + 1).cast("int").alias("visitorid"),
        F.when(F.col("id") % 2 == 0, "view").otherwise("transaction").alias("event"),
        (F.col("id") % 5000).cast("int").alias("itemid"),
        F.lit(None).cast("long").alias("transactionid"),
    )
    hot = ops.transaction_features(df).filter("visitorid = 0").first()
    assert (hot.num_views, hot.distinct_items_interacted, hot.has_transaction) == (n // 6, 5000, 1)
    assert ops.segment_counts(df).agg(F.sum("total_events")).first()[0] == n
