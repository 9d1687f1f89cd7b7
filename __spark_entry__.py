"""Queries of this repository and, where SQL can say the same, the SQL that checks them.

Every query reads the whole ``events`` table, directly or from files that Spark derives
from it, so that its work grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import functions as fn
from clickloom import operators as ops
from clickloom import plans, sources
from clickloom.schema import EVENT_COLUMNS, SEGMENT_FEATURES, TRANSACTION_FEATURES
from clickloom.session import scratch_path
from clickloom.sources.model_store import model_path
from clickloom.sources.tables import clickstream
from clickloom.streaming import BAD_COLUMN, batch_counts, land_stream, read_feature_parts, stream_features

# Rows per batch in the queries below: 10,000 would make one batch of the small test tables.
BATCH_ROWS = 300

# The model queries cut the table, whatever its size, into 33 batches and a remainder and
# divide them among the models. Over long ranges every visitor buys something, so the
# predictor's is short, to have both labels.
MODEL_BATCHES = 33
MODEL_RANGES = {
    "recommender": (1, 15),
    "transaction_predictor": (16, 18),
    "user_segmentation": (19, 33),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the transaction features of every visitor."""
    return transaction_features(spark, "/root/testdata/sf0.001")


# Sources and sinks


def event_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "event-csv")
    clickstream(spark, sf_dir).write.option("header", True).csv(path)
    return sources.read_events_csv(spark, path)


def corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose view events carry a time that is no number."""
    path = scratch_path(spark, "broken-csv")
    broken = F.when(fn.is_event("view"), F.lit("soon")).otherwise(F.col("timestamp").cast("string"))
    clickstream(spark, sf_dir).withColumn("timestamp", broken).write.option("header", True).csv(path)
    return sources.corrupt_rows(spark, path)


def _broken_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Good events and corrupt lines of a file whose signups lack a value and whose errors have a visitor that is no integer."""
    path = scratch_path(spark, "mixed-csv")
    events = clickstream(spark, sf_dir, ["event_id"])
    visitor = F.when(fn.is_event("error"), F.concat(F.col("visitorid").cast("string"), F.lit(".5"))).otherwise(F.col("visitorid").cast("string"))
    values = [F.col("timestamp"), visitor, F.col("event"), F.col("itemid"), F.col("transactionid")]
    spelled = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    line = F.when(fn.is_event("signup"), F.concat_ws(",", *spelled[:4])).otherwise(F.concat_ws(",", *spelled))
    # every file of a folder needs the header, so it is the name of the one column that is written as it is
    events.select(line.alias(",".join(EVENT_COLUMNS))).write.options(header=True, quote="", escapeQuotes=False, sep="\t").csv(path)
    return sources.load_events_csv(spark, path, scratch_path(spark, "loaded-csv"))


def loaded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _broken_lines(spark, sf_dir)[0]


def corrupt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _broken_lines(spark, sf_dir)[1].select("line", F.col("file").endswith(".csv").alias("has_file"))


def _batch_files(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "batch-files")
    sources.write_batch_files(assign_batches(spark, sf_dir), base)
    return base


def read_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_batch_files(spark, _batch_files(spark, sf_dir), 2, 30)


def _landed(spark: SparkSession, sf_dir: str, size: int = BATCH_ROWS) -> str:
    path = scratch_path(spark, "landed")
    sources.land_batches(clickstream(spark, sf_dir, ["event_id"]), path, "event_id", size)
    return path


def read_batch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_batches(spark, _landed(spark, sf_dir), 2, 30)


def encode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.encode_events(clickstream(spark, sf_dir))


def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.decode_events(encode_events(spark, sf_dir))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which those of signups are cut short."""
    messages = sources.encode_events(clickstream(spark, sf_dir, ["event_id"]), keep=("event_id", "event"))
    cut = F.when(fn.is_event("signup"), F.left("value", F.lit(20))).otherwise(F.col("value"))
    return messages.select("event_id", cut.alias("value"))


def decode_broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = sources.decode_events(_broken(spark, sf_dir), ("event_id",), "PERMISSIVE", BAD_COLUMN)
    return decoded.filter(F.col(BAD_COLUMN).isNull()).drop(BAD_COLUMN)


def bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = sources.decode_events(_broken(spark, sf_dir), ("event_id",), "PERMISSIVE", BAD_COLUMN)
    return decoded.filter(F.col(BAD_COLUMN).isNotNull()).select("event_id", BAD_COLUMN)


def decode_float_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids as a producer writes them that holds them as floats, as missing ones make it do."""
    floats = {c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("visitorid", "itemid", "transactionid")}
    events = _with_gaps(clickstream(spark, sf_dir)).withColumns(floats)
    return sources.decode_events(sources.encode_events(events))


def land_topic_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty topic partitions with offsets of their own, landed in the order of partition and offset."""
    events = clickstream(spark, sf_dir, ["event_id"])
    events = events.withColumn("partition", F.col("event_id") % 60).withColumnRenamed("event_id", "offset")
    path = scratch_path(spark, "partitions")
    sources.land_batches(events, path, ["partition", "offset"], BATCH_ROWS)
    return sources.read_batches(spark, path, 1, 2**62, include_final=True)


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages arrive in two parts; the stream is stopped in between and goes on from its checkpoint."""
    events = clickstream(spark, sf_dir, ["event_id"]).withColumn("partition", F.lit(0))
    messages = sources.encode_events(
        events.withColumnRenamed("event_id", "offset"), keep=("partition", "offset")
    )
    topic, table = scratch_path(spark, "messages"), scratch_path(spark, "stream-landed")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    middle = messages.approxQuantile("offset", [0.5], 0.1)[0]
    for part in (F.col("offset") < middle, F.col("offset") >= middle):
        messages.filter(part).write.mode("append").parquet(topic)
        arrived = spark.readStream.schema(messages.schema).parquet(topic)
        decoded = sources.decode_events(arrived, keep=("partition", "offset"))
        land_stream(decoded, table, checkpoint, size=BATCH_ROWS).awaitTermination()
    return sources.read_batches(spark, table, 1, 2**62, include_final=True)


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each start of a stream, as its micro-batches report them: all there is at first, then what is new."""
    events = clickstream(spark, sf_dir, ["event_id"]).withColumn("partition", F.lit(0))
    messages = sources.encode_events(events.withColumnRenamed("event_id", "offset"), keep=("partition", "offset"))
    topic, table = scratch_path(spark, "counted"), scratch_path(spark, "counted-landed")
    checkpoint, rows = scratch_path(spark, "counted-checkpoint"), []
    for start, part in enumerate((F.col("offset") % 3 > 0, F.col("offset") % 3 == 0), 1):
        messages.filter(part).write.mode("append").parquet(topic)
        arrived = spark.readStream.schema(messages.schema).parquet(topic)
        query = land_stream(sources.decode_events(arrived, keep=("partition", "offset")), table, checkpoint, size=BATCH_ROWS)
        query.awaitTermination()
        rows.append((start, sum(n for _, n, _ in batch_counts(query)), sum(bad for *_, bad in batch_counts(query))))
    return spark.createDataFrame(rows, "start int, n_rows bigint, n_bad bigint")


def _streamed_parts(spark: SparkSession, sf_dir: str, distinct: str) -> DataFrame:
    """The table arrives in two parts; the stream is stopped in between and goes on from its checkpoint."""
    events = clickstream(spark, sf_dir, ["event_id"])
    log, path = scratch_path(spark, "events"), scratch_path(spark, "live-features")
    checkpoint = scratch_path(spark, "live-checkpoint")
    for part in (F.col("event_id") % 5 < 3, F.col("event_id") % 5 >= 3):
        events.filter(part).write.mode("append").parquet(log)
        arrived = spark.readStream.schema(events.schema).parquet(log)
        stream_features(arrived, path, checkpoint, distinct).awaitTermination()
    return read_feature_parts(spark, path)


def stream_features_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.transaction_features_of(_streamed_parts(spark, sf_dir, "exact"))


def stream_features_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches are exact for as few items as the table has."""
    return ops.transaction_features_of(_streamed_parts(spark, sf_dir, "approximate"))


def stream_segment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_features_of(_streamed_parts(spark, sf_dir, "exact"))


# Filters, projections, unions


def known_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.known_events(clickstream(spark, sf_dir))


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_keys(_with_gaps(clickstream(spark, sf_dir)))


def _with_gaps(events: DataFrame) -> DataFrame:
    """Events of unknown type lose their visitor or item, so that there are nulls to meet."""
    return events.withColumns(
        {
            "visitorid": F.when(~fn.is_event("signup"), F.col("visitorid")),
            "itemid": F.when(~fn.is_event("error"), F.col("itemid")),
        }
    )


def event_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream(spark, sf_dir).withColumn("weight", fn.event_weight("event"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ratings(clickstream(spark, sf_dir))


def ratings_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.ratings(clickstream(spark, sf_dir), dedupe="max")


def merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table twice, the second time with its columns the other way round."""
    events = clickstream(spark, sf_dir)
    return ops.merge_batches(events, events.select(*reversed(EVENT_COLUMNS)))


# Batches


def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.assign_batches(clickstream(spark, sf_dir, ["event_id"]), "event_id", BATCH_ROWS)


def assign_batches_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered by a column of four values and a tie-break, as by topic partition and offset."""
    events = clickstream(spark, sf_dir, ["event_id"])
    kind_length = F.length("event").alias("kind_length")
    return ops.assign_batches(events.select("*", kind_length), ["kind_length", "event_id"], BATCH_ROWS)


def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.batch_summary(assign_batches(spark, sf_dir))


# Features


def visitor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_counts(clickstream(spark, sf_dir)).select(
        "visitorid",
        "total_events",
        F.col("total_views").alias("num_views"),
        F.col("total_addtocart").alias("num_addtocart"),
    )


def distinct_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_features(spark, sf_dir).select("visitorid", "distinct_items_interacted")


def transaction_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_features(spark, sf_dir).select("visitorid", "has_transaction")


def transaction_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.transaction_features(clickstream(spark, sf_dir))


def transaction_features_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.transaction_features(_with_gaps(clickstream(spark, sf_dir)))


def transaction_features_known_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.transaction_features(_with_gaps(clickstream(spark, sf_dir)), null_visitors="drop")


def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_counts(clickstream(spark, sf_dir))


def segment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.segment_features(clickstream(spark, sf_dir))


def approximate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches are exact for as few items as the table has."""
    return ops.transaction_features(clickstream(spark, sf_dir), distinct="approximate")


def merged_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of three thirds of the table, made each by itself and merged."""
    events = clickstream(spark, sf_dir, ["event_id"])
    first, *others = (ops.feature_parts(events.filter(F.col("event_id") % 3 == k)) for k in range(3))
    for part in others:
        first = first.unionByName(part)
    return ops.transaction_features_of(first)


def _elements(df: DataFrame, vector: str, names: list[str]) -> DataFrame:
    """One column per vector element; rounded, and without a negative zero."""
    values = vector_to_array(F.col(vector))
    return df.select(
        "visitorid", *[(F.round(F.get(values, F.lit(i)), 9) + 0.0).alias(n) for i, n in enumerate(names)]
    )


def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ops.assembled_features(transaction_features(spark, sf_dir), TRANSACTION_FEATURES)
    return _elements(features, "features_unscaled", TRANSACTION_FEATURES)


def assembled_segment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors without views have no transaction ratio here, and are skipped."""
    ratio = F.when(F.col("total_views") > 0, F.col("transaction_ratio")).alias("transaction_ratio")
    features = segment_features(spark, sf_dir).withColumn("transaction_ratio", ratio)
    return _elements(
        ops.assembled_features(features, SEGMENT_FEATURES, "skip"), "features_unscaled", SEGMENT_FEATURES
    )


def scaled_transaction_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ops.scaled_features(transaction_features(spark, sf_dir), TRANSACTION_FEATURES)
    return _elements(features, "features", TRANSACTION_FEATURES)


def scaled_segment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ops.scaled_features(segment_features(spark, sf_dir), SEGMENT_FEATURES, "skip")
    return _elements(features, "features", SEGMENT_FEATURES)


# Models


def _landed_for_models(spark: SparkSession, sf_dir: str) -> Callable[[int, int], DataFrame]:
    rows = clickstream(spark, sf_dir).count()
    return partial(sources.read_batches, spark, _landed(spark, sf_dir, rows // MODEL_BATCHES))


def recommend_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five items for every visitor of the table, and none for one it does not have."""
    events = clickstream(spark, sf_dir)
    model = plans.fit_recommender(ops.ratings(events))
    visitors = events.select("visitorid").distinct()
    return ops.recommend(model, visitors.union(visitors.agg(-F.max("visitorid"))), 5)


def explode_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.explode_recs(recommend_topk(spark, sf_dir))


# Ranking by factors that SQL can count: how often visitors and items have events of each type


def _kinds_by(events: DataFrame, column: str, modulus: tuple[int, ...] | None = None) -> DataFrame:
    counts = [F.count_if(fn.is_event(kind)) for kind in ("view", "addtocart", "transaction")]
    counts = [c % m for c, m in zip(counts, modulus)] if modulus else counts
    features = F.array(*[c.cast("double") for c in counts]).alias("features")
    return events.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("id")).agg(features)


def _ranked(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    """Few different item factors, so that most scores are tied."""
    events = clickstream(spark, sf_dir)
    return ops.rank_items(_kinds_by(events, "visitorid"), _kinds_by(events, "itemid", (5, 3, 2)), k)


def rank_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = _ranked(spark, sf_dir, 20)
    return ranked.select(
        F.col("id").alias("visitorid"),
        F.array_join(F.col("ranked.itemid").cast("array<string>"), ",").alias("items"),
        F.get("ranked.rating", F.lit(0)).alias("best_rating"),
    )


def _with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visitor and one that the table doesn't have, each with five ranked items if known."""
    visitors = clickstream(spark, sf_dir).select("visitorid").distinct()
    users = visitors.union(visitors.agg(-F.max("visitorid")))
    return ops.with_ranked(users, _ranked(spark, sf_dir, 5), F.col("visitorid").try_cast("int"))


def explode_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = ops.explode_recs(_with_unknown(spark, sf_dir))
    return ranked.withColumns({"rating": F.col("rating").cast("double"), "rank": F.col("rank").cast("bigint")})


def unknown_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _with_unknown(spark, sf_dir)
    return users.select("visitorid", F.size("recommendations").cast("bigint").alias("n_recommendations"))


def rank_items_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items in blocks of sixteen by the length of their factors; visitors meet those that can hold one of their best."""
    events = clickstream(spark, sf_dir)
    ranked = ops.rank_items(_kinds_by(events, "visitorid"), _kinds_by(events, "itemid", (5, 3, 2)), 5, items_per_block=16)
    return ranked.select(F.col("id").alias("visitorid"), F.inline("ranked")).select("visitorid", "itemid", "rating")


def rank_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No visitor gets an item it has had a transaction with."""
    events = clickstream(spark, sf_dir)
    seen = events.filter(fn.is_event("transaction")).select(F.col("visitorid").alias("id"), "itemid")
    sides = _kinds_by(events, "visitorid"), _kinds_by(events, "itemid", (5, 3, 2))
    ranked = ops.rank_items(*sides, 10, items_per_block=16, seen=seen)
    return ranked.select(F.col("id").alias("visitorid"), F.inline("ranked")).select("visitorid", "itemid", "rating")


def _with_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors beyond 32 bits, as text, and items with a prefix."""
    wide = (F.col("visitorid").cast("bigint") + F.lit(2**40)).cast("string")
    return clickstream(spark, sf_dir).withColumns({"visitorid": wide, "itemid": F.concat(F.lit("item-"), F.col("itemid").cast("string"))})


def numbered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many numbers each dictionary has, and the least and greatest."""
    ids = ops.IdDictionary.of(_with_text_ids(spark, sf_dir))
    return ids.visitors.withColumn("side", F.lit("visitors")).unionByName(ids.items.withColumn("side", F.lit("items"))).groupBy("side").agg(
        F.count_distinct("number").alias("n_ids"), F.min("number").alias("least"), F.max("number").alias("greatest")
    )


def restored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with numbers for ids, saved and loaded, and ids for numbers again."""
    events = _with_text_ids(spark, sf_dir)
    ids = ops.IdDictionary.of(events).save(scratch_path(spark, "dictionary"))
    return ids.restored(ids.numbered(events))


def recommend_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors with ids as text: how many items each is recommended, whether they differ, fall in rating and are in the table."""
    events = _with_text_ids(spark, sf_dir)
    model, ids = plans.fit_recommender_by_id(events, scratch_path(spark, "models"))
    recommended = ops.recommend_by_id(model, ids, events.select("visitorid").distinct(), 5)
    return _shape(recommended, events.select("itemid").distinct())


def _shape(recommended: DataFrame, items: DataFrame) -> DataFrame:
    """What holds for any model's recommendations, visitor by visitor."""
    rows = recommended.select("visitorid", F.posexplode_outer("recommendations").alias("pos", "rec"))
    rows = rows.select("visitorid", "pos", "rec.*").join(items.withColumn("known", F.lit(True)), "itemid", "left")
    ratings_in_order = F.array_sort(F.collect_list(F.struct("pos", F.col("rating").cast("double").alias("rating"))))
    gathered = rows.groupBy("visitorid").agg(
        F.count("itemid").alias("n_items"), F.count_distinct("itemid").alias("n_different"), F.count("known").alias("n_known"), ratings_in_order.alias("ratings")
    )
    steps = F.zip_with(F.col("ratings.rating"), F.slice("ratings.rating", 2, F.greatest(F.size("ratings") - 1, F.lit(0))), lambda a, b: F.coalesce(a >= b, F.lit(True)))
    return gathered.select("visitorid", "n_items", "n_different", "n_known", F.forall(steps, lambda x: x).alias("falls"))


# What must hold for any fit, computed from the fit


def recommended_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of ``recommend_topk``: five different items of the table for each visitor, best first; none for one it doesn't have."""
    return _shape(recommend_topk(spark, sf_dir), clickstream(spark, sf_dir).select("itemid").distinct())


def unseen_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommending without what a visitor has had: how many items that leaves, up to 20, and that none was had."""
    events = clickstream(spark, sf_dir)
    model = plans.fit_recommender(ops.ratings(events))
    had = events.filter(fn.is_event("transaction")).select("visitorid", "itemid")
    given = ops.explode_recs(ops.recommend(model, events.select("visitorid").distinct(), 20, exclude_seen=had))
    marked = given.join(had.distinct().withColumn("had", F.lit(1)), ["visitorid", "itemid"], "left")
    return marked.groupBy("visitorid").agg(F.count_distinct("itemid").alias("n_items"), F.count("had").alias("n_had"))


def exploded_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of ``explode_recs``: the ranks of each visitor."""
    return explode_recs(spark, sf_dir).select("visitorid", F.col("rank").cast("bigint").alias("rank"))


def segmented_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of ``segment_users``: every visitor is in one of five segments, and no segment is empty."""
    rows = segment_users(spark, sf_dir)
    used = rows.agg(F.count_distinct("cluster_id").alias("n_segments"))
    return rows.join(F.broadcast(used)).select("visitorid", F.col("cluster_id").between(0, 4).alias("in_range"), "n_segments")


def trained_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of ``train_all``: each visitor's decision follows from its probability, it has a segment, and items if its range knew it."""
    rows = train_all(spark, sf_dir)
    return rows.select(
        "visitorid",
        (F.col("probability").between(0, 1) & (F.col("will_transact") == (F.col("probability") > 0.5))).alias("decided"),
        F.col("cluster_id").between(0, 4).alias("has_segment"),
        F.size("recommendations").cast("bigint").alias("n_recommendations"),
    )


def empty_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges beyond the landed table: no events, no model, and a warning for each that is not there to load."""
    read, store = _landed_for_models(spark, sf_dir), scratch_path(spark, "models")
    beyond = {name: (last + 1_000, last + 2_000) for name, (_, last) in MODEL_RANGES.items()}
    fitted = plans.train_all(read, store, beyond)
    loaded, warnings = sources.load_models(store)
    rows = [(name, read(*beyond[name]).count(), fitted[name] is not None, name in loaded, any(f"model {name} " in w for w in warnings)) for name in beyond]
    return spark.createDataFrame(rows, "model string, n_events bigint, was_fitted boolean, was_loaded boolean, has_warning boolean")


def model_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model is fitted and saved, one folder holds something else, one is missing."""
    store = scratch_path(spark, "models")
    sources.save_model(plans.fit_segments(segment_features(spark, sf_dir)), model_path(store, "user_segmentation"))
    clickstream(spark, sf_dir).write.parquet(model_path(store, "recommender"))
    loaded, warnings = sources.load_models(store)
    rows = [(name, name in loaded, sum(f"model {name} " in w for w in warnings)) for name in MODEL_RANGES]
    return spark.createDataFrame(rows, "model string, was_loaded boolean, n_warnings bigint")


def recommender_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors for every visitor and item rated, and an error below that of the mean rating."""
    rated = ops.ratings(clickstream(spark, sf_dir))
    model = plans.fit_recommender(rated)
    mean = rated.agg(F.avg("rating").alias("mean"))
    fitted = model.transform(rated).crossJoin(F.broadcast(mean))
    errors = fitted.agg(
        F.avg((F.col("prediction") - F.col("rating")) ** 2).alias("of_model"),
        F.avg((F.col("mean") - F.col("rating")) ** 2).alias("of_mean"),
    )
    sides = [
        factors.agg(F.count("id").alias(name))
        for factors, name in ((model.userFactors, "n_visitors"), (model.itemFactors, "n_items"))
    ]
    one = errors.crossJoin(sides[0]).crossJoin(sides[1])  # of one row each
    return one.select("n_visitors", "n_items", (F.col("of_model") < F.col("of_mean")).alias("beats_mean"))


def forest_of_one_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = transaction_features(spark, sf_dir)
    model = plans.fit_transaction_predictor(features.withColumn("has_transaction", F.lit(1)))
    return ops.score_transactions(model, features.drop("has_transaction"))


def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each visitor's probability is one, and agrees with the decision."""
    scored = score_transactions(spark, sf_dir)
    return scored.select(
        "visitorid",
        F.col("probability").between(0, 1).alias("is_probability"),
        (F.col("will_transact") == (F.col("probability") > 0.5)).alias("agrees"),
    )


def nearest_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether no centre is nearer to a visitor than that of its segment, and the segment is an integer."""
    features = segment_features(spark, sf_dir)
    model = plans.fit_segments(features)
    *prepare, kmeans = model.stages
    scaled = features
    for stage in prepare:
        scaled = stage.transform(scaled)
    point = vector_to_array(F.col("features"))
    distances = F.array(
        *[
            F.aggregate(
                F.zip_with(point, F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b)),
                F.lit(0.0),
                lambda total, d: total + d,
            )
            for centre in kmeans.clusterCenters()
        ]
    )
    measured = scaled.select("visitorid", distances.alias("distances"))
    both = ops.segment_users(model, features).join(measured, "visitorid")
    own = F.get("distances", F.col("cluster_id"))
    return both.select("visitorid", (own <= F.array_min("distances") + 1e-9).alias("is_nearest"))


def segment_users_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third visitor has no number of views and every third no view ratio: rows without a segment."""
    features = segment_features(spark, sf_dir)
    gaps = {
        "total_views": F.when(F.col("visitorid") % 3 != 0, F.col("total_views")),
        "view_ratio": F.when(F.col("visitorid") % 3 != 1, F.col("view_ratio")),
    }
    segmented = ops.segment_users(plans.fit_segments(features), features.withColumns(gaps))
    return segmented.select("visitorid", F.col("cluster_id").isNotNull().alias("has_segment"))


def reloaded_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each visitor's scores are the same from the fitted and from the loaded models."""
    store = scratch_path(spark, "models")
    fitted = plans.train_all(_landed_for_models(spark, sf_dir), store, MODEL_RANGES)
    loaded, _ = sources.load_models(store)
    events = clickstream(spark, sf_dir)
    features = ops.transaction_features(events).join(ops.segment_features(events), "visitorid")

    def scores(models: dict, name: str) -> DataFrame:
        scored = ops.score_transactions(models["transaction_predictor"], features)
        scored = ops.recommend(models["recommender"], ops.segment_users(models["user_segmentation"], scored), 3)
        parts = F.struct("probability", "will_transact", "cluster_id", "recommendations")
        return scored.select("visitorid", F.to_json(parts).alias(name))

    both = scores(fitted, "before").join(scores(loaded, "after"), "visitorid")
    return both.select("visitorid", (F.col("before") == F.col("after")).alias("same"))


def training_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many visitors each model was fitted on, from its factors, its trees' root and its clusters."""
    models = plans.train_all(_landed_for_models(spark, sf_dir), scratch_path(spark, "models"), MODEL_RANGES)
    forest, kmeans = models["transaction_predictor"].stages[-1], models["user_segmentation"].stages[-1]
    seen = {
        "recommender": models["recommender"].userFactors.count(),
        "transaction_predictor": forest.summary.predictions.count(),
        "user_segmentation": sum(kmeans.summary.clusterSizes),
    }
    return spark.createDataFrame(list(seen.items()), "model string, n_visitors bigint")


def score_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visitor of the table, by a forest trained on its range of batches."""
    trained_on = _landed_for_models(spark, sf_dir)(*MODEL_RANGES["transaction_predictor"])
    model = plans.fit_transaction_predictor(ops.transaction_features(trained_on))
    return ops.score_transactions(model, transaction_features(spark, sf_dir))


def segment_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = segment_features(spark, sf_dir)
    return ops.segment_users(plans.fit_segments(features), features)


def train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three models from their ranges of landed batches, saved, loaded and used on every visitor."""
    store = scratch_path(spark, "models")
    plans.train_all(_landed_for_models(spark, sf_dir), store, MODEL_RANGES)
    models, _ = sources.load_models(store)

    events = clickstream(spark, sf_dir)
    features = ops.transaction_features(events).join(ops.segment_features(events), "visitorid")
    scored = ops.score_transactions(models["transaction_predictor"], features)
    scored = ops.segment_users(models["user_segmentation"], scored)
    return ops.recommend(models["recommender"], scored, 3)


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, sf_dir) and gives a DataFrame."""
    return {
        query.__name__: query
        for query in (
            event_scan,
            corrupt_rows,
            read_batch_files,
            read_batch_range,
            encode_events,
            decode_events,
            decode_broken_messages,
            bad_messages,
            decode_float_ids,
            land_topic_partitions,
            stream_landing,
            known_events,
            keyed_events,
            event_weight,
            ratings,
            ratings_deduped,
            merge_batches,
            assign_batches,
            assign_batches_by_kind,
            batch_summary,
            visitor_counts,
            distinct_items,
            transaction_label,
            transaction_features,
            transaction_features_with_gaps,
            transaction_features_known_visitors,
            segment_counts,
            segment_features,
            assembled_features,
            assembled_segment_features,
            scaled_transaction_features,
            scaled_segment_features,
            recommend_topk,
            explode_recs,
            score_transactions,
            segment_users,
            train_all,
            rank_items,
            explode_ranked,
            unknown_visitors,
            recommender_fit,
            forest_of_one_class,
            forest_scores,
            nearest_segment,
            segment_users_with_gaps,
            reloaded_models,
            training_ranges,
            loaded_events,
            corrupt_lines,
            stream_batch_counts,
            stream_features_exact,
            stream_features_approximate,
            stream_segment_features,
            approximate_features,
            merged_features,
            rank_items_pruned,
            rank_unseen,
            numbered_ids,
            restored_ids,
            recommend_text_ids,
            recommended_shape,
            unseen_shape,
            exploded_ranks,
            segmented_users,
            trained_scores,
            empty_ranges,
            model_warnings,
        )
    }


# SQL

_EVENTS = """
clicks AS (
  SELECT event_id,
         epoch_us(ts) // 1000 AS timestamp,
         CAST(user_id AS INTEGER) AS visitorid,
         CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction'
                         ELSE event_type END AS event,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS itemid,
         CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid
  FROM events)"""

_GAPS = """
gaps AS (
  SELECT timestamp, CASE WHEN event <> 'signup' THEN visitorid END AS visitorid, event,
         CASE WHEN event <> 'error' THEN itemid END AS itemid, transactionid
  FROM clicks)"""

_NUMBERED = f"""
numbered AS (
  SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // {BATCH_ROWS} + 1 AS batch_no FROM clicks),
batches AS (
  SELECT *, count(*) OVER (PARTITION BY batch_no) < {BATCH_ROWS} AS is_final FROM numbered)"""


def _transaction_features_sql(table: str) -> str:
    return f"""
tf AS (
  SELECT coalesce(visitorid, 0) AS visitorid, num_views, num_addtocart, distinct_items_interacted,
         has_transaction
  FROM (SELECT visitorid,
               count(CASE WHEN event = 'view' THEN 1 END) AS num_views,
               count(CASE WHEN event = 'addtocart' THEN 1 END) AS num_addtocart,
               count(DISTINCT itemid) AS distinct_items_interacted,
               max(CASE WHEN event = 'transaction' THEN 1 ELSE 0 END) AS has_transaction
        FROM {table} GROUP BY visitorid))"""


_SEGMENT_FEATURES = """
sc AS (
  SELECT visitorid, count(*) AS total_events,
         CAST(sum(CASE WHEN event = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS total_views,
         CAST(sum(CASE WHEN event = 'addtocart' THEN 1 ELSE 0 END) AS BIGINT) AS total_addtocart,
         CAST(sum(CASE WHEN event = 'transaction' THEN 1 ELSE 0 END) AS BIGINT) AS total_transactions
  FROM clicks GROUP BY visitorid),
sf AS (
  SELECT *,
         CASE WHEN total_events > 0 THEN CAST(total_views AS DOUBLE) / total_events ELSE 0 END AS view_ratio,
         CASE WHEN total_events > 0 THEN CAST(total_addtocart AS DOUBLE) / total_events ELSE 0 END
           AS addtocart_ratio,
         CASE WHEN total_views > 0 THEN CAST(total_transactions AS DOUBLE) / total_views ELSE 0 END
           AS transaction_ratio
  FROM sc)"""

_WEIGHT = """CASE event WHEN 'view' THEN 1.0::DOUBLE WHEN 'addtocart' THEN 3.0 WHEN 'transaction' THEN 5.0
     ELSE 0.0 END"""

_FIVE = ", ".join(EVENT_COLUMNS)


def _kinds(column: str, name: str, modulus: tuple[int, ...] | None = None) -> str:
    kinds = zip(("view", "addtocart", "transaction"), modulus or (2**40,) * 3)
    counts = ", ".join(f"CAST(count(*) FILTER (event = '{k}') % {m} AS DOUBLE) AS {k}" for k, m in kinds)
    return f"{name} AS (SELECT {column}, {counts} FROM clicks WHERE {column} IS NOT NULL GROUP BY {column})"


_RANKED = f"""
{_kinds("visitorid", "v")}, {_kinds("itemid", "i", (5, 3, 2))},
scored AS (
  SELECT visitorid, itemid,
         v.view * i.view + v.addtocart * i.addtocart + v.transaction * i.transaction AS rating
  FROM v, i),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY visitorid ORDER BY rating DESC, itemid) AS rank FROM scored)"""

# Five different items that the table has.
_FIVE_ITEMS = "5::BIGINT AS n_items, 5::BIGINT AS n_different, 5::BIGINT AS n_known"

# The model queries' batches: 33 equal ones and a remainder.
_MODEL_BATCHES = f"""
sized AS (SELECT count(*) // {MODEL_BATCHES} AS size FROM clicks),
model_batches AS (
  SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // (SELECT size FROM sized) + 1 AS batch_no FROM clicks)"""


def _in_range(name: str) -> str:
    return "batch_no BETWEEN {} AND {}".format(*MODEL_RANGES[name])


def _scaled(columns: list[str]) -> str:
    return ", ".join(
        f"round(CASE WHEN stddev_samp({c}) OVER () > 0"
        f" THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () ELSE 0 END, 9) + 0.0 AS {c}"
        for c in columns
    )


def _doubles(columns: list[str]) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 9) + 0.0 AS {c}" for c in columns)


def library_sql() -> dict[str, str]:
    """DuckDB SQL for the queries it can express; of fits, it says what must hold."""
    tf = _transaction_features_sql("clicks")
    tf_gaps = _transaction_features_sql("gaps")
    tf_known = _transaction_features_sql("(SELECT * FROM gaps WHERE visitorid IS NOT NULL)")
    complete_range = "WHERE batch_no BETWEEN 2 AND 30 AND NOT is_final"
    return {
        "event_scan": f"WITH {_EVENTS} SELECT {_FIVE} FROM clicks",
        "corrupt_rows": f"""WITH {_EVENTS}
            SELECT count(*) AS n_rows, count(CASE WHEN event = 'view' THEN 1 END) AS n_corrupt FROM clicks""",
        "read_batch_files": f"WITH {_EVENTS}, {_NUMBERED} SELECT {_FIVE} FROM batches {complete_range}",
        "read_batch_range": f"""WITH {_EVENTS}, {_NUMBERED}
            SELECT {_FIVE}, batch_no, is_final FROM batches {complete_range}""",
        "encode_events": f"""WITH {_EVENTS}
            SELECT CAST(to_json({{'timestamp': timestamp, 'visitorid': visitorid, 'event': event,
                                  'itemid': itemid, 'transactionid': transactionid}}) AS VARCHAR) AS value
            FROM clicks""",
        "decode_events": f"WITH {_EVENTS} SELECT {_FIVE} FROM clicks",
        "decode_broken_messages": f"WITH {_EVENTS} SELECT event_id, {_FIVE} FROM clicks WHERE event <> 'signup'",
        "bad_messages": f"""WITH {_EVENTS}
            SELECT event_id, left(CAST(to_json({{'timestamp': timestamp, 'visitorid': visitorid, 'event': event,
                                  'itemid': itemid, 'transactionid': transactionid}}) AS VARCHAR), 20) AS bad_message
            FROM clicks WHERE event = 'signup'""",
        "decode_float_ids": f"WITH {_EVENTS}, {_GAPS} SELECT * FROM gaps",
        "land_topic_partitions": f"""WITH {_EVENTS},
            numbered AS (
              SELECT *, (row_number() OVER (ORDER BY event_id % 60, event_id) - 1) // {BATCH_ROWS} + 1 AS batch_no
              FROM clicks)
            SELECT {_FIVE}, batch_no, count(*) OVER (PARTITION BY batch_no) < {BATCH_ROWS} AS is_final FROM numbered""",
        "stream_landing": f"WITH {_EVENTS}, {_NUMBERED} SELECT {_FIVE}, batch_no, is_final FROM batches",
        "known_events": f"""WITH {_EVENTS}
            SELECT {_FIVE} FROM clicks WHERE event IN ('view', 'addtocart', 'transaction')""",
        "keyed_events": f"""WITH {_EVENTS}, {_GAPS}
            SELECT * FROM gaps WHERE visitorid IS NOT NULL AND itemid IS NOT NULL""",
        "event_weight": f"WITH {_EVENTS} SELECT {_FIVE}, {_WEIGHT} AS weight FROM clicks",
        "ratings": f"""WITH {_EVENTS}
            SELECT visitorid AS visitorid_int, itemid AS itemid_int, {_WEIGHT} AS rating FROM clicks
            WHERE {_WEIGHT} > 0 AND visitorid IS NOT NULL AND itemid IS NOT NULL""",
        "ratings_deduped": f"""WITH {_EVENTS}
            SELECT visitorid AS visitorid_int, itemid AS itemid_int, max({_WEIGHT}) AS rating FROM clicks
            WHERE {_WEIGHT} > 0 AND visitorid IS NOT NULL AND itemid IS NOT NULL GROUP BY 1, 2""",
        "merge_batches": f"""WITH {_EVENTS}
            SELECT {_FIVE} FROM clicks UNION ALL SELECT {_FIVE} FROM clicks""",
        "assign_batches": f"WITH {_EVENTS}, {_NUMBERED} SELECT * FROM batches",
        "assign_batches_by_kind": f"""WITH {_EVENTS},
            numbered AS (
              SELECT *, CAST(length(event) AS INTEGER) AS kind_length,
                     (row_number() OVER (ORDER BY length(event), event_id) - 1) // {BATCH_ROWS} + 1 AS batch_no
              FROM clicks)
            SELECT *, count(*) OVER (PARTITION BY batch_no) < {BATCH_ROWS} AS is_final FROM numbered""",
        "batch_summary": f"""WITH {_EVENTS}, {_NUMBERED}
            SELECT batch_no, is_final, count(*) AS n_rows,
                   printf('batch_%03d%s.csv', batch_no, CASE WHEN is_final THEN '_final' ELSE '' END) AS file_name
            FROM batches GROUP BY batch_no, is_final""",
        "visitor_counts": f"""WITH {_EVENTS}, {tf}, {_SEGMENT_FEATURES}
            SELECT visitorid, num_views, num_addtocart, total_events FROM tf JOIN sc USING (visitorid)""",
        "distinct_items": f"WITH {_EVENTS}, {tf} SELECT visitorid, distinct_items_interacted FROM tf",
        "transaction_label": f"WITH {_EVENTS}, {tf} SELECT visitorid, has_transaction FROM tf",
        "transaction_features": f"WITH {_EVENTS}, {tf} SELECT * FROM tf",
        "transaction_features_with_gaps": f"WITH {_EVENTS}, {_GAPS}, {tf_gaps} SELECT * FROM tf",
        "transaction_features_known_visitors": f"WITH {_EVENTS}, {_GAPS}, {tf_known} SELECT * FROM tf",
        "segment_counts": f"WITH {_EVENTS}, {_SEGMENT_FEATURES} SELECT * FROM sc",
        "segment_features": f"WITH {_EVENTS}, {_SEGMENT_FEATURES} SELECT * FROM sf",
        "assembled_features": f"""WITH {_EVENTS}, {tf}
            SELECT visitorid, {_doubles(TRANSACTION_FEATURES)} FROM tf""",
        "assembled_segment_features": f"""WITH {_EVENTS}, {_SEGMENT_FEATURES}
            SELECT visitorid, {_doubles(SEGMENT_FEATURES)} FROM sf WHERE total_views > 0""",
        "scaled_transaction_features": f"""WITH {_EVENTS}, {tf}
            SELECT visitorid, {_scaled(TRANSACTION_FEATURES)} FROM tf""",
        "scaled_segment_features": f"""WITH {_EVENTS}, {_SEGMENT_FEATURES}
            SELECT visitorid, {_scaled(SEGMENT_FEATURES)} FROM sf""",
        "rank_items": f"""WITH {_EVENTS}, {_RANKED}
            SELECT visitorid, string_agg(itemid, ',' ORDER BY rank) AS items, max(rating) AS best_rating
            FROM ranked WHERE rank <= 20 GROUP BY visitorid""",
        "explode_ranked": f"""WITH {_EVENTS}, {_RANKED}
            SELECT visitorid, rank, itemid, rating FROM ranked WHERE rank <= 5""",
        "unknown_visitors": f"""WITH {_EVENTS}, {_RANKED}
            SELECT visitorid, count(*) AS n_recommendations FROM ranked WHERE rank <= 5 GROUP BY visitorid
            UNION ALL SELECT -max(visitorid), 0 FROM clicks""",
        "recommender_fit": f"""WITH {_EVENTS}
            SELECT count(DISTINCT visitorid) AS n_visitors, count(DISTINCT itemid) AS n_items, true AS beats_mean
            FROM clicks WHERE {_WEIGHT} > 0 AND visitorid IS NOT NULL AND itemid IS NOT NULL""",
        "forest_of_one_class": f"""WITH {_EVENTS}, {tf}
            SELECT visitorid, true AS will_transact, 1.0::DOUBLE AS probability FROM tf""",
        "forest_scores": f"WITH {_EVENTS}, {tf} SELECT visitorid, true AS is_probability, true AS agrees FROM tf",
        "nearest_segment": f"WITH {_EVENTS}, {_SEGMENT_FEATURES} SELECT visitorid, true AS is_nearest FROM sf",
        "segment_users_with_gaps": f"""WITH {_EVENTS}, {_SEGMENT_FEATURES}
            SELECT visitorid, visitorid % 3 = 2 AS has_segment FROM sf""",
        "reloaded_models": f"WITH {_EVENTS}, {tf} SELECT visitorid, true AS same FROM tf",
        "training_ranges": f"""WITH {_EVENTS}, {_MODEL_BATCHES}
            SELECT 'recommender' AS model, count(DISTINCT visitorid) AS n_visitors FROM model_batches
            WHERE {_in_range("recommender")} AND {_WEIGHT} > 0 AND itemid IS NOT NULL
            UNION ALL SELECT 'transaction_predictor', count(DISTINCT visitorid) FROM model_batches
            WHERE {_in_range("transaction_predictor")}
            UNION ALL SELECT 'user_segmentation', count(DISTINCT visitorid) FROM model_batches
            WHERE {_in_range("user_segmentation")}""",
        "loaded_events": f"WITH {_EVENTS} SELECT {_FIVE} FROM clicks WHERE event NOT IN ('signup', 'error')",
        "corrupt_lines": f"""WITH {_EVENTS}
            SELECT concat_ws(',', timestamp, visitorid || CASE WHEN event = 'error' THEN '.5' ELSE '' END, event, itemid)
                   || CASE WHEN event = 'error' THEN ',' ELSE '' END AS line, true AS has_file
            FROM clicks WHERE event IN ('signup', 'error')""",
        "stream_batch_counts": f"""WITH {_EVENTS}
            SELECT CASE WHEN event_id % 3 > 0 THEN 1 ELSE 2 END AS start, count(*) AS n_rows, 0::BIGINT AS n_bad
            FROM clicks GROUP BY 1""",
        "stream_features_exact": f"WITH {_EVENTS}, {tf} SELECT * FROM tf",
        "stream_features_approximate": f"WITH {_EVENTS}, {tf} SELECT * FROM tf",
        "stream_segment_features": f"WITH {_EVENTS}, {_SEGMENT_FEATURES} SELECT * FROM sf",
        "approximate_features": f"WITH {_EVENTS}, {tf} SELECT * FROM tf",
        "merged_features": f"WITH {_EVENTS}, {tf} SELECT * FROM tf",
        "rank_items_pruned": f"""WITH {_EVENTS}, {_RANKED}
            SELECT visitorid, itemid, rating FROM ranked WHERE rank <= 5""",
        "rank_unseen": f"""WITH {_EVENTS}, {_RANKED},
            left_over AS (
              SELECT visitorid, itemid, rating, row_number() OVER (PARTITION BY visitorid ORDER BY rating DESC, itemid) AS place
              FROM ranked ANTI JOIN (SELECT visitorid, itemid FROM clicks WHERE event = 'transaction') USING (visitorid, itemid))
            SELECT visitorid, itemid, rating FROM left_over WHERE place <= 10""",
        "numbered_ids": f"""WITH {_EVENTS}
            SELECT 'visitors' AS side, count(DISTINCT visitorid) AS n_ids, 0 AS least,
                   CAST(count(DISTINCT visitorid) - 1 AS INTEGER) AS greatest FROM clicks
            UNION ALL SELECT 'items', count(DISTINCT itemid), 0, CAST(count(DISTINCT itemid) - 1 AS INTEGER) FROM clicks""",
        "restored_ids": f"""WITH {_EVENTS}
            SELECT timestamp, CAST(visitorid + {2**40} AS VARCHAR) AS visitorid, event, 'item-' || itemid AS itemid, transactionid
            FROM clicks""",
        "recommend_text_ids": f"""WITH {_EVENTS}
            SELECT CAST(visitorid + {2**40} AS VARCHAR) AS visitorid, {_FIVE_ITEMS}, true AS falls FROM clicks GROUP BY visitorid""",
        "recommended_shape": f"""WITH {_EVENTS}
            SELECT visitorid, {_FIVE_ITEMS}, true AS falls FROM clicks GROUP BY visitorid
            UNION ALL SELECT -max(visitorid), 0, 0, 0, true FROM clicks""",
        "unseen_shape": f"""WITH {_EVENTS}
            SELECT visitorid, least(20, (SELECT count(DISTINCT itemid) FROM clicks WHERE {_WEIGHT} > 0)
                   - count(DISTINCT itemid) FILTER (event = 'transaction')) AS n_items, 0::BIGINT AS n_had
            FROM clicks GROUP BY visitorid
            HAVING count(*) FILTER ({_WEIGHT} > 0) > 0 AND n_items > 0""",
        "exploded_ranks": f"""WITH {_EVENTS}
            SELECT visitorid, unnest(range(1, 6)) AS rank FROM clicks GROUP BY visitorid""",
        "segmented_users": f"""WITH {_EVENTS}
            SELECT visitorid, true AS in_range, 5::BIGINT AS n_segments FROM clicks GROUP BY visitorid""",
        "trained_scores": f"""WITH {_EVENTS}, {_MODEL_BATCHES},
            known AS (
              SELECT DISTINCT visitorid FROM model_batches
              WHERE {_in_range("recommender")} AND {_WEIGHT} > 0 AND itemid IS NOT NULL)
            SELECT visitorid, true AS decided, true AS has_segment,
                   CASE WHEN visitorid IN (SELECT visitorid FROM known) THEN 3::BIGINT ELSE 0 END AS n_recommendations
            FROM clicks GROUP BY visitorid""",
        "empty_ranges": f"""WITH {_EVENTS}, {_MODEL_BATCHES}
            SELECT model, (SELECT count(*) FROM model_batches WHERE batch_no > 1000) AS n_events,
                   false AS was_fitted, false AS was_loaded, true AS has_warning
            FROM (SELECT unnest({list(MODEL_RANGES)}) AS model)""",
        "model_warnings": f"""WITH {_EVENTS}
            SELECT model, model = 'user_segmentation' AS was_loaded,
                   CASE WHEN model = 'user_segmentation' THEN 0::BIGINT ELSE 1 END AS n_warnings
            FROM (SELECT unnest({list(MODEL_RANGES)}) AS model) WHERE (SELECT count(*) FROM clicks) > 0""",
    }


# The operators on training text stand apart: without their package the rest works as before.

try:
    from clickloom.llm.queries import ORACLE_SQL as _TEXT_SQL
    from clickloom.llm.queries import QUERIES as _TEXT_QUERIES
except ImportError:
    _TEXT_SQL, _TEXT_QUERIES = {}, {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return library_queries() | _TEXT_QUERIES


def oracle_sql() -> dict[str, str]:
    return library_sql() | _TEXT_SQL
