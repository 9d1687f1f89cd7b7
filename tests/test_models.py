"""Models are checked by what must hold for any fit: bounds, brute force over the fitted numbers, reloads."""

import logging
from functools import partial

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F
from tables_at import TESTDATA

from clickloom import operators as ops
from clickloom import plans, sources
from clickloom.schema import EVENT_SCHEMA, SEGMENT_FEATURES, TRANSACTION_FEATURES
from clickloom.sources.model_store import model_path
from clickloom.sources.tables import clickstream

SF = f"{TESTDATA}/sf0.01"
REQUEST = "visitorid string, " + ", ".join(f"{c} long" for c in TRANSACTION_FEATURES)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "t")
    sources.land_batches(clickstream(spark, SF, ["event_id"]), path, "event_id", 300)
    return path


@pytest.fixture(scope="module")
def observed(spark, table):
    return ops.ratings(sources.read_batches(spark, table, 1, 3)).cache()


@pytest.fixture(scope="module")
def recommender(observed):
    return plans.fit_recommender(observed)


@pytest.fixture(scope="module")
def visitors(spark, table):
    return ops.transaction_features(sources.read_batches(spark, table, 4, 6)).cache()


@pytest.fixture(scope="module")
def predictor(visitors):
    return plans.fit_transaction_predictor(visitors)


@pytest.fixture(scope="module")
def behaviour(spark, table):
    return ops.segment_features(sources.read_batches(spark, table, 7, 9)).cache()


@pytest.fixture(scope="module")
def segments(behaviour):
    return plans.fit_segments(behaviour)


# recommender


def test_recommender_fits_better_than_the_mean(observed, recommender):
    rmse = RegressionEvaluator(labelCol="rating", predictionCol="prediction")
    fitted = rmse.evaluate(recommender.transform(observed))
    mean = observed.agg(F.avg("rating")).first()[0]
    assert fitted < rmse.evaluate(observed.withColumn("prediction", F.lit(mean)))
    assert recommender.rank == 10
    assert recommender.userFactors.count() == observed.select("visitorid_int").distinct().count()
    assert recommender.itemFactors.filter(F.exists("features", lambda x: x < 0)).isEmpty()


def test_recommendations_are_the_best_of_all_items(spark, observed, recommender):
    users = observed.select(F.col("visitorid_int").alias("visitorid")).distinct()
    items = recommender.itemFactors.toPandas()
    item_matrix = np.stack(items.features)
    user_vectors = {r.id: np.array(r.features) for r in recommender.userFactors.collect()}
    for row in ops.recommend(recommender, users, 4).collect():
        best = np.sort(item_matrix @ user_vectors[row.visitorid])[::-1][:4]
        assert [r.rating for r in row.recommendations] == pytest.approx(best, rel=1e-4)
        assert len({r.itemid for r in row.recommendations}) == 4


@pytest.fixture(scope="module")
def tied(spark):
    """Small integer factors, so that most scores are tied, and a brute-force ranking."""
    visitors = [(v, [float(v % 3), float(v % 2), 1.0]) for v in range(40)]
    items = [(i * 7 % 201, [float(i % 2), 0.0, float(i % 4)]) for i in range(201)]

    def best(k):
        out = {}
        for v, f in visitors:
            scored = sorted((-sum(a * b for a, b in zip(f, g)), i) for i, g in items)
            out[v] = [(i, -s) for s, i in scored[:k]]
        return out

    columns = "id int, features array<float>"
    return spark.createDataFrame(visitors, columns), spark.createDataFrame(items, columns), best


@pytest.mark.parametrize("k", [1, 7, 20])
@pytest.mark.parametrize("per_block", [(4096, 4096), (7, 110), (40, 5), (1, 1)])
def test_ties_rank_alike_in_any_blocks(tied, k, per_block):
    visitors, items, best = tied
    ranked = ops.rank_items(visitors, items, k, *per_block).collect()
    assert {r.id: [tuple(x) for x in r.ranked] for r in ranked} == best(k)


def test_ratings_do_not_depend_on_blocks(recommender):
    sides = recommender.userFactors, recommender.itemFactors
    whole = sorted(ops.rank_items(*sides, 5).collect())
    assert whole == sorted(ops.rank_items(*sides, 5, 3, 11).collect())


def test_ranking_nothing(spark, tied):
    visitors, items, _ = tied
    assert ops.rank_items(visitors, items.limit(0), 3).collect() == []
    assert ops.rank_items(visitors.limit(0), items, 3).collect() == []


def test_ranking_is_an_equi_join(tied):
    visitors, items, _ = tied
    plan = ops.rank_items(visitors, items, 3, 10, 50)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_ids_of_any_type_are_asked_for(spark, observed, recommender):
    known = observed.first().visitorid_int
    users = spark.createDataFrame([(str(known),), ("guest-1",), (None,)], "visitorid string")
    got = {r.visitorid: len(r.recommendations) for r in ops.recommend(recommender, users, 3).collect()}
    assert got == {str(known): 3, "guest-1": 0, None: 0}


def test_blocks_depend_on_nothing_else(spark, observed, monkeypatch, caplog):
    from clickloom.plans import training

    asked = []

    class Recorded(training.ALS):
        def fit(self, rows):
            asked.append((self.getNumUserBlocks(), self.getNumItemBlocks()))

    monkeypatch.setattr(training, "ALS", Recorded)
    monkeypatch.setattr(training, "MANY_RATINGS_PER_BLOCK", 10)
    with caplog.at_level(logging.WARNING):
        plans.fit_recommender(observed.limit(20))
        assert not caplog.records
        plans.fit_recommender(observed)
        assert any("ratings to a block" in r.getMessage() for r in caplog.records)
    plans.fit_recommender(observed, blocks=3)
    assert asked == [(10, 10), (10, 10), (3, 3)]


def test_fewer_items_than_asked_for(spark, events):
    df = events((1, 1, "view", 7), (2, 1, "transaction", 8, 5), (3, 2, "view", 7), (4, 2, "addtocart", 9))
    model = plans.fit_recommender(ops.ratings(df))
    (row,) = ops.recommend(model, spark.createDataFrame([(1,)], "visitorid int"), 20).collect()
    assert {r.itemid for r in row.recommendations} == {7, 8, 9}


def test_unknown_visitor_gets_an_empty_array(spark, observed, recommender):
    known = observed.first().visitorid_int
    users = spark.createDataFrame([(known, "a"), (known, "b"), (-5, "c"), (None, "d")], "visitorid int, request string")
    got = {r.request: r.recommendations for r in ops.recommend(recommender, users).collect()}
    assert len(got["a"]) == 5 and got["a"] == got["b"]
    assert got["c"] == [] and got["d"] == []
    ranked = ops.explode_recs(ops.recommend(recommender, users, 2))
    assert ranked.columns == ["visitorid", "request", "rank", "itemid", "rating"]
    assert sorted((r.request, r.rank) for r in ranked.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_ids_wider_than_the_model_are_unknown(spark, recommender):
    users = spark.createDataFrame([(2**40,)], "visitorid long")
    assert ops.recommend(recommender, users).first().recommendations == []


@pytest.mark.parametrize("k", [0, 21])
def test_number_of_recommendations_has_bounds(spark, recommender, k):
    with pytest.raises(ValueError):
        ops.recommend(recommender, spark.createDataFrame([(1,)], "visitorid int"), k)


def test_repeats_weigh_more(spark):
    """Fitting repeated pairs is not fitting their maximum."""
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(8) for i in range(8)]
    rows += [(1, 1, 5.0), (1, 1, 1.0), (1, 1, 1.0)]
    repeated = spark.createDataFrame(rows, "visitorid_int int, itemid_int int, rating double")
    merged = repeated.groupBy("visitorid_int", "itemid_int").agg(F.max("rating").alias("rating"))
    one, other = plans.fit_recommender(repeated), plans.fit_recommender(merged)
    pair = repeated.limit(1).select(F.lit(1).alias("visitorid_int"), F.lit(1).alias("itemid_int"))
    assert one.transform(pair).first().prediction != pytest.approx(other.transform(pair).first().prediction, rel=1e-3)


# transaction predictor


def test_predictor_ranks_better_than_chance(visitors, predictor):
    scored = predictor.transform(visitors)
    auc = BinaryClassificationEvaluator(labelCol="has_transaction", rawPredictionCol="probability").evaluate(scored)
    assert auc > 0.5
    assert predictor.stages[2].getNumTrees == 50


def test_scores_of_requests(spark, predictor):
    rows = [("heavy", 120, 7, 45), ("casual", 5, 0, 3), ("plain", 15, 2, 8)]
    scored = ops.score_transactions(predictor, spark.createDataFrame(rows, REQUEST))
    assert scored.dtypes == [("visitorid", "string"), ("will_transact", "boolean"), ("probability", "double")]
    got = {r.visitorid: r for r in scored.collect()}
    assert set(got) == {"heavy", "casual", "plain"}
    for r in got.values():
        assert 0 <= r.probability <= 1 and r.will_transact == (r.probability > 0.5)
    assert got["heavy"].probability > got["casual"].probability


@pytest.mark.parametrize("label, probability", [(0, 0.0), (1, 1.0)])
def test_one_class_only(spark, visitors, label, probability):
    model = plans.fit_transaction_predictor(visitors.withColumn("has_transaction", F.lit(label)))
    scored = ops.score_transactions(model, visitors.drop("has_transaction")).collect()
    assert {(r.will_transact, r.probability) for r in scored} == {(bool(label), probability)}


def test_same_seed_same_scores(visitors, predictor):
    again = plans.fit_transaction_predictor(visitors)
    plain = visitors.drop("has_transaction")
    assert sorted(ops.score_transactions(again, plain).collect()) == sorted(ops.score_transactions(predictor, plain).collect())


# segmentation


def test_each_visitor_is_in_the_nearest_segment(behaviour, segments):
    centres = np.array(segments.stages[2].clusterCenters())
    assert len(centres) == 5
    scaled = ops.scaled_features(behaviour, SEGMENT_FEATURES, "skip").select("visitorid", "features")
    chosen = {r.visitorid: r.cluster_id for r in ops.segment_users(segments, behaviour).collect()}
    rows = scaled.collect()
    assert len(rows) == len(chosen) == behaviour.count()
    for r in rows:
        distances = np.linalg.norm(centres - r.features.toArray(), axis=1)
        assert distances[chosen[r.visitorid]] == pytest.approx(distances.min())


def test_ratios_are_computed_only_if_not_given(behaviour, segments):
    whole = ops.segment_users(segments, behaviour)
    counts_only = ops.segment_users(segments, behaviour.drop("view_ratio", "addtocart_ratio", "transaction_ratio"))
    assert whole.columns == counts_only.columns == ["visitorid", "cluster_id"]
    assert dict(whole.dtypes)["cluster_id"] == "int"
    assert sorted(whole.collect()) == sorted(counts_only.collect())


def test_every_row_comes_back_and_single_ratios_are_computed(behaviour, segments):
    whole = {r.visitorid: r.cluster_id for r in ops.segment_users(segments, behaviour).collect()}
    partly = behaviour.drop("addtocart_ratio")
    assert {r.visitorid: r.cluster_id for r in ops.segment_users(segments, partly).collect()} == whole
    gaps = behaviour.withColumns(
        {
            "total_views": F.when(F.col("visitorid") % 3 != 0, F.col("total_views")),
            "view_ratio": F.when(F.col("visitorid") % 3 != 1, F.col("view_ratio")).otherwise(F.lit(float("nan"))),
        }
    )
    got = {r.visitorid: r.cluster_id for r in ops.segment_users(segments, gaps).collect()}
    assert got == {v: c if v % 3 == 2 else None for v, c in whole.items()}


def test_segments_of_requests(spark, segments):
    rows = [
        ("plain", 60, 45, 6, 3, 0.75, 0.10, 0.0667),
        ("loyal", 500, 350, 50, 25, 0.7, 0.1, 0.0714),
        ("window", 150, 140, 2, 0, 0.933, 0.013, 0.0),
    ]
    types = ["visitorid string"] + [f"{c} {'double' if 'ratio' in c else 'long'}" for c in SEGMENT_FEATURES]
    got = ops.segment_users(segments, spark.createDataFrame(rows, ", ".join(types))).collect()
    assert {r.visitorid for r in got} == {"plain", "loyal", "window"}
    assert all(0 <= r.cluster_id < 5 for r in got)


def test_fewer_points_than_segments(events):
    df = events((1, 1, "view", 1), (2, 2, "addtocart", 1), (3, 3, "view", 1), (4, 3, "transaction", 1, 9))
    model = plans.fit_segments(ops.segment_features(df))
    assert len(model.stages[2].clusterCenters()) <= 3


# all of them


def test_nothing_to_fit(spark):
    none = spark.createDataFrame([], EVENT_SCHEMA)
    assert plans.fit_recommender(ops.ratings(none)) is None
    assert plans.fit_transaction_predictor(ops.transaction_features(none)) is None
    assert plans.fit_segments(ops.segment_features(none)) is None


def test_training_saves_what_loads(spark, table, visitors, behaviour, tmp_path):
    store = str(tmp_path / "models")
    ranges = {"recommender": (1, 3), "transaction_predictor": (4, 6), "user_segmentation": (7, 9)}
    fitted = plans.train_all(partial(sources.read_batches, spark, table), store, ranges)
    loaded, warnings = sources.load_models(store)
    assert set(loaded) == set(fitted) == set(ranges) and not warnings
    plain = visitors.drop("has_transaction")
    for score, name, rows in [
        (ops.score_transactions, "transaction_predictor", plain),
        (ops.segment_users, "user_segmentation", behaviour),
    ]:
        assert sorted(score(loaded[name], rows).collect()) == sorted(score(fitted[name], rows).collect())
    before, after = (
        {(r.visitorid, r.rank): r.rating for r in ops.explode_recs(ops.recommend(m["recommender"], plain)).collect()}
        for m in (fitted, loaded)
    )
    assert after == pytest.approx(before, rel=1e-6)
    sources.save_model(fitted["user_segmentation"], model_path(store, "user_segmentation"))  # overwrites


def test_training_skips_empty_ranges(spark, table, tmp_path, caplog):
    store = str(tmp_path / "models")
    ranges = {"recommender": (500, 600), "user_segmentation": (7, 9)}
    with caplog.at_level(logging.WARNING):
        fitted = plans.train_all(partial(sources.read_batches, spark, table), store, ranges)
    assert fitted["recommender"] is None and fitted["user_segmentation"] is not None
    assert any("no data for recommender" in r.getMessage() for r in caplog.records)


def test_missing_and_broken_models_are_warnings(spark, segments, tmp_path):
    store = str(tmp_path / "models")
    sources.save_model(segments, model_path(store, "user_segmentation"))
    broken = tmp_path / "models" / "transaction_predictor_model_v1"
    broken.mkdir()
    (broken / "metadata").write_text("not a model")
    models, warnings = sources.load_models(store)
    assert set(models) == {"user_segmentation"}
    assert len(warnings) == 2


def test_inputs_are_released_after_a_failed_fit(spark):
    columns = "num_views long, num_addtocart long, distinct_items_interacted long, has_transaction int"
    bad = spark.createDataFrame([(None, 1, 1, 1)], columns)
    with pytest.raises(Exception):
        plans.fit_transaction_predictor(bad)
    assert not bad.is_cached
