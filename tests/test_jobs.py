import pytest
from tables_at import TESTDATA

from clickloom import operators as ops
from clickloom import sources
from clickloom.jobs import main
from clickloom.sources.tables import clickstream

SF = f"{TESTDATA}/sf0.001"
RANGES = "--recommender 1 15 --transaction-predictor 16 18 --user-segmentation 19 33".split()


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    events = clickstream(spark, SF, ["event_id"])
    sources.land_batches(events, f"{root}/table", "event_id", 30)
    sources.write_batch_files(ops.assign_batches(events, "event_id", 30), f"{root}/files")
    events.select("visitorid").distinct().write.parquet(f"{root}/visitors")
    main(["train", "--table", f"{root}/table", "--models", f"{root}/models", *RANGES])
    return root


def test_recommending(spark, places):
    main(f"recommend --models {places}/models --visitors {places}/visitors --out {places}/recs --k 3".split())
    recs = spark.read.parquet(f"{places}/recs")
    assert recs.columns == ["visitorid", "rank", "itemid", "rating"]
    assert recs.count() == 3 * recs.select("visitorid").distinct().count()


@pytest.mark.parametrize("step, column", [("predict", "probability"), ("segment", "cluster_id")])
def test_scoring_from_table_and_files(spark, places, step, column):
    for source in ("table", "files"):
        out = f"{places}/{step}-{source}"
        main(f"{step} --models {places}/models --{source} {places}/{source} --batches 1 33 --out {out}".split())
    table, files = (spark.read.parquet(f"{places}/{step}-{s}") for s in ("table", "files"))
    assert column in table.columns and table.count() == 15
    assert sorted(table.collect()) == sorted(files.collect())


def test_training_from_files(spark, places):
    main(["train", "--files", f"{places}/files", "--models", f"{places}/models-too", *RANGES])
    models, warnings = sources.load_models(f"{places}/models-too")
    assert len(models) == 3 and not warnings


def test_missing_model_is_named(places):
    with pytest.raises(SystemExit, match="recommender"):
        main(f"recommend --models {places}/nowhere --visitors {places}/visitors --out {places}/none".split())


def test_steps_need_their_options():
    with pytest.raises(SystemExit):
        main(["land", "--topic", "t"])
