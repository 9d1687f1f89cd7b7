import pytest
from tables_at import TESTDATA

import __spark_entry__ as entry_module

ROWS_ONLY = sorted(set(entry_module.library_queries()) - set(entry_module.library_sql()))


def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "visitorid"


def test_only_models_go_without_sql():
    assert ROWS_ONLY == ["explode_recs", "recommend_topk", "score_transactions", "segment_users", "train_all"]


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_model_queries_cover_every_visitor(spark, name):
    df = entry_module.library_queries()[name](spark, f"{TESTDATA}/sf0.001")
    expected = {"explode_recs": 15 * 5, "recommend_topk": 16}.get(name, 15)
    assert df.count() == expected
