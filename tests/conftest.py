import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import types as T  # noqa: E402

from clickloom.schema import EVENT_SCHEMA  # noqa: E402
from clickloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "clickloom-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Make an event frame from (timestamp, visitorid, event, itemid[, transactionid]) tuples."""

    def make(*rows):
        return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) for r in rows], EVENT_SCHEMA)

    return make


@pytest.fixture
def numbered_log(spark):
    """n events in order, ten visitors taking turns, with their order column ``event_id``."""

    def make(n, start=0):
        from pyspark.sql import functions as F

        return spark.range(start, start + n).select(
            F.col("id").alias("event_id"),
            F.col("id").alias("timestamp"),
            (F.col("id") % 10).cast("int").alias("visitorid"),
            F.lit("view").alias("event"),
            (F.col("id") % 7).cast("int").alias("itemid"),
            F.lit(None).cast(T.LongType()).alias("transactionid"),
        )

    return make
