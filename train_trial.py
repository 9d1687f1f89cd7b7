"""Training at the published size: 1.5 million events in 150 batches, 500,000 rows for each model.

Copies of the sf0.1 events, with their visitors split so that each makes about two events,
are written as 150 CSV batches of 10,000 rows and landed as a table; the three models are
trained from both. Prints seconds for loading, features, fit and save together.
"""

from __future__ import annotations

import json
import time
from functools import partial

from pyspark.sql import functions as F

from clickloom import operators as ops
from clickloom import plans, sources
from clickloom.plans.training import TRAINING_RANGES
from clickloom.session import get_session, scratch_path
from clickloom.sources.tables import clickstream

SF_DIR = "/root/testdata/sf0.1"
COPIES = 15


def main() -> None:
    spark = get_session(
        "train-trial",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = clickstream(spark, SF_DIR, ["event_id"])
    per_copy = base.count()
    copy = F.col("copy")
    log = (
        spark.range(COPIES)
        .withColumnRenamed("id", "copy")
        .join(F.broadcast(base))
        .withColumn("event_id", F.col("event_id") + copy * per_copy)
        .withColumn("visitorid", (F.col("visitorid") * 32 + F.col("event_id") % 32 + copy * 48_000).cast("int"))
        .withColumn("itemid", (F.col("itemid") * 100 + F.col("event_id") % 100).cast("int"))
        .drop("copy")
    )
    start = time.perf_counter()
    table, files = scratch_path(spark, "trial-table"), scratch_path(spark, "trial-files")
    sources.land_batches(log, table, "event_id")
    print(json.dumps({"landed_rows_per_sec": round(COPIES * per_copy / (time.perf_counter() - start))}))
    sources.write_batch_files(ops.assign_batches(log, "event_id"), files)

    for kind, read in (
        ("csv batches", partial(sources.read_batch_files, spark, files)),
        ("landed table", partial(sources.read_batches, spark, table)),
    ):
        took = {}
        for name, batches in TRAINING_RANGES.items():
            start = time.perf_counter()
            plans.train_all(read, scratch_path(spark, "trial-models"), {name: batches})
            took[name] = round(time.perf_counter() - start, 2)
        print(json.dumps({"source": kind, "seconds": took}), flush=True)
    visitors = ops.transaction_features(sources.read_batches(spark, table, 51, 100))
    print(json.dumps({"predictor_label_share": round(visitors.agg(F.avg("has_transaction")).first()[0], 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
