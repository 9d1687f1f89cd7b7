"""How the operators behave on many rows of which one visitor and one item hold a third.

    python scale_trial.py [copies]

Makes ``copies`` shifted copies of the sf0.1 events (default 200, 20 million rows), gives a
third of all rows to one visitor and a third to one item, and prints for each operator its
time and, over its stages, the largest share of the rows that a single task read from a
shuffle.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from clickloom import operators as ops
from clickloom import sources
from clickloom.schema import EVENT_COLUMNS
from clickloom.session import get_session, scratch_path
from clickloom.sources.tables import clickstream

SF_DIR = "/root/testdata/sf0.1"


def skewed_log(spark, copies: int) -> str:
    base = clickstream(spark, SF_DIR, ["event_id"])
    per_copy = base.count()
    copy = F.col("copy")
    rows = spark.range(copies).withColumnRenamed("id", "copy").repartition(copies).join(F.broadcast(base))
    path = scratch_path(spark, "skewed-log")
    rows.select(
        (F.col("event_id") + copy * per_copy).alias("event_id"),
        # a third of the rows fall into one millisecond
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("timestamp") + copy).alias("timestamp"),
        F.when(F.col("event_id") % 3 == 1, -1).otherwise(F.col("visitorid") + copy * 1500).cast("int").alias("visitorid"),
        "event",
        F.when(F.col("event_id") % 3 == 2, -1).otherwise(F.col("itemid") + copy % 100 * 100).cast("int").alias("itemid"),
        "transactionid",
    ).write.parquet(path)
    return path


def shuffle_tasks(spark, first_stage: int):
    """Per finished stage since ``first_stage``: shuffle records read by all tasks, and by the largest."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway
    every, no_quantiles = gateway.jvm.java.util.ArrayList(), gateway.new_array(gateway.jvm.double, 0)
    stages = store.stageList(every, False, False, no_quantiles, every)
    for i in range(stages.size()):
        stage = stages.apply(i)
        if stage.stageId() < first_stage or stage.status().toString() != "COMPLETE":
            continue
        tasks = store.taskList(stage.stageId(), stage.attemptId(), 100000)
        reads = [
            tasks.apply(j).taskMetrics().get().shuffleReadMetrics().recordsRead() for j in range(tasks.size())
        ]
        if sum(reads):
            yield sum(reads), max(reads)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 200
    spark = get_session(
        "scale-trial",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "64",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",  # to see every task
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = skewed_log(spark, copies)
    log = spark.read.parquet(path)
    events = log.select(*EVENT_COLUMNS)
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    table = scratch_path(spark, "skewed-landed")
    trials = {
        "transaction_features": lambda: noop(ops.transaction_features(events)),
        "segment_features": lambda: noop(ops.segment_features(events)),
        "ratings": lambda: noop(ops.ratings(events)),
        "ratings_deduped": lambda: noop(ops.ratings(events, dedupe="max")),
        "assign_batches": lambda: noop(ops.assign_batches(log, "event_id")),
        "assign_batches_tied": lambda: noop(ops.assign_batches(log, ["timestamp", "event_id"])),
        "land_batches": lambda: sources.land_batches(log, table, ["timestamp", "event_id"]),
        "read_batches": lambda: noop(sources.read_batches(spark, table, 51, 100)),
    }
    print(json.dumps({"rows": log.count(), "tasks_per_shuffle": 64}))
    for name, trial in trials.items():
        first_stage = spark.sparkContext._jsc.sc().dagScheduler().nextStageId()
        start = time.perf_counter()
        trial()
        took = time.perf_counter() - start
        stages = [s for s in shuffle_tasks(spark, first_stage) if s[0] > 10_000]
        print(
            json.dumps(
                {
                    "operator": name,
                    "seconds": round(took, 2),
                    "shuffled_rows": [total for total, _ in stages],
                    "largest_task_share": [round(most / total, 3) for total, most in stages],
                }
            ),
            flush=True,
        )
    spark.stop()


if __name__ == "__main__":
    main()
