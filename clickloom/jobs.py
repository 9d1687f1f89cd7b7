"""The steps from topic to scores as jobs for spark-submit: ``python -m clickloom.jobs <step> ...``.

Tables of events, visitors and scores are Parquet, except for the CSV files the steps name.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from clickloom import operators as ops
from clickloom import plans, sources
from clickloom.plans.training import DEFAULT_BLOCKS, TRAINING_RANGES
from clickloom.schema import BATCH_SIZE
from clickloom.session import get_session
from clickloom.streaming import BAD_COLUMN, land_stream


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    sources.publish_events(sources.read_events_csv(spark, args.csv), args.topic, args.servers)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    how = {"mode": "PERMISSIVE", "bad": BAD_COLUMN} if args.bad_messages else {}
    stream = sources.stream_events(spark, args.servers, args.topic, **how)
    query = land_stream(stream, args.table, args.checkpoint, size=args.size, bad_path=args.bad_messages)
    query.awaitTermination()


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    ranges = {name: tuple(getattr(args, name)) for name in TRAINING_RANGES}
    plans.train_all(_range_reader(spark, args), args.models, ranges, blocks=args.blocks)


def recommend(spark: SparkSession, args: argparse.Namespace) -> None:
    visitors = spark.read.parquet(args.visitors)
    _save(ops.explode_recs(ops.recommend(_model(args, "recommender"), visitors, args.k)), args)


def predict(spark: SparkSession, args: argparse.Namespace) -> None:
    features = ops.transaction_features(_range_reader(spark, args)(*args.batches)).drop("has_transaction")
    _save(ops.score_transactions(_model(args, "transaction_predictor"), features), args)


def segment(spark: SparkSession, args: argparse.Namespace) -> None:
    features = ops.segment_features(_range_reader(spark, args)(*args.batches))
    _save(ops.segment_users(_model(args, "user_segmentation"), features), args)


def _range_reader(spark: SparkSession, args: argparse.Namespace) -> Callable[[int, int], DataFrame]:
    if args.table:
        return partial(sources.read_batches, spark, args.table)
    return partial(sources.read_batch_files, spark, args.files)


def _model(args: argparse.Namespace, name: str):
    models, warnings = sources.load_models(args.models)
    if name not in models:
        raise SystemExit("\n".join(warnings))
    return models[name]


def _save(scores: DataFrame, args: argparse.Namespace) -> None:
    scores.write.parquet(args.out)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom.jobs", description=__doc__)
    steps = parser.add_subparsers(required=True)

    def step(run, *options: str, text: str) -> argparse.ArgumentParser:
        command = steps.add_parser(run.__name__, help=text)
        command.set_defaults(run=run)
        for option in options:
            command.add_argument(f"--{option}", required=True)
        return command

    def with_events(command: argparse.ArgumentParser) -> argparse.ArgumentParser:
        source = command.add_mutually_exclusive_group(required=True)
        source.add_argument("--table", help="landed table")
        source.add_argument("--files", help="folder of batch_001.csv, batch_002.csv, ...")
        return command

    step(publish, "csv", "topic", "servers", text="send a file of events to a topic")
    command = step(land, "servers", "topic", "table", "checkpoint", text="land what a topic has in batches")
    command.add_argument("--size", type=int, default=BATCH_SIZE)
    command.add_argument("--bad-messages", help="table for broken messages, which otherwise stop the job")

    command = with_events(step(train, "models", text="fit and save the three models"))
    command.add_argument("--blocks", type=int, default=DEFAULT_BLOCKS, help="blocks of ratings on either side")
    for name, batches in TRAINING_RANGES.items():
        flag = "--" + name.replace("_", "-")
        command.add_argument(flag, type=int, nargs=2, default=batches, metavar=("FIRST", "LAST"))

    command = step(recommend, "models", "visitors", "out", text="items for each row of a table with visitorid")
    command.add_argument("--k", type=int, default=ops.DEFAULT_RECOMMENDATIONS)
    for run, text in ((predict, "chance of a transaction"), (segment, "segment")):
        command = with_events(step(run, "models", "out", text=f"{text} of each visitor in a range of batches"))
        command.add_argument("--batches", type=int, nargs=2, required=True, metavar=("FIRST", "LAST"))
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(get_session("clickloom"), args)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
