"""Command line: ``python -m vintagemart <job> ...``, one job per call."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from vintagemart.plans import medallion, monitoring, scoring, training
from vintagemart.plans.lake import Lake
from vintagemart.session import get_spark
from vintagemart.sources import store
from vintagemart.sources.scratch import release


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="vintagemart")
    parser.add_argument("--lake", required=True, help="root folder of the lake")
    parser.add_argument("--shared", help="folder for intermediate tables that all executors see")
    parser.add_argument("--master", help="Spark master, for runs without spark-submit")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: str) -> None:
        sub = jobs.add_parser(name)
        for argument in arguments:
            optional = argument in ("first", "last") and name in ("bronze", "medallion", "user-medallion")
            sub.add_argument(f"--{argument}", required=not optional)

    job("bronze", "raw", "first", "last")
    job("medallion", "raw", "first", "last")
    job("user-medallion", "raw", "first", "last")
    job("train", "cutoff")
    job("score", "first", "last", "prediction-date")
    job("monitor", "baseline", "report-date")
    job("tune", "features", "train-date")
    job("score-version", "features", "version", "first", "last")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = get_spark(f"vintagemart-{args.job}", master=args.master, shared_folder=args.shared)
    try:
        _run(args, spark, Lake(args.lake))
    finally:
        release(spark)


def _run(args: argparse.Namespace, spark: SparkSession, lake: Lake) -> None:
    if args.job == "bronze":
        medallion.load_bronze(spark, args.raw, lake, args.first, args.last)
        return
    if args.job.endswith("medallion"):
        run = medallion.run if args.job == "medallion" else medallion.run_user
        run(spark, args.raw, lake, args.first, args.last)
        print(lake.path("audit", ""))
        return
    if args.job == "tune":
        labels = store.read_snapshots(spark, lake.path("gold", "label_store"))
        clicks = store.read_snapshots(spark, args.features)
        tuned = training.train_from_label_store(labels, clicks, args.train_date)
        print(training.save_tuned(spark, lake, tuned))
        return
    if args.job == "score-version":
        clicks = store.read_snapshots(spark, args.features)
        scoring.score_version(spark, lake, args.version, clicks, args.first, args.last).show()
        return
    features = store.read_snapshots(spark, lake.path("gold", "feature_store"))
    if args.job == "train":
        print(training.run(spark, lake, features, args.cutoff))
    elif args.job == "score":
        scoring.run(
            spark, lake, features, args.first, args.last, args.prediction_date
        ).show(truncate=False)
    else:
        result = monitoring.run(spark, lake, features, args.baseline, args.report_date)
        result.report.show(truncate=False)


if __name__ == "__main__":
    main()
