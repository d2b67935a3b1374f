"""The jobs from the command line, for `spark-submit` or `python -m gaugeflow`."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow import session
from gaugeflow.operators import synth
from gaugeflow.operators.model import LinearScore
from gaugeflow.plans import jobs
from gaugeflow.sources import documents, endpoint_config
from gaugeflow.sources.messages import Subscription, message_scan, message_stream
from gaugeflow.streaming import runs, sinks


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gaugeflow", description=__doc__)
    parser.add_argument("--config", help="endpoint configuration; the packaged one if not given")
    parser.add_argument("--format", default="kafka", help="format of the messages")
    parser.add_argument("--path", help="folder of the messages, for a file format")
    parser.add_argument(
        "--option", action="append", default=[], metavar="NAME=VALUE", help="option of the format"
    )
    parser.add_argument("--topic", action="append", required=True, help="may be repeated")
    jobs_ = parser.add_subparsers(dest="job", required=True)

    publish = jobs_.add_parser("publish", help="generate labelled records and publish them")
    publish.add_argument("--records", type=int, required=True)
    publish.add_argument("--seed", type=int, default=42)

    for job in ("archive", "consume", "score"):
        stream = jobs_.add_parser(job)
        stream.add_argument("--out", required=True, help="folder of the written tables")
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument(
            "--seconds", type=int, help="run that long; without it, read what there is and end"
        )
        stream.add_argument(
            "--every", metavar="INTERVAL", help="run until stopped, a batch each such as `30 seconds`"
        )
        if job == "score":
            stream.add_argument("--model", required=True)

    train = jobs_.add_parser("train", help="train on messages, or on an archive of them")
    train.add_argument("--archive", help="folder written by the archive job")
    train.add_argument("--model", required=True)
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = session.build_session(f"gaugeflow {args.job}")
    if args.config:
        config = endpoint_config.read_config(spark, args.config)
    else:
        config = endpoint_config.packaged_config()
    options = dict(option.split("=", 1) for option in args.option)

    if args.job == "publish":
        made = None
        for topic in args.topic:
            part = synth.generate(spark, args.records, config, topic, args.seed)
            made = part if made is None else made.unionByName(part)
        jobs.publish(made, args.format, args.path, **options)
    elif args.job == "train":
        trained = jobs.train(jobs.prepare(_training_rows(spark, args, options), config), args.model)
        for name, value in trained.metrics.items():
            print(f"{name}: {value:.3f}")
    else:
        subscription = Subscription(tuple(args.topic))
        messages = message_stream(spark, subscription, args.format, args.path, **options)
        writer = _writer(args, messages, config)
        if args.every:
            runs.run_until_stopped(writer, args.every)
        elif args.seconds is None:
            runs.run_available(writer)
        else:
            runs.run_for(writer, args.seconds)


def _training_rows(spark: SparkSession, args, options: dict[str, str]) -> DataFrame:
    if args.archive:
        archived = documents.scan_collection(spark, "parquet", args.archive)
        return archived.where(F.col("topic").isin(args.topic))
    return message_scan(spark, Subscription(tuple(args.topic)), args.format, args.path, **options)


def _writer(args, messages: DataFrame, config: endpoint_config.EndpointConfig):
    if args.job == "score":
        linear = LinearScore.load(args.model)
        return jobs.score(messages, linear, config, args.out, args.checkpoint)
    if args.job == "archive":
        return jobs.run("archive", messages, config, args.out, args.checkpoint)
    store = sinks.TableSink(f"{args.out}/documents")
    lines = sinks.TableSink(f"{args.out}/lines")
    return jobs.consume(messages, lines, store, args.checkpoint)


if __name__ == "__main__":
    main()
