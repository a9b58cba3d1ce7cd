"""Command line: ``python -m tapewright <job> [options]``."""

from __future__ import annotations

import argparse
import dataclasses
import logging

from tapewright.config import Settings
from tapewright.plans import jobs
from tapewright.session import build_session, for_streams
from tapewright.sources.streams import DEFAULT_SERVERS, DEFAULT_TOPIC, line_stream, topic_stream
from tapewright.streaming.jobs import keyed_message_records, run_bounded, windowed_records
from tapewright.streaming.monitor import ProgressLog
from tapewright.streaming.sinks import start_console_sink, start_table_sink, start_topic_sink


def add_settings(parser: argparse.ArgumentParser, *names: str) -> None:
    defaults = {f.name: f.default for f in dataclasses.fields(Settings)}
    for name in names:
        parser.add_argument(f"--{name}", type=type(defaults[name]), default=defaults[name])


def settings_of(args: argparse.Namespace) -> Settings:
    known = {f.name for f in dataclasses.fields(Settings)}
    return Settings(**{k: v for k, v in vars(args).items() if k in known})


def add_layout(parser: argparse.ArgumentParser) -> None:
    for field in dataclasses.fields(jobs.Layout):
        parser.add_argument(f"--{field.name}_dir", default=field.default)
    parser.add_argument("--form", choices=["parquet", "csv"], default="parquet")


def layout_of(args: argparse.Namespace) -> jobs.Layout:
    names = [f.name for f in dataclasses.fields(jobs.Layout)]
    return jobs.Layout(**{n: getattr(args, f"{n}_dir") for n in names})


# Option names here and below.
def add_source(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--bootstrap_servers", default=DEFAULT_SERVERS)
    parser.add_argument("--topic", default=DEFAULT_TOPIC)
    parser.add_argument("--input_dir", help="read text files from here instead of a topic")
    parser.add_argument("--max_offsets", type=int, help="most records per batch")
    parser.add_argument("--min_partitions", type=int, help="least read tasks per batch")
    parser.add_argument("--available_now", action="store_true", help="read what is there, then end")
    parser.add_argument("--duration_seconds", type=float, default=0, help="0: no limit")
    parser.add_argument("--max_events", type=int, default=0, help="0: no limit")
    parser.add_argument("--log_every", type=int, default=1, help="log progress every n batches")
    add_settings(parser, "trigger_seconds")
    parser.add_argument("--shuffle_partitions", type=int, help="state partitions; fixed by the first start")
    parser.add_argument("--state_store", choices=["rocksdb", "memory"], default="rocksdb")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tapewright")
    root.add_argument("--master", help="Spark master, if spark-submit does not set it")
    commands = root.add_subparsers(dest="job", required=True)

    stream = commands.add_parser("stream", help="records to flagged windows")
    add_source(stream)
    stream.add_argument("--sink", choices=["csv", "parquet", "console"], default="csv")
    stream.add_argument("--out_path", default=jobs.Layout.windows)
    stream.add_argument("--checkpoint_path", default="data/stream/checkpoints/agg")
    stream.add_argument("--drop_repeats", action="store_true")
    add_settings(
        stream, "window_seconds", "watermark_seconds", "spread_threshold_pct",
        "large_trade_value", "high_trade_count",
    )

    normalize = commands.add_parser("normalize", help="exchange messages to keyed records")
    add_source(normalize)
    normalize.add_argument("--out_topic", help="topic for the records; else files below --out_path")
    normalize.add_argument("--out_path", default="data/stream/records")
    normalize.add_argument("--checkpoint_path", default="data/stream/checkpoints/records")

    generate = commands.add_parser("generate", help="synthetic records with faults")
    add_layout(generate)
    generate.add_argument("--per_symbol", type=int, default=2000)

    for name, text in {
        "clean": "newest raw file to cleaned trades", "zscore": "rolling z-scores",
        "forest": "Isolation Forest scores", "run-all": "clean, then both scorings",
        "report": "summary and chart datasets", "dashboard": "dashboard document",
        "stream-report": "chart datasets of window rows",
    }.items():
        job = commands.add_parser(name, help=text)
        add_layout(job)
        job.add_argument("--input", help="use this input instead of the newest one")
        add_settings(job, "z_window", "z_threshold", "contamination")
        if name == "stream-report":
            job.add_argument("--symbols", default=jobs.DEFAULT_SYMBOLS)
    return root


def run_stream(spark, args) -> None:
    settings = settings_of(args)
    if args.input_dir:
        source = line_stream(spark, args.input_dir).selectExpr(
            "value", "current_timestamp() AS timestamp"
        )
    else:
        source = topic_stream(
            spark, args.topic, args.bootstrap_servers, args.max_offsets, args.min_partitions
        )
    now = args.available_now
    if args.job == "stream":
        rows = windowed_records(source, settings, args.drop_repeats, observe=True)
        if args.sink == "console":
            query = start_console_sink(rows, settings, now)
        else:
            query = start_table_sink(
                rows, args.out_path, args.checkpoint_path, args.sink, settings, now
            )
    else:
        keyed = keyed_message_records(source)
        if args.out_topic:
            query = start_topic_sink(
                keyed, args.out_topic, args.bootstrap_servers, args.checkpoint_path, settings, now
            )
        else:
            query = start_table_sink(
                keyed, args.out_path, args.checkpoint_path, settings=settings, available_now=now
            )
    read = run_bounded(query, args.duration_seconds, args.max_events)
    print(f"{read} rows read")


def run_batch(spark, args) -> None:
    layout = layout_of(args)
    if args.job == "generate":
        print(jobs.generate_job(spark, layout, args.per_symbol))
        return
    settings = settings_of(args)
    if args.job == "clean":
        made = jobs.clean_job(spark, layout, settings, args.input, args.form)
    elif args.job == "zscore":
        made = jobs.zscore_job(spark, layout, settings, args.input, args.form)
    elif args.job == "forest":
        made = jobs.forest_job(spark, layout, settings, args.input, args.form)
    elif args.job == "run-all":
        made = jobs.offline_pipeline(spark, layout, settings, args.input, args.form)
    elif args.job == "report":
        made = jobs.batch_report(spark, layout, settings, args.input, args.form)
    elif args.job == "stream-report":
        made = jobs.stream_report(spark, layout, settings, args.symbols, args.form)
    else:
        made = jobs.payload_job(spark, layout, settings)
    print(made)


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    args = parser().parse_args(argv)
    spark = build_session(f"tapewright-{args.job}", args.master)
    if args.job in ("stream", "normalize"):
        for_streams(spark, args.shuffle_partitions, args.state_store == "rocksdb")
        spark.streams.addListener(ProgressLog(args.log_every))
        run_stream(spark, args)
    else:
        run_batch(spark, args)


if __name__ == "__main__":
    main()
