"""Command line for the five jobs (``python -m sensorflow <job> ...`` or the
same file under ``spark-submit``). The session comes from the environment
(``getOrCreate``); no master or resource setting is made here.

    ingest        sensor files -> wide table (+ CSV export, + messages)
    ingest-stream new sensor files -> long table, continuously
    train         wide table -> fitted model (+ in-sample / hold-out accuracy)
    publish       table -> key/value messages (file folder or broker topic)
    index-stream  messages -> search documents, one folder per micro-batch
    score-stream  messages -> predictions routed by class
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
import time


def _options(pairs):
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _trigger(args):
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": args.trigger}


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="sensorflow")
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("ingest")
    p.add_argument("--root", required=True)
    p.add_argument("--layout", choices=("folders", "hive"), default="folders")
    p.add_argument("--version", type=int, choices=(1, 2), default=1)
    p.add_argument("--table")
    p.add_argument("--csv")
    p.add_argument("--messages")
    p.add_argument("--messages-format", default="json")
    p.add_argument("--payload-format", choices=("csv", "json"), default="json")
    p.add_argument("--option", action="append", help="writer option key=value")

    p = sub.add_parser("ingest-stream")
    p.add_argument("--root", required=True)
    p.add_argument("--layout", choices=("folders", "hive"), default="folders")
    p.add_argument("--table", required=True)
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--trigger", default="30 seconds")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--checkpoint")

    p = sub.add_parser("train")
    p.add_argument("--table", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--holdout-from", help="ISO date; rows from it on are held out")

    p = sub.add_parser("publish")
    p.add_argument("--input", required=True)
    p.add_argument("--input-format")
    p.add_argument("--sep", default=",")
    p.add_argument("--message-sep", default=",")
    p.add_argument("--format", default="text")
    p.add_argument("--target")
    p.add_argument("--option", action="append", help="writer option key=value")
    p.add_argument("--exclude", nargs="*", default=[])
    p.add_argument("--key", help="column name or position")
    p.add_argument("--repeat", type=int, default=1)
    p.add_argument("--shuffle-seed", type=int)

    for name in ("index-stream", "score-stream"):
        p = sub.add_parser(name)
        p.add_argument("--source-format", required=True)
        p.add_argument("--source")
        p.add_argument("--option", action="append", help="reader option key=value")
        p.add_argument("--target", required=True)
        p.add_argument("--payload-format", choices=("csv", "json"), default="csv")
        p.add_argument("--starting", choices=("latest", "earliest"), default="latest")
        p.add_argument("--max-per-trigger", type=int)
        p.add_argument("--trigger", default="10 seconds")
        p.add_argument("--available-now", action="store_true")
        p.add_argument("--checkpoint")
        p.add_argument("--distinct", action="store_true",
                       help="drop messages equal to one written before")
        if name == "score-stream":
            p.add_argument("--model", required=True)
            p.add_argument("--invalid", choices=("skip", "quarantine"), default="skip")
            p.add_argument("--message-format", help="send predictions as messages: json, kafka ...")
            p.add_argument("--message-option", action="append", help="writer option key=value")
        else:
            p.add_argument("--quarantine", action="store_true")
            p.add_argument("--time-as", choices=("epoch_ms", "timestamp", "text"),
                           default="epoch_ms")
            p.add_argument("--keep-nulls", action="store_true", help="no 0.0 for null readings")
    return ap


def main(argv=None, spark=None) -> int:
    from pyspark.sql import SparkSession

    from sensorflow.streaming.sinks import Totals

    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"sensorflow-{args.job}").getOrCreate()
    t0 = time.time()
    totals = Totals()
    spark.streams.addListener(totals)
    try:
        _run(spark, args, t0, totals)
    finally:
        spark.streams.removeListener(totals)
    return 0


def _run(spark, args, t0, totals) -> None:
    from sensorflow.plans import jobs as J

    if args.job == "ingest":
        res = J.run_ingest(spark, args.root, table_path=args.table, csv_path=args.csv,
                           version=args.version, layout=args.layout,
                           messages_path=args.messages, payload_format=args.payload_format,
                           messages_format=args.messages_format,
                           messages_options=_options(args.option))
        print(json.dumps({"job": "ingest", "table": args.table, "rows": res.rows,
                          "seconds": res.seconds}))
    elif args.job == "ingest-stream":
        q = J.run_long_ingest_stream(spark, args.root, args.table, _trigger(args),
                                     args.checkpoint, args.max_files_per_trigger,
                                     layout=args.layout)
        _finish_stream(q, args, totals)
    elif args.job == "train":
        hold = dt.datetime.fromisoformat(args.holdout_from) if args.holdout_from else None
        res = J.run_training(spark, args.table, args.model, holdout_from=hold)
        print(json.dumps({"job": "train", "rows": res.fit.rows, "skipped": res.fit.skipped_rows,
                          "accuracy_in_sample": res.accuracy_in_sample,
                          "accuracy_holdout": res.accuracy_holdout}))
    elif args.job == "publish":
        key = int(args.key) if args.key and args.key.lstrip("-").isdigit() else args.key
        n = J.run_publish(spark, args.input, args.format, args.target, _options(args.option),
                          sep=args.sep, message_sep=args.message_sep, exclude=args.exclude,
                          key_col=key, repeat=args.repeat, shuffle_seed=args.shuffle_seed,
                          input_format=args.input_format)
        sec = time.time() - t0
        print(json.dumps({"job": "publish", "messages": n, "seconds": round(sec, 3),
                          "rows_per_second": round(n / sec, 1) if sec > 0 else None}))
    else:
        common = dict(source_options=_options(args.option), starting=args.starting,
                      max_per_trigger=args.max_per_trigger, trigger=_trigger(args),
                      checkpoint=args.checkpoint, payload_format=args.payload_format)
        common["distinct"] = args.distinct
        if args.job == "index-stream":
            q, _ = J.run_index_stream(spark, args.source_format, args.source, args.target,
                                      quarantine=args.quarantine, time_as=args.time_as,
                                      fill_value=None if args.keep_nulls else 0.0, **common)
        else:
            q, _ = J.run_scoring_stream(spark, args.model, args.source_format, args.source,
                                        args.target, invalid=args.invalid,
                                        message_format=args.message_format,
                                        message_options=_options(args.message_option), **common)
        _finish_stream(q, args, totals)


def _finish_stream(q, args, totals) -> None:
    """Drain (``--available-now``) or run until stopped, then report every
    batch of the run."""
    from sensorflow.streaming.sinks import run_available
    if args.available_now:
        run_available(q)
    else:
        q.awaitTermination()
    got = totals.of(q)
    rate = round(got["rows"] / got["seconds"], 1) if got["seconds"] > 0 else None
    print(json.dumps({"job": args.job, **got, "rows_per_second": rate}))


if __name__ == "__main__":
    sys.exit(main())
