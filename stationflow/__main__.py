"""Jobs from the command line: ``spark-submit`` or ``python -m stationflow <job>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .plans import city, city_table, daily, repair, station, text
from .operators import normalize
from .schemas import CITY_READING_FILE, HOURLY_STATION
from .session import build_session
from .sources import delimited, json_dir_stream, kafka_stream, socket_lines, text_lines
from .streaming import console_options, document_writer, run_for, start_query, to_topic


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stationflow", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str, help: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=help)
        for path in paths:
            added.add_argument(path)
        return added

    def stream(name: str, help: str) -> argparse.ArgumentParser:
        added = job(name, help=help)
        source = added.add_mutually_exclusive_group(required=True)
        source.add_argument("--topic", help="topic to subscribe to (with --servers)")
        source.add_argument("--socket", help="host:port of a line server")
        added.add_argument("--servers", default="localhost:9092")
        added.add_argument("--starting", default="latest", choices=("latest", "earliest"))
        added.add_argument("--max-offsets", type=int, help="messages per micro-batch, at most")
        added.add_argument("--min-partitions", type=int, help="tasks a micro-batch is read by, at least")
        added.add_argument("--seconds", type=float, default=float("inf"), help="stop after")
        return added

    job("text-stats", "source", "target", help="letter and word statistics of text files")
    job("daily", "source", "target", help="daily phenomena of an hourly export, as text")
    fix = job("repair", "source", "target", help="undo number-to-date conversion in an export")
    fix.add_argument("--columns", required=True, help="all column names in order, comma separated")
    fix.add_argument("--repair", default=",".join(repair.REPAIRED), help="columns to repair")
    fix.add_argument("--year", type=int, default=2025)
    load = job("load", "source", "table", help="load nested city-day documents into a table")
    load.add_argument("--on-conflict", default="skip", choices=("skip", "error"))
    job("report", "table", help="report on the loaded table")
    stream("station-stream", "hourly station readings: view and windows")
    stream("city-stream", "city readings: windows")
    files = job("city-files", "source", help="city readings from a growing folder of JSON files")
    files.add_argument("--seconds", type=float, default=float("inf"), help="stop after")
    files.add_argument("--files-per-trigger", type=int, default=1, help="0 for no limit")
    files.add_argument("--every", default="30 seconds", help="time between micro-batches")
    files.add_argument("--drain", action="store_true", help="process what is there, then stop")
    documents = stream("documents", "station readings into a document folder")
    documents.add_argument("--target", required=True)
    classified = stream("classified", "city readings, classified, into a document folder")
    classified.add_argument("--target", required=True)
    publish = job("publish", "source", help="records of a delimited export, normalised, as topic messages")
    publish.add_argument("--columns", required=True, help="all column names in order, comma separated")
    publish.add_argument("--servers", default="localhost:9092")
    publish.add_argument("--topic", required=True)
    publish.add_argument("--key", help="column that becomes the message key")
    return parser


def _messages(spark: SparkSession, args) -> DataFrame:
    return kafka_stream(
        spark, args.servers, args.topic, starting=args.starting, fail_on_loss=False,
        max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions,
    )


def _lines(spark: SparkSession, args) -> DataFrame:
    host, port = args.socket.rsplit(":", 1)
    return socket_lines(spark, host, int(port))


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or build_session(f"stationflow-{args.job}")

    if args.job == "text-stats":
        text.write_statistics(spark, args.source, args.target)
    elif args.job == "daily":
        daily.phenomena_text(text_lines(spark, args.source)).write.mode("overwrite").text(args.target)
    elif args.job == "repair":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in args.columns.split(",")])
        repair.repair(spark, args.source, args.target, schema, args.repair.split(","), args.year)
    elif args.job == "load":
        print(city_table.run(spark, args.source, args.table, args.on_conflict))
    elif args.job == "report":
        table = spark.read.parquet(args.table)
        for name, frame in {**city_table.report(table), **city_table.analysis(table)}.items():
            print(name)
            frame.show(truncate=False)
    elif args.job == "station-stream":
        if args.topic:
            readings = station.station_readings(_messages(spark, args), station.WINDOW_FIELDS)
            shown = station.station_readings(_messages(spark, args), station.VIEW_FIELDS)
            view = start_query(station.station_view(shown), "station-view", "append",
                               options=console_options(5))
            windows = start_query(station.station_windows(readings), "station-windows", "update",
                                  options=console_options(10))
            run_for([view, windows], args.seconds)
        else:
            readings = station.station_line_readings(_lines(spark, args))
            windows = station.station_windows(readings, metrics=station.STATION_LINE_METRICS)
            run_for([start_query(windows, "station-lines", "update", options=console_options())],
                    args.seconds)
    elif args.job == "city-stream":
        if args.topic:
            readings = city.city_messages(_messages(spark, args))
            raw = start_query(readings, "city-raw", "append", options=console_options(5))
            stats = start_query(city.city_broker_windows(readings), "city-statistics", "update",
                                options=console_options(10))
            run_for([raw, stats], args.seconds)
        else:
            windows = city.city_line_windows(city.city_lines(_lines(spark, args)))
            run_for([start_query(windows, "city-lines", "update", options=console_options())],
                    args.seconds)
    elif args.job == "city-files":
        readings = json_dir_stream(
            spark, args.source, CITY_READING_FILE, args.files_per_trigger or None
        )
        timed = readings.withColumn("processing_time", F.current_timestamp())
        every = {"availableNow": True} if args.drain else {"processingTime": args.every}
        queries = [
            start_query(frame, name, mode, trigger=every, options=console_options())
            for name, mode, frame in (
                ("city-running", "complete", city.city_running(readings)),
                ("city-windows", "update", city.city_windows(timed)),
                ("city-overall", "update", city.overall_windows(timed)),
            )
        ]
        run_for(queries, args.seconds)
    elif args.job == "documents":
        rows = (
            station.station_document_rows(_messages(spark, args))
            if args.topic
            else station.station_document_rows(_lines(spark, args))
        )
        run_for([start_query(rows, "documents", sink=document_writer(args.target))], args.seconds)
    elif args.job == "classified":
        rows = (
            city.city_messages(_messages(spark, args), require=("city",))
            if args.topic
            else city.city_lines(_lines(spark, args)).where("city IS NOT NULL")
        )
        sink = document_writer(args.target, shape=city.classified_document)
        run_for([start_query(rows, "classified", sink=sink)], args.seconds)
    elif args.job == "publish":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in args.columns.split(",")])
        records = normalize(delimited(spark, args.source, schema), HOURLY_STATION)
        to_topic(records, args.servers, args.topic, args.key)


if __name__ == "__main__":
    main()
