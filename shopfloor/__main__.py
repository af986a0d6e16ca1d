"""Command line: run the end-to-end pipeline.

python -m shopfloor --tables /root/testdata/sf0.01 --root /shared/lake
python -m shopfloor --raw-csv /data/sales.csv --root /shared/lake --jdbc-url jdbc:... --jdbc-driver ...
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

if __package__ in (None, ""):  # run as a script (e.g. by spark-submit): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shopfloor", description="events -> bronze -> silver -> gold -> checks")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", metavar="BROKERS", help="bootstrap servers of the topics (needs the Kafka connector)")
    src.add_argument("--topics", metavar="ROOT", help="folder holding both topics as Kafka-shaped Parquet records")
    src.add_argument("--tables", help="folder of <name>.parquet tables, replayed as events (retail view via the adapter)")
    src.add_argument("--raw-csv", help="raw sales lines as CSV with a header, replayed as events")
    ap.add_argument("--order-topic", default=None, help="topic name, or folder under --topics")
    ap.add_argument("--customer-topic", default=None, help="topic name, or folder under --topics")
    ap.add_argument("--max-offsets-per-trigger", type=int, default=None, help="bound of a micro-batch (Kafka)")
    ap.add_argument("--max-files-per-trigger", type=int, default=None, help="bound of a micro-batch (folders)")
    ap.add_argument("--root", required=True, help="shared storage root for every layer")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--jdbc-url", default=None)
    ap.add_argument("--jdbc-driver", default=None)
    ap.add_argument("--jdbc-user", default=None)
    ap.add_argument("--jdbc-password", default=None)
    ap.add_argument("--fail-on", choices=["FAIL", "WARN"], default=None)
    ap.add_argument("--incremental-silver", action="store_true",
                    help="merge only new bronze into silver (months touched) instead of rebuilding it")
    ap.add_argument("--compact-bronze", action="store_true", help="rewrite the streams' small files before silver is built")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")

    from pyspark.sql import SparkSession

    from shopfloor.plans import flow
    from shopfloor.session import BASE_CONF, build_session

    if args.master:
        spark = build_session(args.master)
    else:
        builder = SparkSession.builder.appName("shopfloor")
        for k, v in BASE_CONF.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    orders, customers = args.order_topic or flow.evt.ORDER_TOPIC, args.customer_topic or flow.evt.CUSTOMER_TOPIC
    raw = None
    if args.kafka:
        source = flow.KafkaTopics(args.kafka, orders, customers, max_offsets_per_trigger=args.max_offsets_per_trigger)
    elif args.topics:
        top = args.topics.rstrip("/")
        source = flow.FolderTopics(f"{top}/{orders}", f"{top}/{customers}", args.max_files_per_trigger)
    else:
        source = flow.FolderTopics(max_files_per_trigger=args.max_files_per_trigger)
        if args.tables:
            from shopfloor.sources import adapter
            from shopfloor.sources.tables import TableSet

            raw = adapter.raw_sales_lines(TableSet(spark, args.tables))
        else:
            from shopfloor.sources.raw import read_raw_sales

            raw = read_raw_sales(spark, args.raw_csv)
    props = {k: v for k, v in (("driver", args.jdbc_driver), ("user", args.jdbc_user),
                               ("password", args.jdbc_password)) if v}
    out = flow.run(spark, raw, args.root, run_id=args.run_id, jdbc_url=args.jdbc_url,
                   jdbc_properties=props, fail_on=args.fail_on, incremental_silver=args.incremental_silver,
                   publish=raw is not None, source=source, compact=args.compact_bronze)
    out.pop("layout", None)
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
