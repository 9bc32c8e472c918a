"""The batch job from the command line (the source job's ``main``):

    python -m ledgerline --csv RAW --processed DIR --reports DIR [--rejects DIR]
                         [--staging DIR] [--load-jdbc] [--jdbc-table NAME]
                         [--jdbc-connections N] [--jdbc-package COORDINATES] [--jdbc-driver CLASS]

ingest -> clean -> transform -> validate -> processed table -> reports, then
the optional warehouse load (also switched on by ``LOAD_TO_MYSQL=true``; the
connection comes from ``MYSQL_HOST`` ... ``MYSQL_PASSWORD``, see
``sinks.jdbc.connection_from_env``). Prints one JSON line with the stage
reports and the elapsed seconds. Uses the active Spark session if there is
one (then leaves it running), otherwise creates one and stops it at the end.
"""

from __future__ import annotations

import argparse
import contextlib
import json
import logging
import os
import time

from pyspark.sql import SparkSession

from ledgerline.plans import pipeline
from ledgerline.session import get_session
from ledgerline.sinks import jdbc


def env_flag(name: str) -> bool:
    return os.environ.get(name, "").strip().casefold() in ("true", "1", "yes")


@contextlib.contextmanager
def job_session(packages: list[str]):
    """The active session, or one that ends with the job."""
    given = SparkSession.getActiveSession()
    spark = given or get_session("ledgerline-job", packages=packages)
    try:
        yield spark
    finally:
        if given is None:
            spark.stop()


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m ledgerline", description=__doc__.split("\n\n")[0])
    p.add_argument("--csv", required=True, help="raw CSV file(s) with a header line")
    p.add_argument("--processed", required=True, help="output folder of the processed table")
    p.add_argument("--reports", required=True, help="output folder of the report CSVs")
    p.add_argument("--rejects", help="output folder of malformed lines (default: beside the processed table; written only if any)")
    p.add_argument("--staging", help="folder of the typed staging table (default: shared checkpoint folder)")
    p.add_argument("--load-jdbc", action="store_true", default=env_flag("LOAD_TO_MYSQL"))
    p.add_argument("--jdbc-table", default="retail_sales_processed")
    p.add_argument("--jdbc-connections", type=int, default=jdbc.CONNECTIONS, help="database connections at a time")
    p.add_argument("--jdbc-package", default="com.mysql:mysql-connector-j:8.4.0",
                   help="driver to fetch when the load is asked for; empty if the cluster has one")
    p.add_argument("--jdbc-driver", default="com.mysql.cj.jdbc.Driver")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> dict:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    packages = [args.jdbc_package] if args.load_jdbc and args.jdbc_package else []
    began = time.monotonic()
    with job_session(packages) as spark:
        res = pipeline.run(spark, csv_path=args.csv, processed_path=args.processed, reports_dir=args.reports,
                           rejects_path=args.rejects, staging_path=args.staging, jdbc_load=load_options(args))
        summary = {"ingest": res.ingest_counts, "rejects": res.rejects_path, "cleaning": res.cleaning_stats,
                   "validation": res.validation_report, "sales_kpis": res.reports["sales_kpis"].first().asDict(),
                   "exported": res.exported}
    summary["seconds"] = round(time.monotonic() - began, 1)
    print(json.dumps(summary, default=str))
    return summary


def load_options(args: argparse.Namespace) -> dict | None:
    if not args.load_jdbc:
        return None
    conn = jdbc.connection_from_env()
    return {"url": jdbc.mysql_url(conn), "table": args.jdbc_table, "user": conn["user"], "password": conn["password"],
            "driver": args.jdbc_driver, "num_partitions": args.jdbc_connections}


if __name__ == "__main__":
    main()
