"""Write the physical plans of the heavy paths to docs/PLANS.md.

    python tools/plans.py [sf_dir]

Plans are taken as ``pipeline.run`` executes them: the processed-table write
over the fixture view, then reports over the written table.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Observation, SparkSession  # noqa: E402

from ledgerline.operators import reports, validation  # noqa: E402
from ledgerline.plans import catalog, pipeline, sql_reports  # noqa: E402
from ledgerline.sinks import files  # noqa: E402
from ledgerline.sources import csv_ingest, fixture  # noqa: E402

NOTES = {
    "processed table (fixture view -> dedup with counts -> clean -> transform -> flags)":
        "lineitem and orders are hash-partitioned on the order key for a sort-merge join; "
        "nation x region is broadcast (25 rows); part, and the smaller of orders and customer, are broadcast only because their "
        "scans are under the threshold at this scale. Dedup: hash aggregate on all 13 columns "
        "(partial before the shuffle), then a sort aggregate on the key with partial_min before "
        "its shuffle. The survivors are then rebalanced by order month (the table's partition "
        "column; AQE splits a month above the advisory size), so each write task writes few "
        "month files; CollectMetrics sits above that exchange, in the writing stage, so a re-run "
        "map stage cannot count the cleaning statistics twice.",
    "revenue by category (over the processed table)":
        "Only 4 columns read; partial hash aggregate before the shuffle; no Expand, as ids are "
        "vouched for (unique_ids=True); without that, orders are a distinct count.",
    "revenue by state": "count(DISTINCT customer_id) as the single distinct aggregate: partial "
        "aggregation on (state, customer) before the shuffle, no Expand.",
    "customer summary": "Partial aggregation collapses the guest customer per task; global "
        "range-partitioned sort, written as many files.",
    "top products": "TakeOrderedAndProject: k rows per task reach the driver.",
    "validation report": "Two flags and the key read; one aggregate with a distinct count of the key, "
        "measured on the table as written.",
    "sql delivery": "Filter pushed into the parquet scan; one column read.",
    "csv routing": "Text scan split by file blocks; from_csv per line; no shuffle.",
}


def short(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"file:/\S+", "<path>", line)
        out.append(line if len(line) <= width else line[:width] + " ...")
    return "\n".join(out)


def scan_details(df) -> list[str]:
    """Scan nodes of the formatted plan with what reaches the reader: columns
    read, pushed filters, partition filters."""
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    out, current = [], None
    for line in text.splitlines():
        if re.match(r"^\(\d+\) Scan ", line):
            current = [re.sub(r"^\(\d+\) ", "", line).strip()]
            out.append(current)
        elif current is not None and line.startswith("Location:"):
            m = re.search(r"([^/\[\]]+?)/?\]", line)
            current[0] += f" {m.group(1)}" if m else ""
        elif current is not None and line.startswith(("ReadSchema:", "PushedFilters:", "PartitionFilters:")):
            current.append("  " + re.sub(r"#\d+L?", "", line.strip()))
        elif not line.strip():
            current = None
    return [x for block in out for x in block]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tmp = tempfile.mkdtemp(prefix="plans-")
    processed = pipeline.process(fixture.sales_raw(spark, sf), stats=Observation("c"), cluster_by_month=True)
    path = files.write_processed(processed, f"{tmp}/processed", rebalance=False)
    table = spark.read.schema(processed.schema).parquet(path).select(*processed.columns)
    csv = fixture.write_sales_csv(spark, sf, f"{tmp}/csv")
    frames = {
        "processed table (fixture view -> dedup with counts -> clean -> transform -> flags)": processed,
        "revenue by category (over the processed table)": reports.revenue_by_category(table, unique_ids=True),
        "revenue by state": reports.revenue_by_state(table, unique_ids=True),
        "customer summary": reports.customer_summary(table, unique_ids=True),
        "top products": reports.top_products(table),
        "validation report": validation.validation_report(table),
        "sql delivery": sql_reports.run_sql(spark, "sql_delivery", table),
        "csv routing": csv_ingest.ingest_csv(spark, csv).good,
    }
    assert catalog.QUERIES  # the same building blocks back the registered queries
    lines = ["# Physical plans", "",
             f"Generated by `tools/plans.py` at `{os.path.basename(sf)}` (local[8], 16 shuffle partitions,",
             "AQE on; `isFinalPlan=false`, i.e. before runtime re-planning). Expression ids and paths",
             "are stripped, long lines cut.", ""]
    for title, df in frames.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {title}", "", NOTES[title], "", "```", short(plan), "```", "",
                  "Scans (from `explain(\"formatted\")`):", "", "```", *scan_details(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
