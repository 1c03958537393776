"""Time the headline queries: ``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the cores.

Every query is built and run to the end (all rows and columns, discarded at the sink) once
to warm up and then three times for the median. ``whole_purchases_ingest`` is one run of the
job with all its outputs, as a user runs it. Prints one JSON line.

The given tables are one file of one row group each, which only one task can read; before
anything is timed they are written once as tables of several files, as a table of any size has.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from cashloom.sources.staging import Staging
from workload.queries import QUERIES

HEADLINE = [
    "q1_purchases_ingest_invoices",
    "q2_sales_ingest_invoices",
    "q3_payables_schedule",
    "q4_receivables_schedule",
    "q5_post_payments_history",
    "q6_post_receipts_history",
    "q7_cashflow_initial",
    "q7_cashflow_initial_monthly",
    "q8_cashflow_close",
    "q9_cashflow_current_month_through_unclosed",
    "p5_first_failing_rule",
    "p7_tax_id_valid",
    "p9_domain_membership",
    "p13_clean_with_rejects",
    "j1_unprocessed_only",
    "j3_changed_members",
    "j7_build_invoice_fact",
    "j11_receipts_to_schedule",
    "j12_payments_to_open_schedule",
    "j13_tolerance_band_join",
    "j15_merge_flows_daily",
    "k1_generate_instalments",
    "s7_upsert",
    "s15_assign_surrogate_keys",
    "w1_running_balance_by_party",
]


TABLES = ("orders", "lineitem", "customer", "supplier", "nation")


def in_files(spark: SparkSession, folder: str, files: int) -> str:
    """The tables that the queries read, in a folder of their own, as tables of ``files`` files."""
    made = tempfile.mkdtemp(prefix="bench-")
    for name in TABLES:
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(files).write.parquet(f"{made}/{name}.parquet")
    return made


def whole_ingest(spark: SparkSession, folder: str) -> None:
    """All outputs of one purchase ingest, from one call, with its copies released at the end."""
    from workload.frames import Frames
    from workload.queries import purchases

    with Staging(spark) as stage:
        for output in purchases(Frames(spark, folder), stage=stage):
            if isinstance(output, DataFrame):
                output.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, "whole_purchases_ingest"]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = in_files(spark, folder, 2 * int(cpus))
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(4):  # the first run warms up
            start = time.perf_counter()
            if name == "whole_purchases_ingest":
                whole_ingest(spark, tables)
            else:
                QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cpus,
                "files": 2 * int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
