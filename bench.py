"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; its figure is the median,
and the metric is the sum of the medians. Every run computes all rows and columns.
Loading the stored mart and rollup is timed on its own. The format comparison also
covers 50,000 messages, the size that published figures exist for.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from couriermart.contract import MESSAGE_COLUMNS  # noqa: E402
from couriermart.plans.queries import QUERIES  # noqa: E402
from couriermart.plans.stored import stored_mart, stored_rollup  # noqa: E402
from couriermart.session import build_session, release_scratch, scratch_path  # noqa: E402
from couriermart.sources import formats, layout  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
FORMAT_ROWS = 50_000

HEADLINE = [
    "kpi_summary", "sms_by_day", "top_countries", "top_operators", "revenue_by_currency", "failed_statuses",
    "delivery_rate_by_operator", "delivery_rate_by_country", "filtered_chart", "sms_by_day_rollup",
    "delivery_rate_rollup", "rollup_daily", "revenue_running_total", "revenue_mom", "top3_countries_by_month",
    "customer_tiers", "cohort_retention", "cohort_heatmap", "receiver_lifecycle", "describe_price",
    "describe_delivery_time", "iqr_outliers", "segment_by_country", "segment_by_customer", "dq_metrics",
    "load_summary", "expected_tariff", "checks_smoke", "checks_domain", "checks_pairing", "lookup_message",
    "application_slice", "customer_period", "month_partition_counts",
]


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        "couriermart-bench",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    loads = {
        "load_mart": seconds(lambda: stored_mart(spark, SF_DIR)),
        "load_rollup": seconds(lambda: stored_rollup(spark, SF_DIR)),
    }
    timings = {}
    for name in HEADLINE:
        run(name)
        timings[name] = statistics.median(seconds(lambda: run(name)) for _ in range(RUNS))

    sample = scratch_path(spark, "format-sample")
    stored = layout.open_mart(spark, stored_mart(spark, SF_DIR)).select(*MESSAGE_COLUMNS)
    stored.limit(FORMAT_ROWS).repartition(int(CPUS)).write.parquet(sample)
    messages = spark.read.parquet(sample).cache()
    messages.count()
    for _ in range(4):  # the last round counts, the others warm up
        compared = formats.compare_formats(messages, scratch_path(spark, "formats"))
    result = {
        "metric": f"sum of medians of {len(timings)} queries, warm",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in timings.items()},
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "loads": {name: round(value, 3) for name, value in loads.items()},
        "formats": {
            item.format: {
                "rows": FORMAT_ROWS,
                "size_mb": round(item.size_bytes / 2**20, 2),
                "write_s": round(item.write_s, 3),
                "read_s": round(item.read_s, 3),
            }
            for item in compared
        },
    }
    release_scratch(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
