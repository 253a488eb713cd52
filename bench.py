"""Time the headline queries: ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.

Every query runs once to warm the session up and once timed, into a sink that
takes all rows. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mostrador.catalog.queries import QUERIES  # noqa: E402
from mostrador.session import build_session  # noqa: E402

HEADLINE = (
    "summary_filtered",
    "summary_all",
    "filter_combined",
    "exact_quantiles",
    "outliers_iqr",
    "clean_dataset",
    "unit_price",
    "age_at_purchase",
    "purchase_frequency",
    "frequency_join",
    "standardize",
    "apply_features",
    "mcar_mann_whitney",
    "typed_cast",
    "partitioned_write",
    "month_pruned_scan",
    "ingest_end_to_end",
    "request_validation",
    "batch_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
