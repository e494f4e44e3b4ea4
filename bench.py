"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from larkspur.catalog import QUERIES
from larkspur.session import build_session

HEADLINE = [
    "mart_sales_daily", "mart_customer_ltv", "mart_product_performance", "mart_funnel", "stg_orders", "pipe_order_etl",
    "report_city_category", "report_monthly", "report_value_tier", "pipe_order_anomalies", "pipe_hospital_batch",
    "cache_reuse", "partition_prune", "join_broadcast", "join_shuffle", "join_star", "join_range", "join_scd2_as_of",
    "agg_group_sum", "agg_rollup", "agg_pivot", "agg_percentile", "agg_array_row_counts", "win_row_number", "win_ntile",
    "win_running_sum", "win_sum_partition", "topk_per_group", "deduplicate", "set_symmetric_diff", "scd2_dimension",
    "gx_suite", "dq_exclusive_ranges", "ex_moving_stdevs", "ex_quantile_between", "date_dimension", "date_fiscal_periods",
    "ml_training_features", "stream_tumbling_stats",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "larkspur-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "agg_group_sum", folder)  # start the engine outside the measurement
    times = {name: round(run(spark, name, folder), 3) for name in HEADLINE}
    sf = os.path.basename(folder.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
