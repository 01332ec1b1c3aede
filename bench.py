"""Times the headline queries; prints one JSON line. ``--all`` times every query of the library, models included.

Besides the whole time of a query, the line has the share of it that building the query took (jobs run before the result).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfspark.plans import catalog  # noqa: E402
from shelfspark.session import build_session  # noqa: E402

HEADLINE = (
    "prepared_sales",
    "store_day_panel",
    "store_day_panel_from_prepared_rows",
    "lag_features",
    "rolling_features",
    "all_features",
    "ungrouped_history_features",
    "daily_totals",
    "naive_forecasts",
    "split_by_rows",
    "split_by_dates",
    "counted_issues",
    "duplicate_row_issues",
    "iqr_outliers",
    "batch_issues",
    "column_profile",
    "store_gaps",
    "metrics_per_store",
    "outlier_report",
    "residual_summary",
    "normal_quantile_points",
    "error_histogram",
    "frozen_history",
    "future_rows",
    "category_codes",
    "experiment_verdict",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["--all"]:
        names = list(catalog.load())
    spark = build_session(
        f"local[{cpus}]", int(cpus), spark__driver__memory="16g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("OFF")
    built = catalog.load()
    # The first job pays for class loading; it is not part of any query.
    spark.read.parquet(f"{folder}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    times: dict[str, float] = {}
    building: dict[str, float] = {}
    for name in names:
        spark.catalog.clearCache()
        start = time.perf_counter()
        df = built[name].build(spark, folder)
        building[name] = round(time.perf_counter() - start, 3)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "build": building, "sf": os.path.basename(folder)}))


if __name__ == "__main__":
    main()
