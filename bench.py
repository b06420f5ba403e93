"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully computed through the ``noop`` sink (no collect to the
driver).  One warm-up query runs first so JVM start-up is not billed to the
first headline query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "hourly_demand",
    "hourly_demand_multi_month",
    "upsert_by_key",
    "daily_sum",
    "daily_series",
    "time_lags",
    "mean_lag_forecast",
    "lag_regression_forecast",
    "rolling_origin_forecast",
    "backtest",
    "backtest_linear",
    "bootstrap_interval",
    "multi_step_bootstrap",
    "residual_acf",
    "residual_quantiles",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from hourglass.plans.catalog import all_queries
    from hourglass.session import get_spark

    spark = get_spark(app_name="hourglass-bench")
    qs = all_queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]

    # Warm-up (JIT, class loading) on the smallest tables only: nothing of the
    # measured scale factor is read or cached before the timed runs.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in ("hourly_demand", "mean_lag_forecast"):
        if os.path.isdir(warm_dir):
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
