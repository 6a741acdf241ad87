"""Run the headline queries and print one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)

Each query is built and then executed in full with the ``noop`` sink (no
rows travel to the driver); its time includes the eager size checks done
while building.  The base frames of the workspace are shared between
queries, as they are for a user running several analyses in one session.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from moodcast.plans import catalog  # noqa: E402
from moodcast.plans.workspace import workspace  # noqa: E402
from moodcast.session import build_session, clear_scratch  # noqa: E402

HEADLINE = [
    "weather_wide",
    "sentiment_class",
    "daily_rain",
    "linreg_rain",
    "chi2_rain_2x3",
    "anova_rain_combined",
    "tukey_rain_combined",
    "label_class_totals",
    "linreg_temp",
    "polyfit4_temp",
    "anova_cold",
    "mannwhitney_pairs",
    "monthly_rain",
    "linreg_monthly",
    "polyfit11_monthly",
    "aligned_city_day",
    "daily_count_histogram",
    "sentiment_rules",
    "aligned_sorted",
    "station_lookup",
    "partitioned_sink_weather",
    "rf_accuracy",
    "lines_chi2",
    "lines_anova",
    "lines_tukey",
    "lines_linreg",
    "lines_mannwhitney",
    "lines_histogram",
]


def _driver_memory() -> str:
    """Up to 8 GB, at most ~60% of this machine's memory."""
    try:
        with open("/proc/meminfo") as fh:
            total_kb = int(next(line for line in fh if line.startswith("MemTotal")).split()[1])
        return f"{max(1, min(8, int(total_kb * 0.6 / 1024 / 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="moodcast-bench-", dir="/tmp")
    # sf0.1 fits in a few MB per shuffle: one partition per core; AQE
    # coalesces further and splits skew.
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(cpus, 2))))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=parts, app="moodcast-bench",
                          extra={"spark.driver.memory": _driver_memory(),
                                 "spark.checkpoint.dir": scratch + "/ckpt",
                                 "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": scratch})
    # Warm the JVM and Python workers on the smallest data, untimed.
    smoke = "/root/testdata/sf0.001"
    if os.path.isdir(smoke):
        for name in ("linreg_rain", "tukey_cold"):
            catalog.REGISTRY[name].build(workspace(spark, smoke)).write.format("noop").mode("overwrite").save()

    ws = workspace(spark, sf_dir)
    times: dict[str, float] = {}
    t_all = time.perf_counter()
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = catalog.REGISTRY[name].build(ws)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(time.perf_counter() - t_all, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    ws.release()
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
