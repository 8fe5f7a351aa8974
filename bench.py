"""Seconds per headline query over whole tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from panelcast.catalog import CHECKS
from panelcast.operators.calendar import year_bounds
from panelcast.plans import gold
from panelcast.plans.panels import Tables, hourly_panel
from panelcast.session import build_session

HEADLINE = [
    "naive_forecast_by_zone",
    "lag_checked",
    "lag_exact",
    "rolling_past",
    "zscore",
    "interpolate_linear",
    "rollup_complete_hours",
    "silver_panel",
    "gold_features_day_ahead",
    "gold_features_week_ahead",
    "targets_for_all_horizons",
    "complete_horizons",
    "downsample_issues",
    "calendar_join",
    "metrics_by_zone_and_horizon",
    "metrics_full",
    "metrics_by_time",
    "percentiles_by_group",
    "reconcile_bottom_up",
    "scoring_features",
    "rank_average",
    "top_n_per_group",
    "upsert_rows",
    "detail_table",
    "kpis",
    "linear_forecast",
    "backtest",
    "score_recursive",
    "upsert_table",
    "stream_upsert",
]


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "panelcast-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.range(1000).repartition(int(cpus)))  # start the executor threads before timing
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(CHECKS[name].frame(spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
    # the full expansion: every issue hour times 168 horizons, all feature columns
    events = Tables(spark, folder).events
    panel, years = hourly_panel(events), year_bounds(events, "ts")
    seconds["gold_features_168_horizons"] = round(run(gold.features_7d(panel, years=years)), 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
