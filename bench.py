"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.models import ridge
from shelfcast.operators import folds, metrics, scaling
from shelfcast.plans import demand
from shelfcast.plans.queries import REGISTRY
from shelfcast.schemas import FEATURES
from shelfcast.session import local_session
from shelfcast.sources import star

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINES = (
    "daily_sales",
    "merge_duplicate_days",
    "calendar_dense",
    "features_clean",
    "window_bounds",
    "scaled_features",
    "leakage_corr",
    "naive_baseline",
    "metrics_by_window",
    "metrics_by_series",
    "daily_errors",
    "top_products",
    "month_coverage",
    "inventory_counts",
    "backtest_ridge",
    "forecast_sequence",
    "backtest_sequence",
    "rolling_windows",
    "daily_sales_split",
    "inventory_status",
)


def supplier_inputs(spark) -> DataFrame:
    return demand.model_inputs(star.open_store(spark, FOLDER, "supplier"))


def supplier_train(spark) -> DataFrame:
    return supplier_inputs(spark).where(F.col("date") < F.lit(star.SPLIT).cast("date"))


# The same operators on one series per supplier: forty times as many rows at sf0.1.
SUPPLIERS = {
    "supplier_dense": lambda s: demand.dense(star.open_store(s, FOLDER, "supplier")),
    "supplier_features": supplier_inputs,
    "supplier_naive_baseline": lambda s: metrics.naive_baseline(supplier_train(s)),
    "supplier_metrics_by_window": lambda s: metrics.metrics_by_window(
        demand.closed_form_backtest(supplier_inputs(s), folds.Fold(365, 7, 7)).withColumn("forecast", F.col("mean7"))
    ),
    "supplier_scaler_stats": lambda s: scaling.scaler_stats(supplier_train(s), FEATURES),
    "supplier_backtest_ridge": lambda s: ridge.backtest(supplier_inputs(s), star.SPLIT),
}


def seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    spark = local_session("bench", CPUS)
    builders = {n: (lambda s, n=n: REGISTRY[n](s, FOLDER)) for n in HEADLINES} | SUPPLIERS
    seconds(star.table(spark, FOLDER, "lineitem"))  # start-up is not part of a query
    times, every = {}, {}
    for name in names or builders:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            df = builders[name](spark)
            built = time.perf_counter() - start
            runs.append(built + seconds(df))
        times[name] = round(statistics.median(runs), 3)
        every[name] = [round(r, 3) for r in runs]
        print(f"{name} {runs}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "runs": every,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
