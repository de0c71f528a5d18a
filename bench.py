"""Time the headline queries on $BENCH_SF_DIR; prints one JSON line.

Every query runs over the whole tables; all columns of all rows are computed
(``noop`` sink).  ``BENCH_QUERIES`` (comma separated) restricts the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tickloom.plans import catalog
from tickloom.session import build_session

HEADLINE = [
    "features_p",
    "features_s",
    "features_chunked",
    "features_many_tickers",
    "recent_100",
    "recent_20_many_tickers",
    "latest_tick",
    "dedup_first",
    "json_parse",
    "stream_ingest",
    "lake_compact",
    "tail_split",
    "kfold_ids",
    "mae_rmse_accuracy",
    "predict_band",
    "market_state",
    "key_frequency",
    "top_keys",
    "train_lr",
    "train_lr_many_tickers",
    "train_lr_mllib",
    "train_rf",
    "train_gbt",
    "stacking_linear",
    "predict_ensembles",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "tickloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    # Start the JVM's and the Python workers' engines outside of the timings.
    catalog.tick_count(spark, folder).collect()
    catalog.features_p(spark, folder).limit(1).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
