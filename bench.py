"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (no driver
collect), once to warm up and then ``BENCH_REPEAT`` times; the median
counts.  ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from beatline.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark("beatline-bench", master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))

    from beatline.operators.evaluate import evaluate, merge_with_truth
    from beatline.operators.features import engineer_features
    from beatline.plans.pipeline import run_pipeline
    from beatline.sources import testdata as td

    def cx():
        return td.connections(spark, sf_dir)

    headline = {
        "features": lambda: engineer_features(cx()),
        "pipeline_model_off": lambda: run_pipeline(cx(), use_model=False),
        "pipeline_model_on": lambda: run_pipeline(cx()),
        "evaluation": lambda: evaluate(merge_with_truth(run_pipeline(cx(), use_model=False, sort=False),
                                                        td.ground_truth(spark, sf_dir))),
    }
    times = {}
    for name, build in headline.items():
        build().write.format("noop").mode("overwrite").save()
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    rows_in = td.connections(spark, sf_dir).count()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "beacon_pipeline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "rows_in": rows_in,
                      "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
