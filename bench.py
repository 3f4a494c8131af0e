"""Headline-query benchmark: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) select
the data and local parallelism.  Each query is executed in full through the
no-op sink (every row computed, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.plans import catalog  # noqa: E402
from lodestar.session import get_session, ship_package  # noqa: E402

HEADLINE = [
    "knn_label_ap",
    "knn_classify_many_k",
    "lsh_classify",
    "kernel_class_sums",
    "covariance_matrix",
    "label_proposals",
    "average_precision",
    "running_mean_reward",
    "stable_run",
    "shortest_paths",
    "edge_bound_violations",
    "lookup_names",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", partitions=cpus)
    qs = catalog.queries()
    # warm-up: JVM, and a Python worker on every core, so that no headline query pays for the start
    qs["class_priors"](spark, sf).write.format("noop").mode("overwrite").save()
    spark.range(cpus * 4).repartition(cpus * 2).mapInPandas(lambda batches: batches, "id long").write.format("noop").mode("overwrite").save()
    ship_package(spark)
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sfv = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sfv}))
    spark.stop()


if __name__ == "__main__":
    main()
