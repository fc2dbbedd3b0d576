"""Benchmark the headline queries.

Runs each registered headline query over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` (default 8), forcing full
evaluation with the ``noop`` sink, and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.catalog import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402

HEADLINE = [
    "word_count",
    "topk_common_words",
    "common_words",
    "way_nodes",
    "road_edges",
    "adjacency_text",
    "edge_distance",
    "shortest_path_text",
    "route_validation",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    spark = build_session(
        f"local[{cpus}]", app="tessera-bench", shuffle_partitions=max(8, cpus),
        extra={"spark.driver.memory": "16g",
               "spark.local.dir": scratch,
               "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    # warm the JVM (codegen, class loading) on the smallest query set
    warm_dir = "/root/testdata/sf0.001"
    if os.path.isdir(warm_dir):
        QUERIES["word_count"](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
