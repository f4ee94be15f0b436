"""Benchmark: build the provider views and run the registered queries.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line: total wall seconds, per-query seconds (results are
collected to the driver -- all are small), and the view build time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from peerscope.plans.registry import all_queries
    from peerscope.plans.views import workspace
    from peerscope.session import build_session

    spark = build_session()
    t0 = time.time()
    workspace(spark, sf_dir).build_all()
    timings = {"views_build": round(time.time() - t0, 3)}
    rows = {}
    for name, fn in all_queries().items():
        t = time.time()
        out = fn(spark, sf_dir).collect()
        timings[name] = round(time.time() - t, 3)
        rows[name] = len(out)
    total = round(time.time() - t0, 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": timings,
                      "rows": rows, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
