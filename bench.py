"""Headline-query benchmark: prints ONE JSON line.

Runs each headline query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]. Every query is fully executed through the ``noop`` sink
(the whole plan runs, nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dataloom.plans import REGISTRY  # noqa: E402
from dataloom.session import get_spark  # noqa: E402

HEADLINE = [
    "job_wordcount", "job_ngram_hour_score", "job_log_query_stats",
    *[f"job_mix_l{i}" for i in range(1, 18)],
    "join_hash_inner", "join_asof", "join_theta_range", "agg_cube", "win_rows_frame", "rank_global",
    "sort_total", "set_intersect", "gr_pagerank",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in sys.argv[1:]]
    spark = get_spark(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    # warm-up: JIT, class loading, file listing cache
    REGISTRY["job_mix_l8"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        if name not in REGISTRY:
            continue
        t0 = time.perf_counter()
        REGISTRY[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
