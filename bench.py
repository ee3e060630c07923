"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1); BENCH_CPUS: cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kindred.session import local_session  # noqa: E402
from workload.queries import registered  # noqa: E402

HEADLINE = (
    "label_counts_top",
    "clean_chain",
    "cosine_topn",
    "phrase_overlap",
    "candidates",
    "rank_kmeans",
    "greedy_set",
    "triple_rules",
    "upcoming_recs",
    "kfold_mse",
    "dbscan",
    "silhouette",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    queries = registered()
    spark.read.parquet(f"{sf_dir}/part.parquet").groupBy("p_type").count().collect()  # start the engine
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
