"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names; default: the list below). Each query runs once, to its last row,
after one unmeasured query has warmed up the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rillflow.plans.catalog import QUERIES  # noqa: E402
from rillflow.session import drop_scratch, local_session  # noqa: E402

HEADLINES = (
    "log_parse_report",
    "log_404_top_endpoints",
    "log_daily_avg_requests",
    "rel_sum_by_key",
    "rel_top_valid_group",
    "graph_triplets",
    "graph_degrees",
    "graph_oldest_follower",
    "graph_components",
    "tags_enrich",
    "tags_similar_pairs",
    "vec_nearest",
    "vec_nearest_batch",
    "stream_running_avg",
    "stream_running_avg_trace",
    "text_new_words",
    "vocab_admission",
    "emb_context",
    "emb_softmax",
    "emb_gradients",
    "emb_train_step",
    "keyed_upsert",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = local_session("bench", cpus=cpus)
    QUERIES["rel_distinct"](spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
    }
    drop_scratch(spark)
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
