"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each query runs once to warm up and then twice into a no-op sink; the median (of two, the mean) counts. What
queries keep for one another (blocks, knowledge rows, indexes) is forgotten before each run, so a time is that of the whole query.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from foliospark.runtime import local_session

HEADLINE = ("bm25_search", "bm25_legacy_search", "tokenize", "chunk_text", "relink_blocks", "manual_blocks", "garbled_pages", "kb_rows", "graph_edges", "graph_expand", "vector_search", "hybrid_search", "parse_queries", "entity_match", "session_fold", "recall_at_k")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    from foliospark.plans import catalog, registry

    times = {}
    for name in HEADLINE:
        runs = []
        for i in range(int(os.environ.get("BENCH_RUNS", "2")) + 1):
            registry.forget()
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - began)
        times[name] = round(statistics.median(runs), 3)
    print(json.dumps({"metric": "total_seconds_of_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
