"""Time the headline queries: one warm-up pass, then the best of the timed passes. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from evalloom.plans import QUERIES  # noqa: E402
from evalloom.session import build_session  # noqa: E402

HEADLINE = [
    "context_budget", "keyword_rank", "build_prompt", "salient_keywords", "word_frequency", "vector_topk",
    "hybrid_topk", "topic_centroid", "fact_coverage", "pii_counts", "migrate_evals", "generate_evals",
    "pass_rate_daily", "rolling_pass_rate", "run_scorecard", "scorecard_rollup", "hourly_cap", "dedup_first",
    "merge_matched", "monitoring_cycle", "stream_ingest", "stream_tumbling", "udtf_chunks", "trace_spans",
    "span_latency", "messages_from_turns",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    passes = int(os.environ.get("BENCH_PASSES", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__ui__enabled="false",
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED_DIR", str(Path.cwd() / "spark-warehouse" / "staged")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(min(timed(name) for _ in range(passes)), 3)
    spark.stop()
    scale = Path(base).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
