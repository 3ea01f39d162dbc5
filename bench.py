"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (no collect), after
one warm-up run of a small query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "workflow",          # flagship: catalog union -> link -> enrich -> validate, one plan
    "match_posts",       # anchor equi-join + verification + arg-max + left join
    "build_matches",     # same with the data label dictionary
    "build_combined",    # last-wins dedupe + broadcast left join + record mapping
    "validate_records",
    "build_catalog",     # listing files -> catalog
    "build_posts",       # JSON dumps -> posts
    "src_csv_lenient",
    "normalize_text",
    "html_heading_text",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from prodlink.session import local_session
    from prodlink.plans import queries as Q
    from prodlink.plans import workflow as W

    spark = local_session(cpus, shuffle_partitions=max(cpus * 2, 8))
    builders = {name: fn for name, (fn, _) in Q.REGISTRY.items()}
    builders["workflow"] = lambda s, d: W.run_workflow(s, d, layout_partitions=cpus).combined
    # The test files hold one row group each; spread them explicitly, as a tiny input needs it.
    builders["match_posts"] = lambda s, d: Q._match_posts(s, d, layout_partitions=cpus)
    builders["build_matches"] = lambda s, d: Q._match_posts(s, d, Q.DATA_LABELS, layout_partitions=cpus)

    def run(name: str, where: str = sf_dir) -> float:
        t0 = time.perf_counter()
        builders[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Warm-up: every headline query once on the smallest scale factor, so JIT
    # and codegen compilation are not charged to the timed runs.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            run(name, warm)
    times = {}
    for name in HEADLINE:
        times[name] = round(run(name), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
