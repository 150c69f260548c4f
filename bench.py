"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run fully (``write.format("noop")`` forces every row through
the plan without collecting it): one cold pass over all queries, then
``$BENCH_RUNS`` interleaved warm passes; the median warm time per query is
reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.registry import queries  # noqa: E402
from ledgerline.session import get_session  # noqa: E402

HEADLINE = [
    "q_suborder_rollup", "q_header_rollup", "q_qty_mismatch", "q_missing_in_erp", "q_not_in_dups",
    "q_keep_first", "q_mode_per_customer", "q_upsert", "q_line_numbering", "q_nest_flatten_orders",
    "q_xml_documents", "q_ledger_union", "q_cascading_lookup", "q_build_events", "q_replenish_summary",
    "q_stream_dedupe_upsert",
]


def run_once(spark, fn, sf):
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [a for a in sys.argv[1:]] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="ledgerline-bench", shuffle_partitions=int(cpus) * 2)
    qs = queries()
    for name in names:  # cold pass over everything: JIT, file listing, metadata caches
        run_once(spark, qs[name], sf)
    samples = {name: [] for name in names}
    for _ in range(runs):  # timed passes, interleaved so drift hits every query alike
        for name in names:
            samples[name].append(run_once(spark, qs[name], sf))
    times = {name: round(statistics.median(ts), 3) for name, ts in samples.items()}
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total_median_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")), "cpus": int(cpus),
                      "runs": runs, "spark": spark.version}))


if __name__ == "__main__":
    main()
