"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: one warm-up pass, then ``$BENCH_RUNS`` timed passes
(default 3); a query's time is the median. Execution is forced with the
``noop`` sink, so the whole plan runs and nothing is collected to the driver.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.plans import registry  # noqa: E402
from tidemill.session import build_session  # noqa: E402

HEADLINE = [
    "feat_ema_decay",       # flagship: EMA + MA + STD, 90-day window, per client
    "feat_ema_fill_zero",   # densified series
    "feat_ema_by_config",   # per-client window lengths
    "feat_lags",
    "bom_explode",          # 5-level explosion over all roots
    "component_demand",     # sales x exploded BOM
    "clients_upsert",       # client fold
    "message_outcomes",     # decode + outcome of every message
    "sales_enriched",
    "log_stats",
    "config_current",
    "slo_p95_breach",
    "bom_cycles",           # paths back to their root
    "config_history",
    "dead_letters",
    "pending_messages",
    "consumer_lag",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="tidemill-bench",
                          driver_memory=memory)
    q = registry.queries()
    for name in names:                      # warm-up: JIT, file listing, codegen caches
        run(q[name](spark, sf_dir))
    times: dict[str, list[float]] = {n: [] for n in names}
    for _ in range(runs):
        for name in names:
            t0 = time.perf_counter()
            run(q[name](spark, sf_dir))
            times[name].append(time.perf_counter() - t0)
    med = {n: round(statistics.median(v), 3) for n, v in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(med.values()), 3),
                      "unit": "sec", "queries": med, "sf": sf, "cpus": cpus, "runs": runs,
                      "driver_memory": memory}))
    spark.stop()


if __name__ == "__main__":
    main()
