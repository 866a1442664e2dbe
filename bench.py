"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores, ``BENCH_RUNS`` the timed runs per query
(the median counts, after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockloom.plans.catalogue import QUERIES  # noqa: E402
from stockloom.session import build_session  # noqa: E402

HEADLINES = (
    "c4_fulfilment_center",
    "d1_qty_on_hand",
    "d4_pending_out",
    "d8_stock_per_location",
    "d12_fully_invoiced",
    "e3_order_line_facts",
    "e5_disposition",
    "e9_net_purchase_qty",
    "e14_duplicate_deliveries",
    "e15_cancelled_lines",
    "e19_consumed_quants",
    "e20_transfer_moves",
    "e25_journal_lines",
    "e28_fifo_allocations",
    "e29_valuation_corrections",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline query seconds, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
