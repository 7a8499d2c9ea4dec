"""Wall-clock seconds per headline query: warm JVM, median of three runs, written to a no-op sink."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aislewatch.catalogue import QUERIES  # noqa: E402
from aislewatch.session import local_session  # noqa: E402

HEADLINE = [
    "M9_match_images", "M4_candidates", "M10_scoped_match", "M17_match_by_hash", "I18_drop_near_duplicates",
    "H1_node_table", "H3_element_text", "observe_products", "P11_price_with_source", "P12_saving_fields",
    "V6_layered_verdict", "I4_distinct_first", "I7_dominant_family", "K7_roll_up_variants", "J4_products_at_any_depth",
    "T5_distinct_lines", "U3_stable_id", "E1_fill_missing",
]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in wanted:
        times = []
        for _ in range(RUNS + 1):  # the first run warms up and is not counted
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
