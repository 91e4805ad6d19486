"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully computed (``noop`` sink: every row produced, nothing
collected to the driver), after one warm-up run, ``BENCH_REPEAT`` times; the
median is reported (``queries``) and the fastest run (``queries_min``), since
timings on a shared machine vary. Streaming queries run the whole replay
(stage, three restarts, sink) per repetition. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boardwalk.plans.registered import registry  # noqa: E402
from boardwalk.session import build_session  # noqa: E402

HEADLINE = [
    "trip_board",
    "latest_per_trip",
    "q4_trips_per_route",
    "q7_minutes_to_next",
    "q9_first_snapshot",
    # On a stored board: the warm-up run writes it, the timed runs only ask.
    "sql_q4_trips_per_route",
    "sql_q7_minutes_to_next",
    "sql_q9_pruned",
    "sql_q5_clustered",
    "rank_by_clock",
    "board_bucketed",
    "feed_split",
    "stream_append",
    "stream_upsert",
]
STREAMS = {"stream_append", "stream_upsert", "stream_join_bounded", "stream_late_dropped", "stream_upsert_compacted", "stream_latest_changes"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    }
    spark = build_session(f"local[{cpus}]", 2 * cpus, app="boardwalk-bench", **{k.replace(".", "__"): v for k, v in conf.items()})
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()
    names = only or HEADLINE
    results: dict[str, float] = {}
    fastest: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = reg[name]
        times = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            if name in STREAMS:
                n = df.count()  # the stream already ran; count the sink's table
            else:
                df.write.format("noop").mode("overwrite").save()
                n = None
            dt = time.perf_counter() - t0
            if i > 0:
                times.append(dt)
            if n is not None:
                rows[name] = n
        results[name] = round(statistics.median(times), 3)
        fastest[name] = round(min(times), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "headline_total",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "queries_min": fastest,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "stat": "median",
        "spark": {
            "version": spark.version,
            "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            "driver_memory": conf["spark.driver.memory"],
            "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
        },
    }
    # Stop first: state stores log while closing; the JSON line comes last.
    spark.stop()
    print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()
