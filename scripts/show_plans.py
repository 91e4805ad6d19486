"""Write PLANS.md: the physical plan of each headline query after it ran
(final adaptive plan), with the scan schemas and pushed filters.

    python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from boardwalk.plans import adhoc, trip_board  # noqa: E402
from boardwalk.plans.registered import registry  # noqa: E402
from boardwalk.session import build_session, shared_dir  # noqa: E402
from boardwalk.sources import read_board  # noqa: E402

NOTES = {
    "trip_board": "Orders are spread by order key (the exchange the join with the per-order stop lists needs anyway); "
    "each message is parsed once (`Generate inline(...)` below the key filters); the update x status join is a "
    "sort-merge join (a broadcast where a side passes the planner's size check).",
    "latest_per_trip": "Both sides are reduced per trip key with partial + final `max_by` before a 1:1 join, then the latest "
    "trip-key group wins per tripId: no update x status expansion of a hot trip.",
    "q4_trips_per_route": "Partial count per task before the exchange: a route with a third of all rows is reduced map-side.",
    "q9_first_snapshot": "No Window and no single-partition exchange of the board: the minimum clock is a one-row aggregate, "
    "broadcast, and only the first snapshot's rows reach the final aggregation. Its branch parses and joins trips alone.",
    "board_from_feed": "Each feed's folder is scanned on its own; one union, one split, then the board.",
    "q3_first_rows (board table)": "Top-k: `TakeOrderedAndProject` keeps 10 rows per task.",
    "q5_started_between (board table)": "`BETWEEN` reaches the Parquet scan (`PushedFilters`), only three columns are read.",
    "rank_by_clock": "Distinct clocks with their counts, ranges dealt out and written once (`Scan ExistingRDD`), a window per "
    "range, ranks joined back by clock: no single-partition exchange of the board.",
    "sql_q5_clustered": "`PartitionFilters` on the start month: only the folders of the interval are listed and opened.",
    "sql_lookup_by_trip": "The ids reach the scan (`PushedFilters: In(tripId, ...)`), where bloom filters rule row groups out.",
    "board_bucketed": "Both sides are bucketed and sorted by the trip keys: a sort-merge join without an exchange.",
    "q9_first_snapshot_pruned (board table)": "The minimum clock is computed first and applied as a literal: the equality "
    "reaches the Parquet scan, so row-group statistics skip files without the first snapshot.",
}


_NODE = re.compile(r"^\s*(:|\+-|\*\(|[A-Z]|==)")


def tree(plan: str) -> str:
    """The final plan only, one node per line, long expressions cut. Lines
    that continue a node (a literal newline inside an expression) are joined
    back to it."""
    nodes: list[str] = []
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            break
        if nodes and not _NODE.match(line):
            nodes[-1] += " " + line.strip()
        else:
            nodes.append(line)
    return "\n".join(n[:200] for n in nodes)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()
    path = f"{shared_dir(spark)}/plans-board-{uuid.uuid4().hex[:8]}"
    trip_board(spark, sf_dir).write.parquet(path)
    board_table = read_board(spark, path)
    cases = {
        "trip_board": reg["trip_board"](spark, sf_dir),
        "latest_per_trip": reg["latest_per_trip"](spark, sf_dir),
        "q4_trips_per_route": reg["q4_trips_per_route"](spark, sf_dir),
        "q9_first_snapshot": reg["q9_first_snapshot"](spark, sf_dir),
        "board_from_feed": reg["board_from_feed"](spark, sf_dir),
        "rank_by_clock": reg["rank_by_clock"](spark, sf_dir),
        "sql_q5_clustered": reg["sql_q5_clustered"](spark, sf_dir),
        "sql_lookup_by_trip": reg["sql_lookup_by_trip"](spark, sf_dir),
        "board_bucketed": reg["board_bucketed"](spark, sf_dir),
        "q3_first_rows (board table)": adhoc.q3_first_rows(board_table),
        "q5_started_between (board table)": adhoc.q5_started_between(board_table, "1998-01-01 00:00:00", "1998-06-30 18:00:00"),
        "q9_first_snapshot_pruned (board table)": adhoc.q9_first_snapshot_pruned(board_table),
    }
    out = [
        "# Physical plans",
        "",
        f"Generated by `scripts/show_plans.py` on `{sf_dir}` with `local[8]`, 8 shuffle partitions, AQE on. Each plan is",
        "the final adaptive plan after the query ran, with broadcasts by size switched off, as at scale, where no side is",
        "small enough. Lines with `*(n)` run inside whole-stage codegen.",
        "",
    ]
    for name, df in cases.items():
        df._jdf.queryExecution().toRdd().count()  # runs this very plan; nothing reaches the driver
        plan = df._jdf.queryExecution().executedPlan().toString()
        formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        scans = [ln.strip() for ln in formatted.splitlines() if ln.strip().startswith(("ReadSchema", "PushedFilters", "PartitionFilters"))]
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", tree(plan), "```", ""]
        if scans:
            out += ["Scans:", "", "```", *sorted(set(scans)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
