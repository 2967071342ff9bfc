"""Physical-plan shape of every registered query (pre-AQE plan).

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Window", "Generate",
       "Scan parquet"]


def shape(text: str) -> dict[str, int]:
    head = text.split("\n\n")[0]
    out = {}
    for op in OPS:
        if op == "Exchange":
            pat = r"(?<!Broadcast)\bExchange\b"
        elif op == "Scan parquet":
            pat = r"Scan parquet|Scan ExistingRDD"
        else:
            pat = r"\b" + re.escape(op) + r"\b"
        out[op] = len(re.findall(pat, head))
    return out


def main() -> None:
    from ledgerline import get_session
    from ledgerline.plans.inspect import forbidden_operators, plan_text
    from ledgerline.plans.queries import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[4]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["shuffles", "bcast", "SMJ", "BHJ", "hash agg", "obj agg", "sort agg", "win limit", "window",
            "generate", "scans"]
    print("| query | " + " | ".join(cols) + " | forbidden |")
    print("|---|" + "---|" * (len(cols) + 1))
    for name in sorted(QUERIES):
        if name == "stream_sync_events":
            continue  # a streaming run; its batch plans are upserts
        df = QUERIES[name](spark, sf)
        s = shape(plan_text(df, "simple"))
        vals = [s["Exchange"], s["BroadcastExchange"], s["SortMergeJoin"], s["BroadcastHashJoin"],
                s["HashAggregate"], s["ObjectHashAggregate"], s["SortAggregate"], s["WindowGroupLimit"],
                s["Window"], s["Generate"], s["Scan parquet"]]
        bad = ",".join(forbidden_operators(df)) or "—"
        print(f"| {name} | " + " | ".join(str(v) for v in vals) + f" | {bad} |", flush=True)


if __name__ == "__main__":
    main()
