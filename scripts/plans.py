"""Summarise the executed physical plan of every registered query.

usage: python scripts/plans.py [sf_dir] [query ...]   (prints a Markdown table)
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayfare.plans import QUERIES  # noqa: E402
from wayfare.plans.inspect import final_plan, plan_summary  # noqa: E402
from wayfare.session import build_session  # noqa: E402

COLUMNS = ["scans", "exchanges", "joins", "partial agg", "window", "python",
           "partition filters", "pushed"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    print("| query | " + " | ".join(COLUMNS) + " |")
    print("|---|" + "---|" * len(COLUMNS))
    for name in names:
        s = plan_summary(final_plan(QUERIES[name](spark, sf_dir)))
        print(f"| `{name}` | " + " | ".join(s[c].replace("|", "/") for c in COLUMNS) + " |", flush=True)


if __name__ == "__main__":
    main()
