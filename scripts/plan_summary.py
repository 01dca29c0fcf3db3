"""Summarize the physical plans of the registered feature queries (markdown table).
Usage: python scripts/plan_summary.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from pyspark.sql import DataFrameWriter  # noqa: E402

from eventide.plans import registry  # noqa: E402
from eventide.session import local_session  # noqa: E402

COUNTS = [
    ("scans", r"FileScan parquet|Scan ExistingRDD|InMemoryTableScan"),
    ("hash exch.", r"Exchange hashpartitioning"),
    ("single-part. exch.", r"Exchange SinglePartition"),
    ("broadcast", r"BroadcastExchange"),
    ("BHJ", r"BroadcastHashJoin"),
    ("SMJ", r"SortMergeJoin"),
    ("HashAgg", r"HashAggregate"),
    ("SortAgg", r"SortAggregate"),
    ("Window", r"\bWindow \["),
    ("Expand/Generate", r"\bExpand \[|\bGenerate "),
    ("subqueries", r"Subquery subquery"),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print(f"# Physical plans ({sf_dir}, AQE initial plans)\n")
    print("Counts of operators in all plans that a registered query runs: the jobs that write its small tables "
          "(late thresholds, operators' working tables) and its final plan. Generated by `scripts/plan_summary.py`.\n")
    ran: list[str] = []
    write = DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        """Writes of a query's own tables: note the plan, then run it."""
        ran.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    DataFrameWriter.parquet = noted
    print("| query | " + " | ".join(c for c, _ in COUNTS) + " |")
    print("| --- |" + " --- |" * len(COUNTS))
    for name, fn in registry.queries().items():
        ran.clear()
        final = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        plans = [*ran, final]
        cells = [str(sum(len(re.findall(rx, p)) for p in plans)) for _, rx in COUNTS]
        print(f"| `{name}` | " + " | ".join(cells) + " |")


if __name__ == "__main__":
    main()
