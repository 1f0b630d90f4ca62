"""Physical-plan report for every registered query: shuffles, join strategies,
Python evaluation nodes, whole-stage codegen spans and the columns each scan reads.

usage: python tools/plan_report.py [sf_dir] [name ...]
Queries whose plans need actions to build (streams, staged files) are planned as they run.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfmatch.plans import catalog  # noqa: E402
from shelfmatch.session import local_session  # noqa: E402

NODES = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "SortAggregate", "HashAggregate", "ObjectHashAggregate",
         "Window", "ArrowEvalPython", "MapInPandas", "MapInArrow", "Generate", "WholeStageCodegen")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in catalog.queries() if not n.startswith("stream_")]
    spark = local_session(8)
    for name in names:
        df = catalog.queries()[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {n: len(re.findall(rf"\b{n}\b", plan)) for n in NODES}
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))))
        shown = ", ".join(f"{k}={v}" for k, v in counts.items() if v)
        print(f"{name}\n  {shown}")
        for s in schemas:
            print(f"  read {s[:160]}")
    spark.stop()


if __name__ == "__main__":
    main()
