"""Print, per registered query, plan features that do not scale: pairwise joins and single-task windows.

    python tests/plan_scan.py [name-prefix ...]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cellcast.session import local_session


def features(plan: str) -> dict[str, int]:
    counts = {
        "nested_loop": len(re.findall(r"BroadcastNestedLoopJoin", plan)),
        "cartesian": len(re.findall(r"CartesianProduct", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "window_all": len(re.findall(r"WindowExec|Window \[(?![^\n]*, \[)", plan)),
        "python": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
        "shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
    }
    return {k: v for k, v in counts.items() if v}


def main() -> None:
    import __spark_entry__ as entry

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    for name, fn in entry.queries().items():
        if sys.argv[1:] and not any(name.startswith(p) for p in sys.argv[1:]):
            continue
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        f = features(plan)
        flag = "!!" if f.get("nested_loop") or f.get("cartesian") else "  "
        print(flag, name, f, flush=True)


if __name__ == "__main__":
    main()
