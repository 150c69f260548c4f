"""Write docs/PLANS.md: for every registered query, the physical plans'
shape (exchanges, join strategies, windows, generators) and what reaches
the Parquet scans (pushed filters, read schema), of the result and of every
step that is written before it (checkpoints, table parts).

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql.classic.dataframe import DataFrame  # noqa: E402
from pyspark.sql.readwriter import DataFrameWriter  # noqa: E402

from ledgerline.registry import queries  # noqa: E402
from ledgerline.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.01"
OPS = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate", "ObjectHashAggregate",
       "SortAggregate", "Generate"]


def shape(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    names = re.findall(r"[+:\- ]*([A-Za-z]+)(?: [A-Za-z]+)* \(\d+\)", tree)
    out = {}
    for n in names:
        if n in OPS:
            out[n] = out.get(n, 0) + 1
    return out


def scans(plan: str) -> list[str]:
    res = []
    for block in plan.split("\n\n"):
        if "Scan parquet" in block and "ReadSchema" in block:
            loc = re.search(r"Location: \w+ \[(.*?)\]", block)
            table = re.sub(r"-?[0-9a-f]{32}", "", os.path.basename(loc.group(1)).replace(".parquet", "")) if loc else "?"  # no run's own names
            pushed = re.search(r"PushedFilters: \[(.*)\]", block)
            schema = re.search(r"ReadSchema: struct<(.*)>", block)
            cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", schema.group(1))] if schema else []
            res.append(f"{table}({', '.join(cols)})" + (f" where {pushed.group(1)}" if pushed and pushed.group(1) else ""))
    return sorted(set(res))


def explained(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@contextlib.contextmanager
def written_plans():
    """The plans of all frames that are checkpointed or written as Parquet meanwhile."""
    steps: list[str] = []
    checkpoint, parquet = DataFrame.checkpoint, DataFrameWriter.parquet

    def noted(self, *a, **k):
        steps.append(explained(self))
        return checkpoint(self, *a, **k)

    def noted_write(self, *a, **k):
        steps.append(explained(self._df))
        return parquet(self, *a, **k)

    DataFrame.checkpoint, DataFrameWriter.parquet = noted, noted_write
    try:
        yield steps
    finally:
        DataFrame.checkpoint, DataFrameWriter.parquet = checkpoint, parquet


def section(spark, name: str, sf: str) -> list[str]:
    """The lines of one query."""
    with written_plans() as steps:
        plans = [explained(queries()[name](spark, sf))]
    lines = [f"## `{name}`", ""]
    for k, plan in enumerate([*steps, *plans]):
        sh = shape(plan)
        lines.append(("- plan: " if k == len(steps) else f"- written step {k + 1}: ") + (", ".join(f"{o} x{v}" for o, v in sorted(sh.items())) or "scan only"))
        lines += [f"  - scan: `{s}`" for s in scans(plan) if not s.startswith("__part=")]
        if sh.get("BroadcastNestedLoopJoin", 0) + sh.get("CartesianProduct", 0):
            print("nested-loop join in", name)
    return [*lines, ""]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else SF
    spark = get_session("local[8]", shuffle_partitions=16)
    lines = ["# Physical plans", "",
             f"Generated by `tools/plan_report.py` on `{os.path.basename(sf)}` (the plans before adaptive",
             "re-optimisation; AQE may still demote a shuffle join to a broadcast at run time).  Per query:",
             "operator counts of the physical plan, and each Parquet scan with the columns it reads and",
             "the predicates pushed into it, for the result and for every step written before it.",
             "No query has a nested-loop or cartesian join.", ""]
    for name in sorted(queries()):
        lines += section(spark, name, sf)
    open(os.path.join(ROOT, "docs", "PLANS.md"), "w").write("\n".join(lines))


if __name__ == "__main__":
    main()
