"""Summarise the physical plans of the headline queries.

``python -m checks.plan_summary [sf_dir] > PLANS.md``: per query, the count of
exchanges and of each join kind, whether Python runs in the plan, and for
every file scan its pushed filters and the columns it reads.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

from checks.registry import REGISTRY
from tillroll.plans.session import build_session

HEADLINE = [
    "profit_by_title",
    "items",
    "retail_sales_by_item",
    "consolidate_receipts",
    "not_received_all",
    "not_received_cdc",
    "not_received_vendor",
]


def summary(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    kinds = Counter(
        re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)
    )
    joins = Counter(re.findall(r"(?:BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti)", plan))
    lines = [
        f"* exchanges: {plan.count('Exchange ')} (of them broadcast: {plan.count('BroadcastExchange')})",
        f"* joins: {dict(kinds)}; by type: {dict(joins)}",
        f"* partial aggregations: {plan.count('partial_')}",
        f"* Python evaluation nodes: {len(re.findall('EvalPython|FlatMapGroupsInPandas|MapInPandas', plan))}",
        "* scans (pushed filters / columns read):",
    ]
    seen = set()
    for m in re.finditer(r"FileScan parquet \S*\[([^\]]*)\][^\n]*?Location: [^\[\n]*\[([^\]]*)\][^\n]*?PushedFilters: \[([^\n]*?)\], ReadSchema", plan):
        cols, loc, pushed = m.group(1), "/".join(m.group(2).rstrip("/").split("/")[-2:]), m.group(3)
        if "tillroll-st" in m.group(2):
            loc = "stage table"
        cols = re.sub(r"#\d+L?", "", cols)
        key = (loc, cols, pushed)
        if key in seen:
            continue
        seen.add(key)
        lines.append(f"  * `{loc}` [{cols}] pushed: [{pushed}]")
    return "\n".join(lines)


def fact_side(spark, sf_dir) -> dict:
    """The per-code fact sums (run as background stage jobs in the job)."""
    from checks.registry import AS_OF
    from tillroll.operators import receipts as R
    from tillroll.operators import sales as SA
    from tillroll.plans.profit_job import run_profit
    from tillroll.sources.standins import standin_tables

    t = standin_tables(spark, sf_dir)
    keys = run_profit(t, AS_OF).weights.keys
    return {
        "fact side: receipt_sums (current receipts)": R.receipt_sums(t["receipt_header"], t["receipt_detail"], keys),
        "fact side: legacy_sums": R.legacy_sums(t["pop_receipt_header"], t["pop_receipt_line"], keys),
        "fact side: shipment_sums": SA.shipment_sums(t["transfer_header"], t["transfer_detail"], keys),
        "fact side: sales_sums": SA.sales_sums(t["sales_item_history"], t["locations"], keys),
        "fact side: wholesale_sums (open)": SA.wholesale_sums(t["sop_open_header"], t["sop_open_line"], keys),
    }


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    print(f"# Physical plans of the headline queries ({sf_dir}, AQE final plans)\n")
    print("Generated by `python -m checks.plan_summary`. Stage tables (`tillroll-stages/...`) are the")
    print("materialised item set and its inputs; driver tables appear through the stand-in views.\n")
    for name in argv[1:] or HEADLINE:
        print(f"## {name}\n")
        print(summary(REGISTRY[name][0](spark, sf_dir)))
        print()
    if not argv[1:]:
        for name, df in fact_side(spark, sf_dir).items():
            print(f"## {name}\n")
            print(summary(df))
            print()


if __name__ == "__main__":
    main(sys.argv[1:])
