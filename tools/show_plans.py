"""Write PLANS.md: formatted physical plans of the headline queries on a stored table.

Usage: python tools/show_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Broadcast thresholds are switched off for the bucketed section so the
plan shows what a large table gets (a bucketed sort-merge join).
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelens import operators as ops  # noqa: E402
from pricelens.plans import panels  # noqa: E402
from pricelens.session import get_session, work_path  # noqa: E402
from pricelens.sources import products as P  # noqa: E402


def plan(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    root = work_path(spark, "plans", uuid.uuid4().hex)
    P.write_products(panels.panel_b(spark, sf), root)
    prod = P.read_products(spark, root)
    dates = P.snapshot_dates(spark, root, 2)
    pc = ops.price_changes(prod, dates)
    sections = [
        ("price_changes (two-snapshot join, literal partition filters)", pc),
        ("list_price_increases (partial WindowGroupLimit before the store exchange)",
         ops.list_price_increases(pc)),
        ("avg_deals_30d (narrow join + top-k, wide columns by checked broadcast)",
         ops.avg_deals_30d(prod, latest=dates[0])),
        ("history of discounts (checked broadcast semi join, products streamed once)",
         ops.history(ops.discounts(pc), prod)),
    ]
    name = f"plans_bucketed_{uuid.uuid4().hex[:8]}"
    P.create_bucketed_table(spark, name, work_path(spark, "plans", uuid.uuid4().hex), 8)
    P.write_bucketed(panels.panel_b(spark, sf), name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    bprod = P.read_bucketed(spark, name)
    sections.append(("price_changes on the product_id-bucketed table (no exchange, broadcast off)",
                     ops.price_changes(bprod, dates)))
    sections.append(("avg_price_30d on the bucketed table (aggregate without exchange)",
                     ops.avg_price_30d(bprod, dates[0])))
    out = ["# Physical plans of the headline queries",
           "", f"Generated by `tools/show_plans.py` on `{sf}` (weekly panel written to the partitioned table).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", plan(df).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
