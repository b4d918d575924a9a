"""Write PLANS.md: the initial physical plans of the key operators, shortened to the
nodes that decide cost. Usage: python tools/plans.py [sf_dir]"""

from __future__ import annotations

import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

HEAD = """# Physical plans of the key operators

Initial plans (AQE on; it may coalesce, split skewed joins or broadcast on measured sizes at
run time), shortened to the nodes that decide cost. Written by `tools/plans.py`.

* **Base**: pruned scans; reviews are aggregated per order before any join; orders, reviews and
  items meet in sort-merge joins (requested, so no size estimate broadcasts a fact); one exchange
  to (SKU, month) after partial aggregation.
* **Series**: one exchange by product carries M1, M3 and M4; the category grain is summed before
  its exchanges.
* **Base, F4, Q8 on stored tables** (`stored_tables=True`): bucketed scans, no exchange of orders, items or
  reviews; what still moves is the roll-up to (SKU, month) and one partial sum a task.
* **D1** joins stored SKU-grain stages on the typed product id, one row per SKU; the forecast scan is
  pruned to its grain.
* **P2** deals rows to value ranges (bounds from one percentile aggregate before); one exchange by range,
  no global sort; totals before a range are one row each, broadcast.
* **Medians** (V4): the brackets are sketches, broadcast as one row a column; the window runs over the
  bracket's distinct values only.
"""


def short(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if re.search(r"Exchange|Join|Scan|Bucketed|Window|Generate|Aggregate|Sort |Pandas|Arrow", line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"DataFilters.*?(?=PushedFilters)|, Location: .*?\]|, PartitionFilters: \[\]|, \[plan_id=\d+\]|, Batched: true", "", line)
            out.append(line[:200])
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F
    from skuflow.functions.ranking import medians
    from skuflow.operators import demand, features, inventory, profit, quality, trust
    from skuflow.plans.pipeline import Pipeline
    from skuflow.session import local_session

    spark = local_session()
    pipe = Pipeline.from_testdata(spark, sf_dir, forecaster="moving_average")
    t = pipe.tables
    frames = {
        "(SKU, month) base": features.sku_month_base(t["order_items"], t["orders"], t["order_reviews"], pipe.params.excluded_statuses),
        "Gap-filled SKU series (M1, M3, M4)": demand.sku_filled(pipe.monthly_sku, pipe.params.forecast),
        "Gap-filled category series": demand.category_filled(pipe.monthly_sku),
        "D1 decisions": inventory.sku_decisions(pipe.forecasts, pipe.demand_features, pipe.profitability, pipe.params.inventory),
        "P2 profit Pareto": profit.profit_pareto(pipe.profitability),
        "Medians of V4 and V3": medians(trust.latest_sku_rows(pipe.forecasts), [], {c: (F.col(c), 2) for c in ("mape_pct", "mae")}),
    }
    pipe = Pipeline.from_testdata(spark, sf_dir, forecaster="moving_average", stored_tables=True)
    s = pipe.tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as for tables too large to broadcast
    frames |= {
        "(SKU, month) base on stored tables": features.sku_month_base(s["order_items"], s["orders"], s["order_reviews"], pipe.params.excluded_statuses),
        "F4 on stored tables": features.fact_order_items(s["order_items"], s["orders"], s["order_reviews"], pipe.params.excluded_statuses),
        "Q8 of stored items": quality.unique_key(s["order_items"], ["order_id", "order_item_id"], "order_items"),
        "Q2 of stored reviews": quality.orphans(s["order_reviews"], s["orders"], "order_id", "order_id", "orphan_reviews_order_missing", "order_reviews"),
    }
    parts = [HEAD]
    for name, df in frames.items():
        parts.append(f"## {name}\n\n```\n{short(df._jdf.queryExecution().executedPlan().toString())}\n```\n")
    (ROOT / "PLANS.md").write_text("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
