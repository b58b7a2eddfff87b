"""Print the physical plans of the flagship's parts: the two reduction jobs
(facility counts, prices) and the panel plan over their written copies.

Usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelkit.operators import panel  # noqa: E402
from panelkit.plans import catalog, roles  # noqa: E402
from panelkit.session import build_session  # noqa: E402


def executed(df) -> str:
    df.collect()  # small results; a write would run (and finalise) another execution
    plan = df._jdf.queryExecution().executedPlan().toString()
    keep = []
    for line in plan.splitlines():
        line = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[file:[^\]]*/([^/\]]+)\]",
                      r"Location: \1", line)
        line = re.sub(r"#\d+L?", "", line)
        keep.append(line[:240])
    return "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    parts = {
        "facility counts (orders reduced per customer-year before the joins)":
            roles.facility_counts(spark, sf_dir),
        "prices (line items reduced per supplier-year before the joins)":
            panel.avg_price(roles.power_costs(roles.utility_sales(spark, sf_dir))),
        "panel over the two written aggregates": catalog.flagship(spark, sf_dir),
    }
    for title, df in parts.items():
        print(f"### {title}\n\n```\n{executed(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
