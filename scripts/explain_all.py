"""Write the physical plan, before adaptive re-planning, of every query of the catalog to docs/PLANS.md.

    python scripts/explain_all.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tracewright.plans.catalog import QUERIES  # noqa: E402
from tracewright.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    out = [f"# Physical plans before adaptive re-planning ({os.path.basename(sf_dir)}, local[8])", ""]
    out.append("Generated by `scripts/explain_all.py`. Lines are cut at 400 characters; `#id` suffixes removed.")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        n_ex = len(re.findall(r"Exchange hashpartitioning|Exchange RoundRobin|Exchange SinglePartition", plan))
        out += ["", f"## {name}", "", f"shuffle exchanges: {n_ex}", "", "```"]
        out += [line[:400] for line in plan.strip().split("\n")]
        out += ["```"]
    docs = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs")
    os.makedirs(docs, exist_ok=True)
    with open(os.path.join(docs, "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
