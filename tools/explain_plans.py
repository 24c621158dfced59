"""Print the physical plans of registered queries as Spark plans them for large inputs.

Static broadcast by size estimate is turned off and AQE is off, so the plan
shows the shuffles a large run would do. Plans of more than LONG lines are
left out unless their queries are named.
Usage: python tools/explain_plans.py [sf_dir] [query ...] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from subledger.plans.catalog import QUERIES  # noqa: E402
from subledger.session import build_session  # noqa: E402


LONG = 90


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("# Physical plans as planned for large inputs\n")
    print("Generated by `tools/explain_plans.py` (static broadcast off, AQE off; expression ids and "
          "long expression lists shortened).\n")
    for name in names:
        df = QUERIES[name](spark, sf)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        lines = []
        for line in plan.splitlines():
            if not line.strip() or line.startswith("=="):
                continue
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[([^\]]{100})[^\]]*\]", r"[\1…]", line)
            lines.append(line[:220])
        if len(lines) > LONG and not sys.argv[2:]:
            print(f"## {name}\n\n{len(lines)} lines: `python tools/explain_plans.py {sf} {name}`\n")
            continue
        print(f"## {name}\n\n```\n" + "\n".join(lines) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
