"""Write the driver's test tables as a complete landing table (Parquet, partitioned by source).

Usage: python tools/land_testdata.py SF_DIR OUT_PATH
Then:  python -m subledger.plans.job --landing OUT_PATH --landing-format parquet --output ...
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from subledger.session import build_session  # noqa: E402
from subledger.sources.proxies import complete_landing  # noqa: E402


def main() -> None:
    sf_dir, out = sys.argv[1], sys.argv[2]
    spark = build_session("local[8]")
    complete_landing(spark, sf_dir).write.mode("overwrite").partitionBy("source").parquet(out)
    print(spark.read.parquet(out).groupBy("source").count().orderBy("source").collect())
    spark.stop()


if __name__ == "__main__":
    main()
