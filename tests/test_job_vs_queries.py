"""The report job over landed pages reproduces the registered report query row for row."""

import __spark_entry__ as E
from subledger.plans.job import JobConfig, run_report
from subledger.sinks.writers import read_report
from subledger.sources.proxies import complete_landing, proxy_params

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_job_equals_query(spark, tmp_path):
    land = str(tmp_path / "landing")
    complete_landing(spark, SF).write.partitionBy("source").parquet(land)
    out = str(tmp_path / "out")
    n = run_report(spark, JobConfig(land, out, landing_format="parquet"), proxy_params())
    want = E.queries()["subscription_report"](spark, SF)
    assert n == want.count()
    assert _rows(read_report(spark, f"{out}/report", f"{out}/report_meta")) == _rows(want)
