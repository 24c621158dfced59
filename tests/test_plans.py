"""Plan shape: the plans we want, not just the right rows."""

import re


import __spark_entry__ as E
from subledger.params import ReportParams
from subledger.operators.line_items import invoices_since

SF = "/root/testdata/sf0.001"


def _plan(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() if mode == "exec" else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_no_python_udf_in_any_query(spark):
    for name, fn in E.QUERIES.items():
        plan = _plan(fn(spark, SF))
        assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas",
                             plan), name


def test_no_cross_join_anywhere(spark):
    for name, fn in E.QUERIES.items():
        plan = _plan(fn(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_plan_join_stays_left_outer(spark):
    plan = _plan(E.queries()["filter_exclusions"](spark, SF))
    assert "LeftOuter" in plan


def test_invoice_lookup_plain_shuffles_into_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = E.QUERIES["report_no_crm"](spark, SF)  # unconfigured: keep the test's settings
        plan = _plan(df, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = re.findall(r"Exchange hashpartitioning\((.+?), \d+\), ENSURE_REQUIREMENTS", plan)
    keys = sorted(re.sub(r"#\d+L?", "", k) for k in exchanges)
    # the plan join's sides, the aggregation, and two plain shuffles into the invoice join
    assert keys.count("subscription") == 1 and keys.count("_inv_key, _inv_hash") == 1 and keys.count("subscription, _sub_hash") == 1, keys
    assert len(keys) == 5 and "SortMergeJoin" in plan and "partial_max" in plan


def test_building_queries_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    try:
        for name, fn in E.QUERIES.items():
            fn(spark, SF)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_invoice_lower_bound_reaches_parquet(spark, tmp_path):
    raw = E.QUERIES["invoice_fact"].__globals__["px"].invoices_raw(spark, SF)
    path = str(tmp_path / "inv")
    raw.write.parquet(path)
    plan = _plan(invoices_since(spark.read.parquet(path), ReportParams()).select("id"))
    assert re.search(r"PushedFilters: \[IsNotNull\(created\), GreaterThanOrEqual\(created,", plan)
    assert "ReadSchema: struct<id:string,created:bigint>" in plan


def test_blank_billing_ids_do_not_share_one_key(spark):
    df = E.QUERIES["report_no_crm"](spark, SF)
    assert "\\u0000blank:" in _plan(df) or "blank:" in _plan(df)
