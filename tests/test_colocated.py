"""Report and lookup state bucketed alike: no shuffle at the join, hot keys dealt over parts, rows as by the plain lookup."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from subledger.operators import colocated
from subledger.operators.invoice_lookup import with_invoice_columns
from tests.test_skew import N, P, _check, _invoices, _report


def _published(spark, path, **options):
    run = colocated.publish(_report(spark), _invoices(spark), P, path, **options)
    return run, colocated.read(spark, path, run)


def _rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return _published(spark, str(tmp_path_factory.mktemp("colocated")), buckets=16, rows=100)[1]


def test_join_reads_bucket_beside_bucket(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = colocated.lookups(*tables, P)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("SelectedBucketsCount: 16 out of 16") == 2


def test_rows_are_those_of_the_plain_lookup(spark, tables):
    out = colocated.lookups(*tables, P)
    _check(out)
    assert _rows(out) == _rows(with_invoice_columns(_report(spark), _invoices(spark), P))


def test_a_hot_key_is_dealt_over_parts(spark, tables):
    report, state, _ = tables
    hot = report.filter(F.col("billing_id") == "hot")
    parts = {r[0]: r[1] for r in hot.groupBy(colocated.PART).count().collect()}
    assert len(parts) == N // 3 // 100 and max(parts.values()) < 2 * 100
    assert state.filter(F.col(colocated.KEY) == "hot").count() == len(parts)
    assert state.filter(F.col(colocated.KEY) != "hot").filter(F.col(colocated.PART) > 0).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = colocated.lookups(*tables, P).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) == 16 and max(r[1] for r in tasks) < N // 3


def test_another_session_registers_the_latest_run(spark, tmp_path):
    path = str(tmp_path)
    _published(spark, path, run="a", buckets=2)
    colocated.publish(_report(spark).limit(0), _invoices(spark).limit(0), P, path, run="b", buckets=3)
    for run in "ab":
        for side in ("report", "state"):
            spark.sql(f"DROP TABLE {colocated._table_name(f'{path}/{side}/run={run}')}")
    report, state, has_invoices = colocated.read(spark, path)
    assert report.isEmpty() and state.isEmpty() and not has_invoices
    first = colocated.read(spark, path, "a")
    assert _rows(colocated.lookups(*first, P)) == _rows(with_invoice_columns(_report(spark), _invoices(spark), P))


def test_unfinished_runs_do_not_count(spark, tmp_path):
    run, _ = _published(spark, str(tmp_path), run="a", buckets=2)
    _report(spark).write.parquet(f"{tmp_path}/report/run=z")
    assert colocated.read(spark, str(tmp_path))[0].count() == N
    with pytest.raises(ValueError, match="no published run"):
        colocated.read(spark, str(tmp_path), "z")


def test_no_invoices_leave_the_columns_empty(spark, tmp_path):
    colocated.publish(_report(spark), _invoices(spark).limit(0), P, str(tmp_path), buckets=2)
    out = colocated.lookups(*colocated.read(spark, str(tmp_path)), P)
    assert out.filter("status_chosen_month = '' AND paid_last_2_months = '' AND last_invoice_month = ''").count() == N


def test_clashing_names(spark, tmp_path):
    extra = _report(spark).withColumn("first_m", F.lit("own")).withColumn("status", F.lit(None).cast("string"))
    colocated.publish(extra, _invoices(spark), P, f"{tmp_path}/x", buckets=2)
    out = colocated.lookups(*colocated.read(spark, f"{tmp_path}/x"), P)
    assert out.filter("first_m = 'own' AND status IS NULL").count() == N
    _check(out)
    with pytest.raises(ValueError, match="_part"):
        colocated.publish(extra.withColumn("_part", F.lit(1)), _invoices(spark), P, f"{tmp_path}/y", buckets=2)
