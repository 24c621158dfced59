"""J2-J4 as a kept state, J5 behind a Bloom filter."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from subledger.functions.membership import bloom_filter
from subledger.operators import lookup_state
from subledger.operators.crm import tasks_with_details
from subledger.operators.invoice_lookup import invoice_aggregates, with_invoice_columns, with_lookup_state
from subledger.params import Labels, ReportParams

LB = Labels()
P = ReportParams(chosen_month=7, chosen_year=2025, chosen_yearly_start_year=2024, window_month1=6, window_month2=8, window_year=2025,
                 window_yearly_start_year=2024, current_year=2025, last_yearly_start_year=2024)
SCHEMA = "id string, subscription string, created date, status string, seq long"


def invoices(seed, n=400):
    rng = random.Random(seed)
    return [(f"in{k}", rng.choice(["a", "b", "c", "d", "hot", "hot", "", None]), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 700)),
             rng.choice(["paid", "open", None]), k) for k in range(n)]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_state_after_batches_equals_the_whole(spark, batches):
    data = invoices(batches)
    random.Random(1).shuffle(data)
    whole = invoice_aggregates(spark.createDataFrame(data, SCHEMA), P)
    state = invoice_aggregates(spark.createDataFrame([], SCHEMA), P)
    for k in range(batches):
        state = lookup_state.updated(state, spark.createDataFrame(data[k::batches], SCHEMA), P)
    assert rows(state) == rows(whole)
    again = lookup_state.updated(state, spark.createDataFrame(data[:50], SCHEMA), P)  # a batch that is landed again
    assert rows(again) == rows(whole)


def test_corrected_pages_retract(spark):
    old = invoices(5)
    new = [(i, "moved" if k % 40 == 0 else s, d, "void" if k % 30 == 0 else t, q) for k, (i, s, d, t, q) in enumerate(old) if k % 70]
    gone = [r for r in old if r not in new]
    state = invoice_aggregates(spark.createDataFrame(old, SCHEMA), P)
    corrected = spark.createDataFrame(gone + [r for r in new if r not in old], SCHEMA)
    got = lookup_state.retracted(state, corrected, spark.createDataFrame(new, SCHEMA), P)
    assert rows(got) == rows(invoice_aggregates(spark.createDataFrame(new, SCHEMA), P))


def test_the_report_reads_a_published_state(spark, tmp_path):
    inv = spark.createDataFrame(invoices(9), SCHEMA)
    report = spark.createDataFrame([(k, b, t) for k, (b, t) in enumerate((b, t) for b in ("a", "hot", "none", "", None) for t in (LB.interval_month, LB.interval_year, "week"))],
                                   "client_sub_id long, billing_id string, package_type string")
    path = str(tmp_path)
    lookup_state.publish(invoice_aggregates(inv.limit(0), P), path, "1")
    lookup_state.publish(invoice_aggregates(inv, P), path, "2")
    invoice_aggregates(inv.limit(5), P).write.parquet(f"{path}/state/run=3")  # a run that ended without its marker
    got = with_lookup_state(report, lookup_state.current(spark, path), F.lit(True), P)
    assert rows(got) == rows(with_invoice_columns(report, inv, P))


def test_bloom_filter_keeps_all_wanted_ids(spark):
    ids = spark.range(3000).select(F.concat(F.lit("t"), F.col("id") * 7).alias("i")).unionByName(spark.createDataFrame([(None,)], "i string"))
    test = bloom_filter(ids, "i", 1 << 16)
    every = spark.range(21000).select(F.concat(F.lit("t"), F.col("id")).alias("i"))
    passed = every.filter(test("i"))
    assert passed.join(ids, "i", "left_semi").count() == 3000 and passed.count() < 3000 + 0.03 * 18000
    assert ids.filter(test("i")).count() == 3000
    assert every.filter(bloom_filter(ids.limit(0), "i")("i")).count() == 0


def test_details_are_pruned_before_the_shuffle(spark):
    tasks = spark.createDataFrame([(f"t{k}", "st1" if k % 50 == 0 else "st2") for k in range(2000)], "_id string, status_id string")
    details = spark.range(2000).filter("id % 3 <> 0").select(F.concat(F.lit("t"), F.col("id")).alias("_id"), F.format_string('{"n":%d}', "id").alias("body"))
    wanted = spark.createDataFrame([("pr", "st1")], "project_id string, status_id string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("bloom", "")
    try:
        joined = tasks_with_details(tasks, details, wanted)
        assert not tracker.getJobIdsForGroup("bloom")  # no ids are collected
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["_id"] for r in joined.collect()} == {f"t{k}" for k in range(0, 2000, 50) if k % 3}
    test = bloom_filter(tasks.filter("status_id = 'st1'"), "_id")
    assert details.filter(test("_id")).count() < 40  # of 1 333
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "CartesianProduct" not in plan
