"""Hand-made rows of FIXTURES.md §2 with results derived by hand."""

import datetime as dt

import pytest

from subledger.operators.invoice_lookup import with_invoice_columns
from subledger.operators.lifecycle import lifecycle_status
from subledger.params import Labels, ReportParams
from subledger.plans import reports
from subledger.schemas import PLAN, USER_SUBSCRIPTION

LB = Labels()
CANNOT = LB.cannot_determine

PARAMS = ReportParams(
    chosen_month=7, chosen_year=2025, chosen_yearly_start_year=2024,
    window_month1=7, window_month2=8, window_year=2025, window_yearly_start_year=2024,
    current_year=2025, last_yearly_start_year=2024,
    excluded_plan_ids=(4,), excluded_user_ids=(99,),
    as_of=dt.datetime(2025, 8, 15, 12, 0, 0))

INVOICE_SCHEMA = "subscription string, created date, status string, seq bigint"


def _user(uid, surname="Doe"):
    if uid is None:
        return None
    return (uid, "Ann", surname, f"u{uid}@example.com", ("+48111222333",), ("Firm", " 0123456789 "))


def _sub(i, plan, status, billing, uid, created, ends=None, canceled=None, surname="Doe"):
    return (i, plan, status, created, ends, canceled, billing, ("Gold",), _user(uid, surname))


SUBS = [
    _sub(101, 1, "active", "b1", 10, "2025-01-10T22:30:00Z"),
    _sub(102, 2, "active", "b2", 11, "2025-01-10T08:00:00Z", ends="2025-09-01T00:00:00Z"),
    _sub(103, 3, "canceled", "b3", 12, "2025-01-10T08:00:00Z", ends="2025-08-01T00:00:00Z",
         canceled="2025-07-15T10:00:00+02:00"),
    _sub(104, 4, "active", "b4", 13, "2025-01-10T08:00:00Z"),
    _sub(105, 77, "active", "", 14, "2025-01-10T08:00:00Z"),
    _sub(106, 1, "active", "b6", 99, "2025-01-10T08:00:00Z"),
    _sub(107, 1, "trialing", "b7", 15, "2025-01-10T08:00:00Z"),
    _sub(108, 1, "active", None, None, "2025-01-10T08:00:00Z"),
    _sub(109, 1, "active", "b9", 16, "2025-01-10T08:00:00Z", ends="not-a-date", surname=None),
]
PLANS = [(1, "p1", ("month",)), (2, "p2", ("year",)), (3, "p3", ("week",)), (4, "p4", ("month",))]
D = dt.date
INVOICES = [("b1", D(2025, 8, 2), "paid", 0), ("b1", D(2025, 7, 20), "open", 1),
            ("b1", D(2025, 7, 5), "paid", 2), ("b2", D(2025, 7, 31), "paid", 3),
            ("b2", D(2024, 7, 1), "void", 4), ("b3", D(2023, 5, 5), "paid", 5),
            (None, D(2025, 7, 7), "paid", 6)]

EXPECTED = {  # id: (plan_id, type, chosen, last2, last month, lifecycle, cancelled_at)
    101: (1, LB.interval_month, "open", "paid", LB.month_names[7], LB.lifecycle_active, None),
    102: (2, LB.interval_year, "void", "paid", LB.month_names[6], LB.lifecycle_cancelled_active,
          dt.datetime(2025, 9, 1, 2, 0)),
    103: (3, "week", "", "", LB.month_names[4], LB.lifecycle_cancelled, dt.datetime(2025, 7, 15, 12, 0)),
    105: (None, None, CANNOT, CANNOT, "", LB.lifecycle_active, None),
    108: (1, LB.interval_month, CANNOT, CANNOT, "", LB.lifecycle_active, None),
    109: (1, LB.interval_month, "", "", "", LB.lifecycle_active, None),
}


@pytest.fixture(scope="module")
def frames(spark):
    subs = spark.createDataFrame(SUBS, USER_SUBSCRIPTION)
    plans = spark.createDataFrame(PLANS, PLAN)
    inv = spark.createDataFrame(INVOICES, INVOICE_SCHEMA)
    return subs, plans, inv


def _report(frames, invoices):
    subs, plans, _ = frames
    base = reports.report_base(subs, plans, PARAMS)
    r = with_invoice_columns(base, invoices, PARAMS)
    return {row["client_sub_id"]: row for row in
            r.withColumn("lifecycle_status", lifecycle_status("client_sub_id", "expires_at", PARAMS))
            .collect()}


def test_report_rows(frames):
    rows = _report(frames, frames[2])
    assert set(rows) == set(EXPECTED)
    for i, (plan, typ, chosen, last2, last, life, cancelled) in EXPECTED.items():
        r = rows[i]
        assert (r["plan_id"], r["package_type"]) == (plan, typ), i
        assert (r["status_chosen_month"], r["paid_last_2_months"], r["last_invoice_month"]) == \
            (chosen, last2, last), i
        assert r["lifecycle_status"] == life, i
        assert r["cancelled_at"] == cancelled, i


def test_dates_names_and_status(frames):
    rows = _report(frames, frames[2])
    assert rows[101]["purchased_at"] == dt.datetime(2025, 1, 11, 0, 30)
    assert rows[101]["status"] == LB.status_active
    assert rows[103]["status"] == LB.status_canceled
    assert rows[109]["client_name"] is None and rows[109]["expires_at"] is None
    assert rows[101]["client_name"] == "Ann Doe"
    assert rows[108]["client_id"] is None
    assert rows[101]["tax_id"] == "123456789"


def test_zero_invoices_blank_everywhere(frames, spark):
    empty = spark.createDataFrame([], INVOICE_SCHEMA)
    rows = _report(frames, empty)
    assert len(rows) == 6
    for r in rows.values():
        assert (r["status_chosen_month"], r["paid_last_2_months"], r["last_invoice_month"]) == ("", "", "")


def test_first_match_with_null_status_stays_null(frames, spark):
    inv = spark.createDataFrame([("b1", D(2025, 7, 20), None, 0), ("b1", D(2025, 7, 21), "paid", 1)],
                                INVOICE_SCHEMA)
    rows = _report(frames, inv)
    assert rows[101]["status_chosen_month"] is None


def test_arrival_order_decides_first(frames, spark):
    inv = spark.createDataFrame([("b1", D(2025, 7, 5), "paid", 5), ("b1", D(2025, 7, 20), "open", 9)],
                                INVOICE_SCHEMA)
    assert _report(frames, inv)[101]["status_chosen_month"] == "paid"
    inv2 = spark.createDataFrame([("b1", D(2025, 7, 5), "paid", 9), ("b1", D(2025, 7, 20), "open", 5)],
                                 INVOICE_SCHEMA)
    assert _report(frames, inv2)[101]["status_chosen_month"] == "open"


def test_plan_join_fans_out_and_matches_null_keys(spark):
    from subledger.operators.joins import join_plans
    subs = spark.createDataFrame([(1, 7), (2, None), (3, 8)], "id bigint, subscription_id bigint")
    plans = spark.createDataFrame([(7, "a", ("month",)), (7, "b", ("year",)), (None, "n", ("week",))], PLAN)
    got = sorted((r["id"], r["plan_id"], r["recurring_interval"]) for r in join_plans(subs, plans).collect())
    assert got == [(1, 7, "month"), (1, 7, "year"), (2, None, "week"), (3, None, None)]


def test_crm_task_dedupe(spark):
    from subledger.operators.crm import crm_tax_ids, tasks_with_details
    tasks = spark.createDataFrame([("s", "t1"), ("s", "t1"), ("s", "t2"), ("x", "t3")], "status_id string, _id string")
    details = spark.createDataFrame([("t1", '{"client":{"company":{"nip":5}}}'), ("t3", '{}')], "_id string, body string")
    ids = spark.createDataFrame([("p", "s")], "project_id string, status_id string")
    kept = crm_tax_ids(tasks_with_details(tasks, details, ids))
    assert [r["tax_id"] for r in kept.collect()] == ["0000000005", "0000000005"]   # parity: listed twice
    assert kept.count() == 2 and crm_tax_ids(tasks_with_details(tasks, details, ids, dedupe=True)).count() == 1


def test_empty_report_overwrites_to_empty_table(spark, tmp_path):
    from subledger.sinks.writers import current_run, read_report, write_report
    from subledger.schemas import REPORT_COLUMNS
    out = str(tmp_path / "r")
    full = spark.createDataFrame([(1,)], "client_sub_id bigint")
    assert write_report(full, out, out + "_meta", dt.date(2025, 8, 15)) == 1
    empty = full.filter("client_sub_id < 0")
    assert write_report(empty, out, out + "_meta", dt.date(2025, 8, 16)) == 0
    assert read_report(spark, out, out + "_meta").count() == 0
    meta = spark.read.parquet(f"{out}_meta/run={current_run(spark, out + '_meta')}").collect()[0]
    assert (meta["row_count"], str(meta["as_of_date"])) == (0, "2025-08-16")
    assert len(REPORT_COLUMNS) == 19
