"""Column functions: tax ids, blanks, names, relabels, dates, month ends."""

import datetime as dt

from pyspark.sql import functions as F

from subledger.functions import (
    blank_fill, crm_tax_id, epoch_to_local_date, full_name, is_blank, month_name,
    normalize_tax_id, parse_ts_lenient, relabel, tax_id_number,
)
from subledger.functions.tax_id import tax_id10
from subledger.params import Labels, ReportParams


def _one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_report_tax_id(spark):
    vals = [" 0123456789 ", "123-456-78-90", "00", "", None, "\t42\n", "PL 12"]
    assert _one_col(spark, vals, normalize_tax_id) == \
        ["123456789", "123-456-78-90", "0", "", None, "42", "PL 12"]
    assert _one_col(spark, vals, tax_id_number, ) == [123456789, None, 0, None, None, 42, None]
    assert _one_col(spark, ["123-456-78-90", "12", "abc"], tax_id10) == ["1234567890", "0000000012", None]


def test_crm_tax_id(spark):
    docs = ['{"client":{"company":{"nip":123456789}}}', '{"client":{"company":{"nip":1234567890.0}}}',
            '{"client":{"company":{"nip":12345678901}}}', '{"client":{"company":{"nip":0}}}',
            '{"client":{"company":{"nip":-5}}}', '{"client":{"company":{"nip":"123"}}}',
            '{"_id":"x"}', '{"client":{"company":{"nip":""}}}', '{"client":"str"}',
            '{"client":{"company":{}}}', '{"client":{"company":{"nip":null}}}',
            '{"client":{"company":{"nip":true}}}']
    out = _one_col(spark, docs, lambda c: crm_tax_id(F.parse_json(c)))
    assert out == ["0123456789", "1234567890", "12345678901", "", "", "123", "", "", "", "", "",
                   "0000000001"]


def test_blank_name_relabel(spark):
    assert _one_col(spark, [None, "", "x"], is_blank) == [True, True, False]
    assert _one_col(spark, [None, "x"], blank_fill) == ["", "x"]
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, "B")], "a string, b string")
    assert [r[0] for r in df.select(full_name("a", "b")).collect()] == ["A B", None, None]
    lab = lambda c: relabel(c, {"canceled": "X", "active": "Y"})
    assert _one_col(spark, ["canceled", "active", "trial", None], lab) == ["X", "Y", "trial", None]


def test_lenient_parse_and_shift(spark):
    vals = ["2025-01-10T22:30:00Z", "2025-07-15T10:00:00+02:00", "not-a-date", "", None]
    out = _one_col(spark, vals, lambda c: parse_ts_lenient(c, 2))
    assert out == [dt.datetime(2025, 1, 11, 0, 30), dt.datetime(2025, 7, 15, 12, 0), None, None, None]


def test_epoch_to_local_date(spark):
    # 2025-06-30 22:00 UTC is already 1 July in Warsaw (summer time)
    assert _one_col(spark, [1751320800], lambda c: epoch_to_local_date(c, "UTC"), "bigint") == \
        [dt.date(2025, 6, 30)]
    assert _one_col(spark, [1751320800], lambda c: epoch_to_local_date(c, "Europe/Warsaw"), "bigint") == \
        [dt.date(2025, 7, 1)]


def test_month_name(spark):
    names = Labels().month_names
    out = _one_col(spark, [dt.date(2025, 1, 3), dt.date(2025, 12, 31), None],
                   lambda c: month_name(c, names), "date")
    assert out == [names[0], names[11], ""]


def test_month_end_clamping():
    p = ReportParams(chosen_month=2, chosen_year=2024, window_month2=9, window_year=2025)
    assert p.chosen_yearly_range()[1] == dt.date(2024, 2, 29)
    assert p.window_monthly_range()[1] == dt.date(2025, 9, 30)
    assert ReportParams(window_month2=8).window_monthly_range()[1] == dt.date(2025, 8, 31)
    assert ReportParams(chosen_month=12).chosen_monthly_range() == (dt.date(2025, 12, 1), dt.date(2026, 1, 1))
    assert ReportParams().invoice_since_epoch() == 1719792000


def test_epoch_date_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        # 2025-06-30 22:00 UTC: still 30 June in UTC, already 1 July in Warsaw, whatever the session says
        assert _one_col(spark, [1751320800], lambda c: epoch_to_local_date(c, "UTC"), "bigint") == \
            [dt.date(2025, 6, 30)]
        assert _one_col(spark, [1751320800], lambda c: epoch_to_local_date(c, "Europe/Warsaw"),
                        "bigint") == [dt.date(2025, 7, 1)]
        # winter: UTC+1
        assert _one_col(spark, [1735686000], lambda c: epoch_to_local_date(c, "Europe/Warsaw"),
                        "bigint") == [dt.date(2025, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_params_from_settings_file_layout():
    cfg = {"date_settings": {
        "invoice_status_chosen_month": {"month": 3, "year": 2026, "yearly_subscription_start_year": 2025},
        "invoice_status_last_2_months": {"month1": 2, "month2": 3, "year": 2026,
                                         "yearly_subscription_start_year": 2025},
        "last_invoice_month": {"current_year": 2026, "yearly_subscription_start_year": 2025}},
        "stripe_fetch_settings": {"filter_date": {"year": 2025, "month": 3, "day": 1}}}
    p = ReportParams.from_config(cfg, excluded_plan_ids=(5,))
    assert (p.chosen_month, p.chosen_year, p.chosen_yearly_start_year) == (3, 2026, 2025)
    assert p.window_monthly_range() == (dt.date(2026, 2, 1), dt.date(2026, 3, 31))
    assert p.chosen_yearly_range() == (dt.date(2025, 3, 1), dt.date(2026, 3, 30))
    assert p.last_yearly_start() == dt.date(2025, 1, 1) and p.excluded_plan_ids == (5,)
    assert p.invoice_since_epoch() == int(dt.datetime(2025, 3, 1, tzinfo=dt.timezone.utc).timestamp())
