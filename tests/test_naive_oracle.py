"""J2-J4 against an independent nested loop (the reference's row-by-row semantics)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from subledger.operators.invoice_lookup import with_invoice_columns
from subledger.params import Labels, ReportParams

LB = Labels()
P = ReportParams(chosen_month=7, chosen_year=2025, chosen_yearly_start_year=2024,
                 window_month1=6, window_month2=8, window_year=2025, window_yearly_start_year=2024,
                 current_year=2025, last_yearly_start_year=2024)
BILLING = [None, "", "a", "b", "c", "d"]
TYPES = [LB.interval_month, LB.interval_year, "week", None]
STATUSES = ["paid", "open", "void"]
D0 = dt.date(2023, 12, 1)


def naive(sub, invoices):
    """Written from the survey's description, one row at a time, no shortcuts."""
    bid, typ = sub
    if not invoices:
        return ("", "", "")
    if bid is None or bid == "":
        return (LB.cannot_determine, LB.cannot_determine, "")
    mine = [i for i in sorted(invoices, key=lambda i: i[3]) if i[0] == bid]
    chosen = ""
    if typ == LB.interval_month:
        m = [i for i in mine if i[1].month == 7 and i[1].year == 2025]
        chosen = m[0][2] if m else ""
    elif typ == LB.interval_year:
        m = [i for i in mine if dt.date(2024, 7, 1) <= i[1] <= dt.date(2025, 7, 30)]
        chosen = m[0][2] if m else ""
    paid2 = ""
    if typ == LB.interval_month:
        paid2 = "paid" if any(dt.date(2025, 6, 1) <= i[1] <= dt.date(2025, 8, 31) and i[2] == "paid"
                              for i in mine) else ""
    elif typ == LB.interval_year:
        paid2 = "paid" if any(dt.date(2024, 8, 1) <= i[1] <= dt.date(2025, 8, 31) and i[2] == "paid"
                              for i in mine) else ""
    paid = [i for i in mine if i[2] == "paid"]
    if typ == LB.interval_month:
        paid = [i for i in paid if i[1].year == 2025]
    elif typ == LB.interval_year:
        paid = [i for i in paid if i[1] >= dt.date(2024, 1, 1)]
    last = LB.month_names[max(i[1] for i in paid).month - 1] if paid else ""
    return (chosen, paid2, last)


subs_st = st.lists(st.tuples(st.sampled_from(BILLING), st.sampled_from(TYPES)), min_size=1, max_size=25)
inv_st = st.lists(st.tuples(st.sampled_from(BILLING[1:] + [None]), st.integers(0, 700),
                            st.sampled_from(STATUSES)), max_size=60)


@settings(max_examples=12, deadline=None)
@given(subs=subs_st, invs=inv_st)
def test_matches_nested_loop(spark, subs, invs):
    invoices = [(s, D0 + dt.timedelta(days=d), status, seq) for seq, (s, d, status) in enumerate(invs)]
    inv_df = spark.createDataFrame(invoices, "subscription string, created date, status string, seq bigint")
    sub_rows = [(i, b, t) for i, (b, t) in enumerate(subs)]
    sub_df = spark.createDataFrame(sub_rows, "client_sub_id bigint, billing_id string, package_type string")
    got = {r[0]: (r[1], r[2], r[3]) for r in with_invoice_columns(sub_df, inv_df, P).select(
        "client_sub_id", "status_chosen_month", "paid_last_2_months", "last_invoice_month").collect()}
    for i, b, t in sub_rows:
        assert got[i] == naive((b, t), invoices), (b, t)
