"""Composite reports R1-R5 as lazy DataFrame plans.

Nothing here runs an action; the sinks decide when to execute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions.blank import blank_fill
from subledger.functions.dates import parse_ts_lenient, parse_ts_strict
from subledger.functions.tax_id import normalize_tax_id
from subledger.functions.text import full_name, relabel
from subledger.operators.crm import crm_rows
from subledger.operators.invoice_lookup import with_invoice_columns
from subledger.operators.joins import join_plans, retain
from subledger.operators.lifecycle import lifecycle_status
from subledger.operators.line_items import invoice_table
from subledger.params import (
    RAW_INTERVAL_MONTH, RAW_INTERVAL_YEAR, RAW_STATUS_ACTIVE, RAW_STATUS_CANCELED, ReportParams,
)
from subledger.schemas import REPORT_BASE_COLUMNS, REPORT_COLUMNS


def retained_subscriptions(subs: DataFrame, plans: DataFrame, params: ReportParams) -> DataFrame:
    """J1 + F1-F3: user subscriptions joined to their plan, exclusions applied."""
    return retain(join_plans(subs, plans), params)


# Sink-order helper columns: subscriptions first (rank 0) in arrival order, then CRM rows.
ORDER_COLUMNS = ("_source_rank", "_seq")


def _order_cols(df: DataFrame, rank: int) -> list:
    """Arrival order of the source: landed ``seq`` if present, else id descending
    (the booking API is read with order_by=id, ascending=0)."""
    seq = F.col("seq") if "seq" in df.columns else -F.col("id")
    return [F.lit(rank).alias("_source_rank"), seq.cast("bigint").alias("_seq")]


def report_base(subs: DataFrame, plans: DataFrame, params: ReportParams,
                normalise_tax_id: bool = True, keep_order: bool = False) -> DataFrame:
    """R4 / the 15 base columns: flatten, relabel, parse dates, back-fill, tax id.

    ``keep_order`` adds ``_source_rank``/``_seq`` for an ordered export.
    """
    lb = params.labels
    shift = params.clock_shift_hours
    j = retained_subscriptions(subs, plans, params)
    expires = parse_ts_lenient("ends_at", shift)
    tax = F.col("user.default_address.tax_number")
    cols = {
        "client_sub_id": F.col("id"),
        "plan_id": F.col("plan_id"),
        "status": relabel("status", {RAW_STATUS_CANCELED: lb.status_canceled,
                                     RAW_STATUS_ACTIVE: lb.status_active}),
        "purchased_at": parse_ts_strict("created_at", shift),
        "package": F.col("subscription.name"),
        "expires_at": expires,
        "cancelled_at": F.coalesce(parse_ts_lenient("canceled_at", shift), expires),
        "client_id": F.col("user.id"),
        "client_name": full_name("user.name", "user.surname"),
        "email": F.col("user.email"),
        "package_type": relabel("recurring_interval", {RAW_INTERVAL_YEAR: lb.interval_year,
                                                       RAW_INTERVAL_MONTH: lb.interval_month}),
        "billing_id": F.col("stripe_subscription_id"),
        "tax_id": normalize_tax_id(tax) if normalise_tax_id else tax,
        "company_name": blank_fill("user.default_address.name"),
        "phone": blank_fill("user.default_phone.e164"),
    }
    extra = _order_cols(j, 0) if keep_order else []
    return j.select(*[cols[c].alias(c) for c in REPORT_BASE_COLUMNS], *extra)


def report_no_crm(subs: DataFrame, plans: DataFrame, invoices_raw: DataFrame,
                  params: ReportParams, keep_order: bool = False) -> DataFrame:
    """Base columns + the three invoice-derived columns (18 columns)."""
    base = report_base(subs, plans, params, keep_order=keep_order)
    inv = invoice_table(invoices_raw, params, keep_helpers=True)
    return with_invoice_columns(base, inv, params)


def report_with_lifecycle(subs: DataFrame, plans: DataFrame, invoices_raw: DataFrame,
                          params: ReportParams, keep_order: bool = False) -> DataFrame:
    r = report_no_crm(subs, plans, invoices_raw, params, keep_order=keep_order)
    return r.withColumn("lifecycle_status", lifecycle_status("client_sub_id", "expires_at", params))


def subscription_report(subs: DataFrame, plans: DataFrame, invoices_raw: DataFrame,
                        params: ReportParams, crm_tax_ids: DataFrame | None = None,
                        keep_order: bool = False) -> DataFrame:
    """The 19-column report; CRM-only contracts appended when given (Q4: the
    CRM branch is optional, its absence never stops the report)."""
    cols = REPORT_COLUMNS + (ORDER_COLUMNS if keep_order else ())
    r = report_with_lifecycle(subs, plans, invoices_raw, params, keep_order).select(*cols)
    if crm_tax_ids is not None:
        r = r.unionByName(crm_rows(crm_tax_ids, params, keep_order=keep_order))
    return r
