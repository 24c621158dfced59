"""Registered queries: one per operator group of the survey's inventory.

Each query takes ``(spark, sf_dir)``, reads the driver's tables through the
proxy views of ``subledger.sources.proxies`` and returns a lazy DataFrame
over the whole tables. The matching DuckDB SQL lives in
``subledger.plans.oracle``; column names are identical on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.functions.blank import blank_fill
from subledger.functions.dates import parse_ts_lenient, parse_ts_strict
from subledger.functions.tax_id import normalize_tax_id, tax_id10, tax_id_number
from subledger.functions.text import full_name, relabel
from subledger.operators import crm as crm_ops
from subledger.operators import colocated, quarantine, reconcile
from subledger.operators.flatten import flatten_struct, flatten_variant, observed_schema
from subledger.operators.joins import join_plans, retain, retention_predicates
from subledger.operators.lifecycle import lifecycle_status
from subledger.operators.line_items import (
    first_line_item_variant, invoice_fact, invoice_fact_variant, invoice_table, invoices_since,
)
from subledger.operators.quality import (
    completeness, duplicate_ids, required_fields, required_keys, stage_counts,
)
from subledger.params import (
    RAW_INTERVAL_MONTH, RAW_INTERVAL_YEAR, RAW_STATUS_ACTIVE, RAW_STATUS_CANCELED, UTC, ReportParams,
)
from subledger.plans import reports
from subledger.schemas import CRM_TASK, PLAN, USER_SUBSCRIPTION
from subledger.sinks.region import overwrite_region
from subledger.sinks.writers import INVOICE_HEADINGS, REPORT_HEADINGS, format_for_export, report_meta
from subledger.session import keep_small, keep_written, shared_folder
from subledger.sources import cursor
from subledger.sources import landing as landing_src
from subledger.sources import proxies as px

Query = Callable[[SparkSession, str], DataFrame]

# Proxy run parameters (see subledger.sources.proxies.proxy_params).
CRM_PROJECT_ID = "pr3"
NEWEST_N = 1000            # page size 100 x page cap 10
NO_INVOICES_SINCE = dt.datetime(2100, 1, 1, tzinfo=UTC)
USERSUB_REQUIRED = ("id", "subscription_id", "user", "status", "user.id", "stripe_subscription_id")
PLAN_REQUIRED = ("id", "name", "price", "price.recurring_interval")


def P(**kw) -> ReportParams:
    return px.proxy_params(**kw)


def _sources(spark: SparkSession, d: str):
    return px.usersubs(spark, d), px.plans(spark, d), px.invoices_raw(spark, d)


def crm_tax_id(spark, d):
    """P13 over every task with a detail, whatever its status: all value forms."""
    return crm_ops.crm_tax_ids(crm_ops.tasks_with_details(px.crm_tasks(spark, d), px.crm_task_details(spark, d)))


def _crm_tax_ids(spark: SparkSession, d: str, params: ReportParams) -> DataFrame:
    statuses = crm_ops.project_statuses(px.crm_projects(spark, d)
                                        .filter(F.col("project_id") == CRM_PROJECT_ID))
    ids = crm_ops.status_ids_by_name(statuses, params.crm_target_status)
    tasks = crm_ops.tasks_with_details(px.crm_tasks(spark, d), px.crm_task_details(spark, d), ids,
                                       dedupe=params.dedupe_crm_tasks)
    return crm_ops.crm_tax_ids(tasks)


# ---- R1 / R2 / R4 / R5 -----------------------------------------------------------
def subscription_report(spark, d):
    p = P()
    us, pl, inv = _sources(spark, d)
    return reports.subscription_report(us, pl, inv, p, crm_tax_ids=_crm_tax_ids(spark, d, p))


def report_base(spark, d):
    us, pl, _ = _sources(spark, d)
    return reports.report_base(us, pl, P())


def subscriptions_only(spark, d):
    """The subscriptions-only table; tax ids exactly as given."""
    us, pl, _ = _sources(spark, d)
    return reports.report_base(us, pl, P(), normalise_tax_id=False)


def report_no_crm(spark, d):
    us, pl, inv = _sources(spark, d)
    return reports.report_no_crm(us, pl, inv, P())


def report_with_crm(spark, d):
    p = P()
    us, pl, inv = _sources(spark, d)
    base = reports.report_no_crm(us, pl, inv, p)
    return base.unionByName(crm_ops.crm_rows(_crm_tax_ids(spark, d, p), p), allowMissingColumns=True)


def report_no_invoices(spark, d):
    us, pl, inv = _sources(spark, d)
    return reports.report_no_crm(us, pl, inv, P(invoice_since=NO_INVOICES_SINCE))


def invoice_fact_q(spark, d):
    return invoice_fact(px.invoices_raw(spark, d), P())


# ---- joins, filters, projections --------------------------------------------------
def plan_left_join(spark, d):
    us, pl, _ = _sources(spark, d)
    return join_plans(us, pl).select(F.col("id").alias("client_sub_id"), "subscription_id",
                                     "plan_id", "recurring_interval")


def filter_exclusions(spark, d):
    us, pl, _ = _sources(spark, d)
    return retain(join_plans(us, pl), P()).select(
        F.col("id").alias("client_sub_id"), "plan_id", F.col("user.id").alias("client_id"), "status")


def flatten_struct_q(spark, d):
    return flatten_struct(px.usersubs(spark, d), sep="_")


def blank_fill_q(spark, d):
    return px.usersubs(spark, d).select(
        F.col("id").alias("client_sub_id"),
        blank_fill("user.default_phone.e164").alias("phone"),
        blank_fill("user.default_address.name").alias("company_name"))


def full_name_q(spark, d):
    return px.usersubs(spark, d).select(F.col("id").alias("client_sub_id"),
                                        full_name("user.name", "user.surname").alias("client_name"))


def relabel_q(spark, d):
    lb = P().labels
    us, pl, _ = _sources(spark, d)
    return join_plans(us, pl).select(
        F.col("id").alias("client_sub_id"),
        relabel("status", {RAW_STATUS_CANCELED: lb.status_canceled,
                           RAW_STATUS_ACTIVE: lb.status_active}).alias("status"),
        relabel("recurring_interval", {RAW_INTERVAL_YEAR: lb.interval_year,
                                       RAW_INTERVAL_MONTH: lb.interval_month}).alias("package_type"))


def ts_parse(spark, d):
    shift = P().clock_shift_hours
    return px.usersubs(spark, d).select(
        F.col("id").alias("client_sub_id"),
        parse_ts_strict("created_at", shift).alias("purchased_at"),
        parse_ts_lenient("ends_at", shift).alias("expires_at"),
        parse_ts_lenient("canceled_at", shift).alias("cancelled_at"))


def cancel_backfill(spark, d):
    shift = P().clock_shift_hours
    exp = parse_ts_lenient("ends_at", shift)
    return px.usersubs(spark, d).select(
        F.col("id").alias("client_sub_id"),
        F.coalesce(parse_ts_lenient("canceled_at", shift), exp).alias("cancelled_at"))


def tax_id_norm(spark, d):
    raw = F.col("user.default_address.tax_number")
    return px.usersubs(spark, d).select(F.col("id").alias("client_sub_id"), raw.alias("tax_id_raw"),
                                        normalize_tax_id(raw).alias("tax_id"),
                                        tax_id_number(raw).alias("tax_id_num"),
                                        tax_id10(raw).alias("tax_id10"))


# ---- derived invoice columns --------------------------------------------------------
def _derived(spark, d, column):
    return report_no_crm(spark, d).select("client_sub_id", "billing_id", "package_type", column)


def chosen_month_status(spark, d):
    return _derived(spark, d, "status_chosen_month")


def paid_last_2_months(spark, d):
    return _derived(spark, d, "paid_last_2_months")


def last_invoice_month(spark, d):
    return _derived(spark, d, "last_invoice_month")


def lifecycle_status_q(spark, d):
    return report_base(spark, d).select(
        "client_sub_id", "expires_at",
        lifecycle_status("client_sub_id", "expires_at", P()).alias("lifecycle_status"))


# ---- invoices -----------------------------------------------------------------------
def first_line_item(spark, d):
    lb = P().labels
    j = px.invoices_json(spark, d)
    desc, active, interval = first_line_item_variant(F.parse_json(F.col("json")), lb)
    return j.select("id", desc.alias("lines_data_description"), active.alias("plan_active"),
                    interval.alias("plan_interval"))


def invoice_json_fact(spark, d):
    return invoice_fact_variant(px.invoices_json(spark, d), P())


def invoice_since(spark, d):
    return invoices_since(px.invoices_raw(spark, d), P()).select(
        "id", "subscription", F.col("created").alias("created_epoch"))


# ---- landing scans --------------------------------------------------------------------
def newest_n(spark, d):
    return landing_src.newest_n(px.usersubs(spark, d), NEWEST_N).select("id", "status")


def paged_scan(spark, d):
    recs = landing_src.scan_pages(px.landing_pages(spark, d), "usersubs", USER_SUBSCRIPTION)
    return recs.select("page_no", "pos", "id", "subscription_id", "status",
                       F.col("stripe_subscription_id").alias("billing_id"),
                       F.col("user.id").alias("client_id"))


def page_prefix(spark, d):
    recs = landing_src.scan_pages(px.landing_pages(spark, d), "plans", PLAN)
    return recs.select("page_no", "pos", "id", "name",
                       F.col("price.recurring_interval").alias("recurring_interval"))


def page_status(spark, d):
    return landing_src.page_status(landing_src.parse_pages(px.odd_pages(spark, d)), "odd")


def crm_task_pages(spark, d):
    return landing_src.scan_task_pages(px.crm_listing(spark, d), "crm_tasks/all", CRM_TASK).select("page_no", "pos", "_id")


def _scanned(spark, d, prefix_rule=True):
    land = px.landing_pages(spark, d)
    return land, {s: landing_src.scan_pages(land, s, sch, prefix_rule=prefix_rule)
                  for s, sch in (("usersubs", USER_SUBSCRIPTION), ("plans", PLAN))}


def completeness_q(spark, d):
    land, recs = _scanned(spark, d)
    out = None
    for s, r in recs.items():
        c = completeness(land.filter(F.col("source") == s), r, s)
        out = c if out is None else out.unionByName(c)
    return out


def dup_ids(spark, d):
    """A4 over every landed record, beyond a failed page too."""
    _, recs = _scanned(spark, d, prefix_rule=False)
    out = None
    for s, r in recs.items():
        c = duplicate_ids(r, "id", s)
        out = c if out is None else out.unionByName(c)
    return out


# ---- quality ------------------------------------------------------------------------
def required_fields_q(spark, d):
    return (required_fields(px.usersubs(spark, d), USERSUB_REQUIRED, "usersubs")
            .unionByName(required_fields(px.plans(spark, d), PLAN_REQUIRED, "plans")))


def required_keys_q(spark, d):
    """Q1 over every landed record, beyond a failed page too."""
    land = px.landing_pages(spark, d)
    return (required_keys(landing_src.scan_pages_variant(land, "usersubs", prefix_rule=False), USERSUB_REQUIRED, "usersubs")
            .unionByName(required_keys(landing_src.scan_pages_variant(land, "plans", prefix_rule=False), PLAN_REQUIRED,
                                       "plans")))


def stage_counts_q(spark, d):
    us, pl, _ = _sources(spark, d)
    preds = retention_predicates(P())
    return stage_counts(join_plans(us, pl), preds,
                        ["after_plan_filter", "after_status_filter", "after_user_filter"])


# ---- CRM ----------------------------------------------------------------------------
def crm_status_id(spark, d):
    statuses = crm_ops.project_statuses(px.crm_projects(spark, d))
    return crm_ops.status_ids_by_name(statuses, P().crm_target_status)


def crm_tasks_q(spark, d):
    p = P()
    statuses = crm_ops.project_statuses(px.crm_projects(spark, d)
                                        .filter(F.col("project_id") == CRM_PROJECT_ID))
    ids = crm_ops.status_ids_by_name(statuses, p.crm_target_status)
    t = crm_ops.tasks_with_details(px.crm_tasks(spark, d), px.crm_task_details(spark, d), ids)
    return t.select("_id", "status_id", "page_no")


def crm_rows_q(spark, d):
    p = P()
    return crm_ops.crm_rows(_crm_tax_ids(spark, d, p), p)


# ---- sinks ----------------------------------------------------------------------------
def report_export(spark, d):
    return format_for_export(subscription_report(spark, d))


def report_meta_q(spark, d):
    return report_meta(spark, P().as_of.date(), subscription_report(spark, d))


def report_headed(spark, d):
    """The report under its sheet headings."""
    return format_for_export(subscription_report(spark, d), REPORT_HEADINGS)


def invoice_headed(spark, d):
    """The invoice table under its sheet headings."""
    return format_for_export(invoice_json_fact(spark, d), INVOICE_HEADINGS)


def window_across_years(spark, d):
    """An explicit two-month window over the turn of the year."""
    us, pl, inv = _sources(spark, d)
    p = P(window_start=dt.date(1997, 12, 1), window_end=dt.date(1998, 1, 31))
    return reports.report_no_crm(us, pl, inv, p).select("client_sub_id", "billing_id", "package_type", "paid_last_2_months")


# ---- quarantine, runs -----------------------------------------------------------------
def _screened(spark, d):
    shift = P().clock_shift_hours
    us = px.usersubs(spark, d).select(F.col("id").alias("client_sub_id"), "created_at", "ends_at", "canceled_at")
    return quarantine.screened(us, {c: quarantine.timestamp(shift) for c in ("created_at", "ends_at", "canceled_at")})


def ts_accepted(spark, d):
    """The subscriptions all of whose dates could be parsed."""
    return quarantine.accepted(_screened(spark, d))


def ts_quarantine(spark, d):
    """The dates that could not be parsed, with their records."""
    return quarantine.rejected(_screened(spark, d), ["client_sub_id"])


def run_differences(spark, d):
    """Q2, A4: what a later run of the user subscriptions added, dropped, changed or repeated."""
    old = px.usersubs(spark, d).select("id", "subscription_id", "status", "ends_at")
    return reconcile.differences(old, px.next_run(spark, d), ["id"])


# ---- iterative: building them runs jobs ---------------------------------------------
def _cursor_chains(spark, d, *columns):
    """The pages' ``columns``, written where there are any, and the ranked pages; bodies are parsed once."""
    parsed = cursor.parse_cursor_pages(px.cursor_pages(spark, d), keep_written)
    parsed = keep_written(parsed.select(*columns)) if columns else parsed
    return parsed, cursor.chains(parsed, keep_written)


def cursor_pages(spark, d):
    """The place and state of every landed cursor page."""
    _, ranked = _cursor_chains(spark, d)
    return ranked.select("source", F.nullif("cursor", F.lit(cursor.FIRST)).alias("starting_after"), "attempt", "outcome", "n_records", "last_id", "rank", "state")


def cursor_scan(spark, d):
    """Invoices in arrival order, from pages that only cursors order."""
    parsed, ranked = _cursor_chains(spark, d, *cursor.PAGE, "docs")
    rows = cursor.scan_cursor_pages(parsed, ranked)
    return rows.select("source", "rank", "pos", F.try_variant_get("doc", "$.id", "string").alias("id"), F.try_variant_get("doc", "$.created", "bigint").alias("created"))


def flatten_observed(spark, d):
    """User subscriptions flattened by whichever keys their records have."""
    docs = landing_src.scan_pages_variant(px.late_key_pages(spark, d), "usersubs")
    return flatten_variant(docs, observed_schema(docs), sep="_", keep=("page_no", "pos"), json=True)


def region_overwrite(spark, d):
    """K1: the report written into columns C to F of a sheet, whose other cells stay."""
    us, pl, _ = _sources(spark, d)
    report = reports.report_base(us, pl, P()).select("client_sub_id", "status", "package_type", "billing_id")
    region = {"C": "client_sub_id", "D": "status", "E": "package_type", "F": "billing_id"}
    report = report.withColumn("client_sub_id", F.col("client_sub_id").cast("string")).withColumn("_id", F.col("client_sub_id").cast("bigint"))
    return overwrite_region(px.grid(spark, d), report, region, [F.col("_id"), F.col("status"), F.col("package_type"), F.col("billing_id")], keep_small)


def colocated_lookups(spark, d):
    """The three invoice columns from a run's co-located tables, joined bucket beside bucket."""
    us, pl, inv = _sources(spark, d)
    path = f"{shared_folder(spark)}/colocated-{uuid.uuid4().hex}"
    base = reports.report_base(us, pl, P()).select("client_sub_id", "billing_id", "package_type")
    run = colocated.publish(base, invoice_table(inv, P(), keep_helpers=True), P(), path)
    return colocated.lookups(*colocated.read(spark, path, run), P())


ITERATIVE: dict[str, Query] = {
    "colocated_lookups": colocated_lookups,
    "flatten_observed": flatten_observed,
    "region_overwrite": region_overwrite,
    "cursor_pages": cursor_pages,
    "cursor_scan": cursor_scan,
}

QUERIES: dict[str, Query] = {
    "subscription_report": subscription_report,
    "report_base": report_base,
    "subscriptions_only": subscriptions_only,
    "report_no_crm": report_no_crm,
    "report_with_crm": report_with_crm,
    "report_no_invoices": report_no_invoices,
    "invoice_fact": invoice_fact_q,
    "plan_left_join": plan_left_join,
    "filter_exclusions": filter_exclusions,
    "flatten_struct": flatten_struct_q,
    "blank_fill": blank_fill_q,
    "full_name": full_name_q,
    "relabel": relabel_q,
    "ts_parse": ts_parse,
    "cancel_backfill": cancel_backfill,
    "tax_id_norm": tax_id_norm,
    "chosen_month_status": chosen_month_status,
    "paid_last_2_months": paid_last_2_months,
    "last_invoice_month": last_invoice_month,
    "lifecycle_status": lifecycle_status_q,
    "first_line_item": first_line_item,
    "invoice_json_fact": invoice_json_fact,
    "invoice_since": invoice_since,
    "newest_n": newest_n,
    "paged_scan": paged_scan,
    "page_prefix": page_prefix,
    "crm_status_id": crm_status_id,
    "crm_tasks": crm_tasks_q,
    "crm_tax_id": crm_tax_id,
    "crm_rows": crm_rows_q,
    "required_fields": required_fields_q,
    "required_keys": required_keys_q,
    "completeness": completeness_q,
    "dup_ids": dup_ids,
    "stage_counts": stage_counts_q,
    "report_export": report_export,
    "report_meta": report_meta_q,
    "page_status": page_status,
    "crm_task_pages": crm_task_pages,
    "report_headed": report_headed,
    "invoice_headed": invoice_headed,
    "window_across_years": window_across_years,
    "ts_accepted": ts_accepted,
    "ts_quarantine": ts_quarantine,
    "run_differences": run_differences,
}
