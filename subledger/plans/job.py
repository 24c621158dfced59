"""The report job end to end: landed pages -> report -> sinks.

This is the counterpart of the reference's ``main()``: parse every landed body
once into the record table, check the page index, build the report lazily from
the records and write it as a run of its own, the run-metadata row last.
Actions: the two landing writes, one bounded collect of the page checks (a row
a source), the CRM branch's one-row status lookup and its tax ids (written
apart, so that nothing in it can stop the report), the optional quality tables
and the report itself.

Landing sources (rows of the landing table, see ``schemas.LANDING_PAGE``):

* ``plans``, ``usersubs``: pages from 1, body = JSON array of records
* ``invoices``: pages in arrival order from 1, body = JSON array of invoices
* ``crm_project``: one page, body = the project document (with ``statuses``)
* ``crm_tasks/<status id>``: task-list pages from 0, body = JSON array of ``{_id}``
* ``crm_task_details``: pages whose body is a JSON array of task detail documents

Modes: ``report`` (R1), ``no-crm`` (R2), ``checked`` (R3: R2 with the quality
tables), ``subscriptions`` (R4), ``invoices`` (R5).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import warnings
import zoneinfo
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.functions.tax_id import tax_id10
from subledger.operators import crm as crm_ops
from subledger.operators.line_items import invoice_table
from subledger.operators.quality import EmptySourceError, check_gaps, completeness, duplicate_ids, required_keys
from subledger.params import ReportParams
from subledger.plans import reports
from subledger.schemas import CRM_TASK, PLAN, USER_SUBSCRIPTION
from subledger.sinks.writers import INVOICE_HEADINGS, REPORT_HEADINGS, new_run, write_invoice_fact, write_report
from subledger.sources.landing import page_gaps, read_landing, scan_records, scan_task_records
from subledger.sources.records import land_records, read_invoices

MODES = ("report", "no-crm", "checked", "subscriptions", "invoices")

# The fields every record must carry.
USERSUB_REQUIRED = ("id", "subscription_id", "user", "status", "user.id", "stripe_subscription_id")
PLAN_REQUIRED = ("id", "name", "price", "price.recurring_interval")


@dataclass(frozen=True)
class JobConfig:
    landing_path: str
    output_path: str
    landing_format: str = "json"
    report_format: str = "parquet"
    # page cap per source (the reference's current job reads at most 10 pages)
    max_pages: int | None = None
    # a scan that leaves pages out: 'fail', or the contiguous prefix with a warning ('warn') or without ('ignore')
    on_gap: str = "fail"
    write_invoices: bool = False         # K3 (archived jobs only)
    with_crm: bool = True
    # sheet order: subscriptions in arrival order, then CRM rows (a range sort)
    ordered: bool = False
    mode: str = "report"
    headings: bool = False               # sheet headings instead of column names
    validate: bool = False               # write the quality tables (Q1, Q2, A4)
    tax_id10: bool = False               # D9: add the canonical ten-digit tax id


@dataclass
class Inputs:
    records: DataFrame
    index: DataFrame
    subs: DataFrame
    plans: DataFrame
    invoices: DataFrame
    crm_tax_ids: DataFrame | None


def _crm_tax_ids(records: DataFrame, index: DataFrame, params: ReportParams, path: str) -> DataFrame | None:
    """The CRM branch, executed: its tax ids are written to ``path`` and read back."""
    ok = records.filter(F.col("outcome") == "ok")
    project = ok.filter(F.col("source") == "crm_project").select(F.lit("project").alias("project_id"), F.to_json("doc").alias("body"))
    status = crm_ops.status_ids_by_name(crm_ops.project_statuses(project), params.crm_target_status)
    row = status.first()  # one row: the project's status
    if row is None or row["status_id"] is None:
        warnings.warn(f"CRM status {params.crm_target_status!r} not found", stacklevel=2)
        return None
    source = f"crm_tasks/{row['status_id']}"
    check_gaps(page_gaps(records, source, first_page=0, stop_on_empty=False, index=index), "warn")
    tasks = scan_task_records(records, source, CRM_TASK, index=index).select("_id", "seq", F.lit(row["status_id"]).alias("status_id"))
    order = F.struct("run_id", "page_no", "attempt", "pos")
    details = ok.filter(F.col("source") == "crm_task_details").select(
        F.try_variant_get("doc", "$._id", "string").alias("_id"), F.to_json("doc").alias("body"), order.alias("seq"))
    joined = crm_ops.tasks_with_details(tasks, details, dedupe=params.dedupe_crm_tasks)
    crm_ops.crm_tax_ids(joined).write.mode("overwrite").parquet(path)
    return records.sparkSession.read.parquet(path)


def load_inputs(spark: SparkSession, cfg: JobConfig, params: ReportParams, run: str | None = None) -> Inputs:
    land = read_landing(spark, cfg.landing_path, cfg.landing_format)
    landed = f"{cfg.output_path}/landed/run={run or new_run()}"  # a run's own: no other run writes or reads it
    records, index = land_records(land, landed)
    rules = {"max_pages": cfg.max_pages, "index": index}
    gaps = None
    for source in ("plans", "usersubs", "invoices"):
        one = page_gaps(records, source, **rules)
        gaps = one if gaps is None else gaps.unionByName(one)
    found = {r["source"]: r for r in check_gaps(gaps, cfg.on_gap)}
    for source, name in (("plans", "plan"), ("usersubs", "user subscription")):
        if cfg.mode != "invoices" and not found[source]["records"]:
            raise EmptySourceError(f"no {name} records: the report cannot be built")
    crm = None
    if cfg.mode == "report" and cfg.with_crm and params.crm_target_status:
        try:  # Q4: the CRM branch is optional; its failure never stops the report
            crm = _crm_tax_ids(records, index, params, f"{landed}/crm_tax_ids")
        except Exception as exc:  # noqa: BLE001
            warnings.warn(f"CRM branch skipped: {exc}", stacklevel=2)
    plans = scan_records(records, "plans", PLAN, **rules).drop("page_no", "pos", "seq")
    subs = scan_records(records, "usersubs", USER_SUBSCRIPTION, **rules).drop("page_no", "pos")
    return Inputs(records, index, subs, plans, read_invoices(records, params, **rules), crm)


def write_quality(inp: Inputs, path: str, max_pages: int | None = None) -> None:
    """Q1, Q2 and A4 over every record that counts: three small tables."""
    tables: dict[str, DataFrame] = {}
    for source, fields in (("usersubs", USERSUB_REQUIRED), ("plans", PLAN_REQUIRED)):
        docs = scan_records(inp.records, source, max_pages=max_pages, index=inp.index)
        ids = docs.select(F.try_variant_get("doc", "$.id", "bigint").alias("id"))
        pages = inp.index.filter(F.col("source") == source)
        for name, one in (("required_keys", required_keys(docs, fields, source)), ("completeness", completeness(pages, docs, source)),
                          ("duplicate_ids", duplicate_ids(ids, "id", source))):
            tables[name] = tables[name].unionByName(one) if name in tables else one
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def run_report(spark: SparkSession, cfg: JobConfig, params: ReportParams) -> int:
    """Build and write the report of ``cfg.mode``; returns the number of rows written."""
    if cfg.mode not in MODES:
        raise ValueError(f"mode {cfg.mode!r} is none of {MODES}")
    if params.as_of is None:  # one "now", on the local wall clock, for the stamp and the lifecycle status
        now = dt.datetime.now(zoneinfo.ZoneInfo(params.local_timezone)).replace(tzinfo=None)
        params = dataclasses.replace(params, as_of=now)
    out, run = cfg.output_path, new_run()
    inp = load_inputs(spark, cfg, params, run)
    if cfg.validate or cfg.mode == "checked":
        write_quality(inp, f"{out}/quality", cfg.max_pages)
    if cfg.mode == "subscriptions":
        report = reports.report_base(inp.subs, inp.plans, params, normalise_tax_id=False, keep_order=cfg.ordered)
    elif cfg.mode == "invoices":
        report = invoice_table(inp.invoices, params)
    elif cfg.mode == "report":
        report = reports.subscription_report(inp.subs, inp.plans, inp.invoices, params, crm_tax_ids=inp.crm_tax_ids, keep_order=cfg.ordered)
    else:
        report = reports.report_no_crm(inp.subs, inp.plans, inp.invoices, params, keep_order=cfg.ordered)
    if cfg.tax_id10 and "tax_id" in report.columns:
        report = report.withColumn("tax_id10", tax_id10("tax_id"))
    ordered = cfg.ordered and cfg.mode != "invoices"
    headings = (INVOICE_HEADINGS if cfg.mode == "invoices" else REPORT_HEADINGS) if cfg.headings else None
    rows = write_report(report, f"{out}/report", f"{out}/report_meta", params.as_of.date(), fmt=cfg.report_format, headings=headings,
                        order_by=list(reports.ORDER_COLUMNS) if ordered else None, run=run)
    if cfg.write_invoices:
        write_invoice_fact(invoice_table(inp.invoices, params), f"{out}/invoices", fmt=cfg.report_format, headings=INVOICE_HEADINGS if cfg.headings else None)
    return rows


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m subledger.plans.job --landing L --output O [--config settings.json] ...``"""
    import argparse
    import json

    ap = argparse.ArgumentParser(prog="subledger-report", description=main.__doc__)
    ap.add_argument("--landing", required=True, help="landing table path (pages)")
    ap.add_argument("--output", required=True, help="output folder (report, report_meta, invoices)")
    ap.add_argument("--landing-format", default="json")
    ap.add_argument("--report-format", default="parquet")
    ap.add_argument("--config", help="settings file with date_settings / stripe_fetch_settings")
    ap.add_argument("--exclude-plans", default="", help="comma-separated plan ids")
    ap.add_argument("--exclude-users", default="", help="comma-separated user ids")
    ap.add_argument("--crm-status", help="CRM status name whose contracts are appended")
    ap.add_argument("--as-of", help="'YYYY-MM-DD HH:MM:SS' for the lifecycle status (default: now)")
    ap.add_argument("--local-timezone", default="UTC", help="zone of invoice calendar dates")
    ap.add_argument("--max-pages", type=int, help="page cap per source")
    ap.add_argument("--on-gap", default="fail", choices=["ignore", "warn", "fail"])
    ap.add_argument("--mode", default="report", choices=MODES)
    ap.add_argument("--headings", action="store_true", help="sheet headings instead of column names")
    ap.add_argument("--validate", action="store_true", help="write required keys, completeness and duplicate ids")
    ap.add_argument("--tax-id10", action="store_true", help="add the ten-digit tax id")
    ap.add_argument("--window-start", type=dt.date.fromisoformat, help="explicit two-month window, first day")
    ap.add_argument("--window-end", type=dt.date.fromisoformat, help="explicit two-month window, last day")
    ap.add_argument("--write-invoices", action="store_true")
    ap.add_argument("--ordered", action="store_true", help="sheet order (a global sort)")
    a = ap.parse_args(argv)

    ids = lambda s: tuple(int(x) for x in s.split(",") if x.strip())
    cfg = {}
    if a.config:
        with open(a.config, encoding="utf-8") as fh:
            cfg = json.load(fh)
    params = ReportParams.from_config(
        cfg, excluded_plan_ids=ids(a.exclude_plans), excluded_user_ids=ids(a.exclude_users),
        crm_target_status=a.crm_status, local_timezone=a.local_timezone,
        window_start=a.window_start, window_end=a.window_end,
        as_of=dt.datetime.strptime(a.as_of, "%Y-%m-%d %H:%M:%S") if a.as_of else None)
    from subledger.session import configure
    spark = configure(SparkSession.builder.appName("subledger-report").getOrCreate())
    rows = run_report(spark, JobConfig(a.landing, a.output, a.landing_format, a.report_format,
                                       a.max_pages, a.on_gap, a.write_invoices,
                                       with_crm=bool(a.crm_status), ordered=a.ordered, mode=a.mode,
                                       headings=a.headings, validate=a.validate, tax_id10=a.tax_id10), params)
    print(json.dumps({"report_rows": rows, "output": a.output}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
