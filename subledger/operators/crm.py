"""CRM-only contracts appended to the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions.membership import bloom_filter
from subledger.functions.tax_id import EDGE_SPACE, crm_tax_id
from subledger.params import ReportParams
from subledger.schemas import CRM_PROJECT, REPORT_COLUMNS



def project_statuses(projects: DataFrame) -> DataFrame:
    """Project documents (``project_id, body`` JSON) -> one row per status with its position."""
    doc = F.from_json(F.col("body"), CRM_PROJECT)
    return (projects.select(F.col("project_id"), F.posexplode(doc.getField("statuses")).alias("pos", "s"))
            .select("project_id", "pos", F.col("s._id").alias("_id"), F.col("s.name").alias("name")))


def status_ids_by_name(statuses: DataFrame, name: str) -> DataFrame:
    """per project, the first status (by position) whose name, stripped of white space, equals ``name``.

    Projects without such a status get NULL. The status list of one project is
    small; the grouping is by project.
    """
    hit = F.regexp_replace("name", EDGE_SPACE, "") == F.lit(name.strip())
    return (statuses.groupBy("project_id")
            .agg(F.min(F.when(hit, F.struct(F.col("pos"), F.col("_id")))).getField("_id").alias("status_id")))


def listed_tasks(tasks: DataFrame, status_ids: DataFrame | None, dedupe: bool = False) -> DataFrame:
    """Tasks of the wanted statuses (all, for None). ``dedupe`` keeps a task listed twice
    (a task-list page delivered again) once, at its first place."""
    if status_ids is not None:
        wanted = status_ids.filter(F.col("status_id").isNotNull()).select("status_id").distinct()
        tasks = tasks.join(wanted, "status_id", "left_semi")
    if dedupe:
        order = [c for c in ("seq", "page_no", "status_id") if c in tasks.columns]
        rest = [c for c in tasks.columns if c not in ("_id", *order)]
        first = F.min(F.struct(*order, *rest)).alias("_first")
        tasks = tasks.groupBy("_id").agg(first).select("_id", "_first.*").select(*tasks.columns)
    return tasks


def tasks_with_details(tasks: DataFrame, details: DataFrame, status_ids: DataFrame | None = None,
                       dedupe: bool = False) -> DataFrame:
    """S5 + S7 + J5: tasks of the wanted statuses joined to their detail documents.

    Tasks whose detail is missing, was answered with an error or does not parse
    are dropped. A detail landed more than once counts once: its latest
    (largest ``seq``, if there is one) readable document. Details that no listed
    task can have (by a Bloom filter of the listed ids) are neither parsed nor shuffled.
    """
    latest = F.col("seq") if "seq" in details.columns else F.lit(0)
    listed = listed_tasks(tasks, status_ids, dedupe)
    docs = (details.filter(bloom_filter(listed.select("_id"), "_id")("_id")).select("_id", F.col("body"), latest.alias("_at"))
            .where(F.try_parse_json("body").isNotNull())
            .groupBy("_id").agg(F.max(F.struct("_at", "body")).getField("body").alias("body")))
    return listed.join(
        docs.select("_id", F.try_parse_json("body").alias("detail")), "_id", "inner")


def crm_tax_ids(tasks: DataFrame) -> DataFrame:
    """P13 + F10: extract the tax id of each detailed task, drop empty ones."""
    keep = [F.col("seq")] if "seq" in tasks.columns else []
    return (tasks.select("_id", crm_tax_id(F.col("detail")).alias("tax_id"), *keep)
            .filter(F.col("tax_id") != ""))


def crm_rows(tax_ids: DataFrame, params: ReportParams, tax_col: str = "tax_id",
             keep_order: bool = False) -> DataFrame:
    """One 19-column report row per CRM tax id; only the tax id varies.

    ``keep_order`` adds ``_source_rank`` = 1 and ``_seq`` (task listing order).
    """
    lb = params.labels
    zero, empty = F.lit(0).cast("bigint"), F.lit("")
    null_ts = F.lit(None).cast("timestamp_ntz")
    values: dict[str, Column] = {
        "client_sub_id": zero, "plan_id": zero, "status": empty, "purchased_at": null_ts,
        "package": F.lit(lb.crm_package), "expires_at": null_ts, "cancelled_at": null_ts,
        "client_id": zero, "client_name": empty, "email": empty, "package_type": empty,
        "billing_id": empty, "tax_id": F.col(tax_col).cast("string"), "company_name": empty,
        "phone": empty, "status_chosen_month": empty, "paid_last_2_months": empty,
        "last_invoice_month": empty, "lifecycle_status": F.lit(lb.lifecycle_unspecified),
    }
    extra = []
    if keep_order:
        seq = F.col("seq") if "seq" in tax_ids.columns else F.lit(0)
        extra = [F.lit(1).alias("_source_rank"), seq.cast("bigint").alias("_seq")]
    return tax_ids.select(*[values[c].alias(c) for c in REPORT_COLUMNS], *extra)
