"""First line item, defaults, units, local dates -> the invoice fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions.dates import epoch_to_local_date
from subledger.params import Labels, ReportParams
from subledger.schemas import INVOICE_FACT_COLUMNS


def first_line_item(lines_data: Column, labels: Labels) -> tuple[Column, Column, Column]:
    """Typed path: (description, plan_active, plan_interval) of ``lines.data[0]``.

    Empty array -> all three placeholders; NULL plan -> plan placeholders.
    A typed struct cannot tell a missing key from an explicit null, so a NULL
    leaf is kept as NULL (the billing API always sends these keys).
    """
    first = F.get(lines_data, 0)
    plan = first.getField("plan")
    has_plan = first.isNotNull() & plan.isNotNull()
    desc = F.when(first.isNull(), F.lit(labels.no_description)).otherwise(first.getField("description"))
    active = F.when(has_plan, plan.getField("active").cast("string")).otherwise(F.lit(labels.no_plan_active))
    interval = F.when(has_plan, plan.getField("interval")).otherwise(F.lit(labels.no_plan_interval))
    return desc, active, interval


def _present(v: Column) -> Column:
    return v.isNotNull() & ~F.is_variant_null(v)


_ITEM = "struct<description variant, plan variant>"
_PLAN = "struct<active variant, interval variant>"


def first_line_item_variant(doc: Column, labels: Labels, lines_path: str = "$.lines"
                            ) -> tuple[Column, Column, Column]:
    """VARIANT path with exact key semantics of ``dict.get(key, default)``.

    missing key -> placeholder; explicit null -> NULL; plan missing, null or
    ``{}`` -> plan placeholders; empty ``lines.data`` -> all placeholders.
    ``doc`` holds the invoice (``lines_path='$.lines'``) or its ``lines``
    object (``'$'``). Each object is cast once to a struct of VARIANT fields:
    an absent key becomes NULL, a JSON null stays a VARIANT null.
    """
    first = F.variant_get(doc, f"{lines_path}.data[0]", "variant")
    item = F.try_variant_get(first, "$", _ITEM)
    plan = item.getField("plan")
    plan_truthy = _present(plan) & (F.schema_of_variant(plan) != F.lit("OBJECT<>"))
    plan_fields = F.try_variant_get(plan, "$", _PLAN)

    def leaf(v: Column, placeholder: str) -> Column:
        return (F.when(v.isNull(), F.lit(placeholder))
                .when(F.is_variant_null(v), F.lit(None).cast("string"))
                .otherwise(F.try_variant_get(v, "$", "string")))

    desc = F.when(first.isNull(), F.lit(labels.no_description)) \
        .otherwise(leaf(item.getField("description"), labels.no_description))
    active = F.when(plan_truthy, leaf(plan_fields.getField("active"), labels.no_plan_active)) \
        .otherwise(F.lit(labels.no_plan_active))
    interval = F.when(plan_truthy, leaf(plan_fields.getField("interval"), labels.no_plan_interval)) \
        .otherwise(F.lit(labels.no_plan_interval))
    return desc, active, interval


def invoices_since(raw: DataFrame, params: ReportParams) -> DataFrame:
    """``created >= since`` on the bare epoch column, so Parquet gets it as a pushed filter."""
    return raw.filter(F.col("created") >= F.lit(params.invoice_since_epoch()))


def invoice_fact(raw: DataFrame, params: ReportParams, keep_helpers: bool = False,
                 arrival_order: Column | None = None) -> DataFrame:
    """The 14-column invoice table (plus ``created_epoch``/``seq`` when ``keep_helpers``).

    ``arrival_order``: the billing source's listing order, earlier first.
    Default: a landed ``seq`` column if present, else newest first (the
    billing API lists invoices by creation time, newest first).
    """
    lb = params.labels
    inv = invoices_since(raw, params)
    if arrival_order is None:
        arrival_order = F.col("seq") if "seq" in raw.columns else -F.col("created")
    desc, active, interval = first_line_item(F.col("lines.data"), lb)
    cols = [
        F.col("id"),
        (F.col("amount_due") / 100).alias("amount_due"),
        (F.col("amount_paid") / 100).alias("amount_paid"),
        (F.col("amount_remaining") / 100).alias("amount_remaining"),
        epoch_to_local_date(F.col("created"), params.local_timezone).alias("created"),
        F.col("customer"),
        desc.alias("lines_data_description"),
        active.alias("plan_active"),
        interval.alias("plan_interval"),
        F.col("subscription"),
        F.col("attempt_count"),
        F.col("payment_intent"),
        F.col("status"),
        F.col("paid"),
    ]
    if keep_helpers:
        cols += [F.col("created").alias("created_epoch"), arrival_order.alias("seq")]
    out = inv.select(*cols)
    assert tuple(out.columns[:14]) == INVOICE_FACT_COLUMNS
    return out


def _with_default(v: Column, default: Column, typ: str) -> Column:
    """``dict.get(key, default)``: missing key -> default, explicit null -> NULL."""
    return (F.when(v.isNull(), default)
            .when(F.is_variant_null(v), F.lit(None).cast(typ))
            .otherwise(F.try_variant_get(v, "$", typ)))


_INVOICE_TOP = ("struct<id string, amount_due bigint, amount_paid bigint, amount_remaining bigint, "
                "created bigint, customer string, subscription string, attempt_count variant, "
                "payment_intent variant, status string, paid variant, lines variant>")


def invoice_fact_variant(docs: DataFrame, params: ReportParams, json_col: str = "json",
                         keep_helpers: bool = False) -> DataFrame:
    """R5 over raw invoices: the 14-column invoice table with exact key semantics.

    ``docs`` holds each invoice as VARIANT (``doc``) or as JSON text
    (``json_col``). Top-level defaults (``attempt_count`` -> 0,
    ``payment_intent`` -> placeholder, ``paid`` -> false) apply to missing keys
    only; an explicit null stays NULL. Text is parsed once per row and the
    object read in one traversal (a cast to a struct with VARIANT fields for the
    keys whose absence matters). ``keep_helpers`` adds ``created_epoch`` and
    ``seq`` (landed, else newest first).
    """
    lb = params.labels
    seq = [F.col("seq")] if "seq" in docs.columns else []
    if "doc" in docs.columns:
        doc, since = F.col("doc"), F.try_variant_get("doc", "$.created", "bigint")
    else:
        # The lower bound reads one path of the raw text (a streaming scan, no
        # full parse); the full parse then runs once per kept row.
        doc, since = F.parse_json(F.col(json_col)), F.get_json_object(F.col(json_col), "$.created").try_cast("bigint")
    inv = docs.filter(since >= F.lit(params.invoice_since_epoch())).select(F.try_variant_get(doc, "$", _INVOICE_TOP).alias("_inv"), *seq)
    f = lambda name: F.col("_inv").getField(name)
    desc, active, interval = first_line_item_variant(f("lines"), lb, lines_path="$")
    helpers = [f("created").alias("created_epoch"), *(seq or [(-f("created")).alias("seq")])] if keep_helpers else []
    return inv.select(
        f("id").alias("id"),
        (f("amount_due") / 100).alias("amount_due"),
        (f("amount_paid") / 100).alias("amount_paid"),
        (f("amount_remaining") / 100).alias("amount_remaining"),
        epoch_to_local_date(f("created"), params.local_timezone).alias("created"),
        f("customer").alias("customer"),
        desc.alias("lines_data_description"),
        active.alias("plan_active"),
        interval.alias("plan_interval"),
        f("subscription").alias("subscription"),
        _with_default(f("attempt_count"), F.lit(0), "int").alias("attempt_count"),
        _with_default(f("payment_intent"), F.lit(lb.no_payment_intent), "string").alias("payment_intent"),
        f("status").alias("status"),
        _with_default(f("paid"), F.lit(False), "boolean").alias("paid"), *helpers)


def invoice_table(invoices: DataFrame, params: ReportParams, keep_helpers: bool = False) -> DataFrame:
    """The invoice table of landed invoices (VARIANT ``doc`` or JSON text ``json``: exact key
    semantics) or of typed ones (where a NULL stands for an explicit null)."""
    if {"doc", "json"} & set(invoices.columns):
        return invoice_fact_variant(invoices, params, keep_helpers=keep_helpers)
    return invoice_fact(invoices, params, keep_helpers=keep_helpers)
