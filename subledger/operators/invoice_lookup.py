"""The three invoice-derived report columns.

The reference evaluates three correlated lookups per subscription row (a scan
of all invoices each). Because every date bound is a constant, they collapse
into ONE conditional aggregation per billing id, partially aggregated before
the shuffle, and one left join:

    invoices --filter--> partial agg --shuffle--> final agg --shuffle--+
    report  --(key: billing id, or the row's own id if blank)--shuffle-+--> left join

Cost is O(subscriptions + invoices) instead of O(subscriptions x invoices).
A hot subscription collapses to one row per map task in the partial
aggregation. For a hot billing id on the report side, the join also compares
a hash of the key, which neither side is partitioned by yet: both inputs are
then plain shuffles, and AQE's skew join splits the report rows of the hot key
over as many tasks as their measured bytes ask for. Building the plan starts
no job and needs no list of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions.blank import is_blank
from subledger.functions.dates import date_literal, month_name
from subledger.params import INVOICE_PAID, ReportParams

# Prefix of the join key given to blank billing ids: no invoice key can equal
# it, and the record id spreads those rows over all partitions instead of the
# single partition a NULL join key would land in.
_BLANK_KEY_PREFIX = "\u0000blank:"


def invoice_join_key(billing_col: str = "billing_id", id_col: str = "client_sub_id") -> Column:
    """Join key of a report row: its billing id, or for a blank billing id a
    key no invoice can carry, made from the row's own id (deterministic, so a
    recomputed task after an executor loss routes the row the same way)."""
    salted = F.concat(F.lit(_BLANK_KEY_PREFIX),
                      F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.when(is_blank(billing_col), salted).otherwise(F.col(billing_col))


def _first_where(cond: Column, invoice_id: Column) -> Column:
    """Status of the first invoice meeting ``cond`` in the total arrival order
    (lowest ``seq``, then highest id); a struct, so a NULL status differs from no invoice."""
    return F.max(F.when(cond, F.struct((-F.col("seq")).alias("o"), invoice_id.alias("id"), F.col("status"))))


def invoice_aggregates(invoices: DataFrame, params: ReportParams) -> DataFrame:
    """One row per billing subscription id with every lookup the report needs.

    ``invoices`` needs ``subscription STRING, created DATE, status STRING, seq``
    (``seq`` = arrival order of the billing source, lower first) and, unless
    ``seq`` is unique, ``id``.
    """
    d = F.col("created")
    paid = F.col("status") == F.lit(INVOICE_PAID)
    cm0, cm1 = params.chosen_monthly_range()
    cy0, cy1 = params.chosen_yearly_range()
    wm0, wm1 = params.window_monthly_range()
    wy0, wy1 = params.window_yearly_range()
    lm0, lm1 = params.last_monthly_range()
    ly0 = params.last_yearly_start()
    L = date_literal
    key = F.col("subscription")
    own_id = F.col("id") if "id" in invoices.columns else F.lit("")
    return (invoices
            .filter(key.isNotNull() & (key != "") & ~key.startswith(_BLANK_KEY_PREFIX))
            .groupBy("subscription")
            .agg(_first_where((d >= L(cm0)) & (d < L(cm1)), own_id).alias("first_m"),
                 _first_where(d.between(L(cy0), L(cy1)), own_id).alias("first_y"),
                 F.max(F.when(paid & d.between(L(wm0), L(wm1)), F.lit(True))).alias("paid2_m"),
                 F.max(F.when(paid & d.between(L(wy0), L(wy1)), F.lit(True))).alias("paid2_y"),
                 F.max(F.when(paid & d.between(L(lm0), L(lm1)), d)).alias("last_m"),
                 F.max(F.when(paid & (d >= L(ly0)), d)).alias("last_y"),
                 F.max(F.when(paid, d)).alias("last_any")))


def with_invoice_columns(report: DataFrame, invoices: DataFrame, params: ReportParams,
                         billing_col: str = "billing_id", type_col: str = "package_type",
                         id_col: str = "client_sub_id") -> DataFrame:
    """Add ``status_chosen_month``, ``paid_last_2_months``, ``last_invoice_month``.

    Blank billing id -> "cannot determine" / "cannot determine" / ''.
    Package type other than monthly/yearly -> '' / '' / month of any paid invoice.
    No invoices at all -> '' in all three columns for every row (an EXISTS
    subquery, so the plan stays lazy).
    """
    return with_lookup_state(report, invoice_aggregates(invoices, params), invoices.exists(), params, billing_col, type_col, id_col)


def with_lookup_state(report: DataFrame, state: DataFrame, has_invoices: Column, params: ReportParams, billing_col: str = "billing_id",
                      type_col: str = "package_type", id_col: str = "client_sub_id") -> DataFrame:
    """The three columns from a state of the lookups (``invoice_aggregates``, or a kept one) instead of the invoices."""
    keyed = report.withColumn("_inv_key", invoice_join_key(billing_col, id_col))
    keyed = keyed.withColumn("_inv_hash", F.xxhash64("_inv_key"))
    agg = state.withColumn("_sub_hash", F.xxhash64("subscription"))
    j = keyed.join(agg, (keyed["_inv_key"] == agg["subscription"]) & (keyed["_inv_hash"] == agg["_sub_hash"]), "left")
    return lookup_columns(j, report.columns, has_invoices, params, billing_col, type_col)


def lookup_columns(joined: DataFrame, columns: list[str], has_invoices: Column, params: ReportParams, billing_col: str = "billing_id",
                   type_col: str = "package_type", prefix: str = "") -> DataFrame:
    """The report's ``columns`` and the three derived ones, of report rows joined to their lookup state (its columns named with ``prefix``)."""
    lb = params.labels
    blank = is_blank(billing_col)
    S = lambda name: F.col(prefix + name)
    typ = F.col(type_col)
    monthly, yearly = typ == F.lit(lb.interval_month), typ == F.lit(lb.interval_year)
    cannot, empty = F.lit(lb.cannot_determine), F.lit("")
    chosen = (F.when(blank, cannot)
              .when(monthly & S("first_m").isNotNull(), S("first_m.status"))
              .when(yearly & S("first_y").isNotNull(), S("first_y.status"))
              .otherwise(empty))
    paid2 = (F.when(blank, cannot)
             .when(monthly & F.coalesce(S("paid2_m"), F.lit(False)), F.lit(lb.paid_flag))
             .when(yearly & F.coalesce(S("paid2_y"), F.lit(False)), F.lit(lb.paid_flag))
             .otherwise(empty))
    last_date = (F.when(monthly, S("last_m")).when(yearly, S("last_y"))
                 .otherwise(S("last_any")))
    last = F.when(blank, empty).otherwise(month_name(last_date, lb.month_names))

    guard = lambda c: F.when(has_invoices, c).otherwise(empty)
    return joined.select(*[F.col(f"`{c}`") for c in columns],
                    guard(chosen).alias("status_chosen_month"),
                    guard(paid2).alias("paid_last_2_months"),
                    guard(last).alias("last_invoice_month"))
