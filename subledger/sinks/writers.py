"""K1-K5: overwrite sinks.

The spreadsheet of the reference becomes a table. A run writes its report to a
folder of its own (an empty report writes an empty table) and then, last, a
one-row ``report_meta`` of the same run as the commit marker. Readers follow
the latest marker, so a run that fails half way leaves the previous complete
report in place, and a rerun after an executor or driver loss is a new run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.operators.quality import observe_count

# Sheet headings of the report columns, in column order.
REPORT_HEADINGS = {
    "client_sub_id": "ID Subskrypcji Klienta",
    "plan_id": "ID Subskrypcji",
    "status": "Status",
    "purchased_at": "Data zakupu",
    "package": "Pakiet",
    "expires_at": "Data wygaśnięcia",
    "cancelled_at": "Data anulowania",
    "client_id": "ID Klienta",
    "client_name": "Imię i Nazwisko Klienta",
    "email": "Email",
    "package_type": "Typ pakietu",
    "billing_id": "ID Suba STRIPE",
    "tax_id": "NIP",
    "company_name": "Nazwa Firmy",
    "phone": "Telefon",
    "status_chosen_month": "Invoice status in chosen month",
    "paid_last_2_months": "Invoice status in last 2 months",
    "last_invoice_month": "Last invoice month",
    "lifecycle_status": "Status3",
}

# Headings of the invoice table, in column order.
INVOICE_HEADINGS = {
    "id": "ID_Faktury",
    "amount_due": "Kwota Do Zapłaty",
    "amount_paid": "Kwota Zapłacona",
    "amount_remaining": "Pozostało Do Zapłaty",
    "created": "Data Utworzenia",
    "customer": "ID_Klienta",
    "lines_data_description": "Pakiet",
    "plan_active": "Sub Aktywny",
    "plan_interval": "Okres Odnowienia",
    "subscription": "ID_Subskrypcji",
    "attempt_count": "Liczba Pobrań Kwoty Do Zapłaty",
    "payment_intent": "ID_Payment_Intent",
    "status": "Status Faktury",
    "paid": "Faktura Opłacona",
}

CELL_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def format_for_export(df: DataFrame, headings: dict[str, str] | None = None) -> DataFrame:
    """K4: date-times and dates -> 'yyyy-MM-dd HH:mm:ss' text; NaN -> NULL; optional headings."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, CELL_TS_FORMAT)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        name = headings.get(f.name, f.name) if headings else f.name
        cols.append(c.alias(name))
    return df.select(*cols)


def with_headings(df: DataFrame, headings: dict[str, str]) -> DataFrame:
    """Columns under their sheet headings."""
    return df.select(*[F.col(f"`{c}`").alias(headings.get(c, c)) for c in df.columns])


def report_meta(spark: SparkSession, as_of: dt.date, row_count: int | DataFrame) -> DataFrame:
    """K2: one row ``(as_of_date DATE, row_count BIGINT)``."""
    if isinstance(row_count, DataFrame):
        return row_count.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(as_of.isoformat()).cast("date").alias("as_of_date"), F.col("row_count"))
    return spark.createDataFrame([(as_of, int(row_count))], "as_of_date date, row_count bigint")


def new_run() -> str:
    """A run's name; later runs sort later."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def write_report(report: DataFrame, path: str, meta_path: str, as_of: dt.date,
                 fmt: str = "parquet", headings: dict[str, str] | None = None,
                 order_by: list[str] | None = None, run: str | None = None) -> int:
    """K1 + K2 + K5: write the run's report, then its meta row (success marker).

    The row count is observed during the write itself (no second job).
    ``order_by`` gives a global order for ordered exports (a range shuffle).
    """
    run = run or new_run()
    out = report
    if order_by:
        # range-partitioned global sort; helper columns are dropped after it
        helpers = [c for c in order_by if c.startswith("_")]
        out = out.orderBy(*order_by).drop(*helpers)
    if fmt == "csv":
        out = format_for_export(out, headings)
    elif headings:
        out = with_headings(out, headings)
    out, obs = observe_count(out, "report_rows")
    writer = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(f"{path}/run={run}")
    rows = int(obs.get["rows"])
    report_meta(report.sparkSession, as_of, rows).coalesce(1).write.mode("overwrite").parquet(f"{meta_path}/run={run}")
    return rows


def current_run(spark: SparkSession, meta_path: str) -> str | None:
    """The latest run that has its success marker."""
    return spark.read.schema("as_of_date date, row_count bigint, run string").parquet(meta_path).agg(F.max("run")).first()[0]


def read_report(spark: SparkSession, path: str, meta_path: str, fmt: str = "parquet") -> DataFrame:
    """The report of the latest complete run."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(f"{path}/run={current_run(spark, meta_path)}")


def write_invoice_fact(fact: DataFrame, path: str, fmt: str = "parquet", headings: dict[str, str] | None = None) -> bool:
    """K3: overwrite the invoice table; skipped when there are no invoices."""
    if fact.isEmpty():
        return False
    fact = with_headings(fact, headings) if headings else fact
    fact.write.mode("overwrite").format(fmt).save(path)
    return True
