"""The record table: every landed body parsed once.

One pass over the landing table writes the parsed pages as Parquet, partitioned
by source: page columns, position, and the record as VARIANT, so absent keys and
explicit nulls stay apart. The paging rules, the page index and every record
scan read this table (only the columns they need); the written table also cuts
the lineage back to the page bodies. ``created`` repeats the records' epoch
second as a plain column, so the invoices' lower bound reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.params import ReportParams
from subledger.sources.landing import page_index, parse_pages, scan_records


def land_records(landing: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Overwrite ``path`` with all sources' parsed pages (one pass over the bodies) and then
    their page index (one pass over the page columns); returns both as read back."""
    spark = landing.sparkSession
    rows = parse_pages(landing).withColumn("created", F.try_variant_get("doc", "$.created", "bigint"))
    rows.write.mode("overwrite").partitionBy("source").parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")
    page_index(records).write.mode("overwrite").parquet(f"{path}/pages")
    return records, spark.read.parquet(f"{path}/pages")


def read_invoices(records: DataFrame, params: ReportParams, **rules) -> DataFrame:
    """Invoice records (``doc``, ``seq``) at or after the lower bound; the bound is a pushed Parquet filter."""
    scanned = scan_records(records, "invoices", **rules)
    return scanned.filter(F.col("created") >= F.lit(params.invoice_since_epoch())).select("seq", "doc")
