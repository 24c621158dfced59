"""J2-J4 without a shuffle at the join: report rows and lookup state in tables bucketed alike, written once a run.

Both tables are bucketed and sorted by (key, part), in as many buckets, so that
any number of reads joins bucket beside bucket. A hot billing id would fill one
bucket: ids with more than ``rows`` report rows are counted first, their report
rows are dealt over parts by a hash of the whole row, and the state's row of
such an id is repeated, once a part. There are at most as many such ids as the
report has rows, divided by ``rows``, and they stay a table.

A run's tables lie in its own folders and count once its marker is written. The
session's catalogue only points to them; another session registers them again
when it reads them.

Defined results: blank ids have keys of their own, as in the plain lookup; an
empty report or state is an empty table; report rows that are equal in every
column share a part; extra columns are kept, whatever their names, but for
``RESERVED`` ones and names that begin with ``_state_``, which are refused.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators.invoice_lookup import invoice_aggregates, invoice_join_key, lookup_columns
from subledger.params import ReportParams

KEY, PART = "_key", "_part"
RESERVED = {KEY, PART, "_hot", "_parts"}
_MARKER = "name string, buckets int, has_invoices boolean, report string, state string"
#: Report rows of one billing id that share a part.
ROWS = 1_000_000


def hot_keys(keyed: DataFrame, rows: int = ROWS) -> DataFrame:
    """The keys with more than ``rows`` rows, and the parts each is dealt over."""
    parts = F.ceil(F.col("n") / F.lit(rows)).cast("int")
    return keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows).select(F.col(KEY).alias("_hot"), parts.alias("_parts"))


def _with_parts(df: DataFrame, hot: DataFrame) -> DataFrame:
    """``df`` with ``_parts``. The hash beside the key makes both inputs plain shuffles, so that AQE can split the hot keys' rows."""
    return df.join(hot, (df[KEY] == hot["_hot"]) & (F.xxhash64(df[KEY]) == F.xxhash64(hot["_hot"])), "left").drop("_hot")


def _table_name(path: str) -> str:
    return "colocated_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _write(df: DataFrame, path: str, buckets: int) -> str:
    """Write a bucketed table; its columns as DDL."""
    (df.repartition(buckets, KEY, PART).write.mode("errorifexists").format("parquet").option("path", path)
     .bucketBy(buckets, KEY, PART).sortBy(KEY, PART).saveAsTable(_table_name(path)))
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _registered(spark: SparkSession, path: str, buckets: int, columns: str) -> DataFrame:
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}, {PART}) SORTED BY ({KEY}, {PART}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def publish(report: DataFrame, invoices: DataFrame, params: ReportParams, path: str, run: str | None = None, buckets: int | None = None,
            rows: int = ROWS, billing_col: str = "billing_id", id_col: str = "client_sub_id") -> str:
    """Write a run's two tables, then its marker; returns the run. ``buckets``: as many as shuffle partitions, if not given.

    The report is evaluated twice: its keys are counted, then its rows are written.
    """
    if clash := [c for c in report.columns if c in RESERVED or c.startswith("_state_")]:
        raise ValueError(f"columns of these names are not allowed: {clash}")
    spark = report.sparkSession
    run = run or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = report.withColumn(KEY, invoice_join_key(billing_col, id_col))
    hot_keys(keyed, rows).write.mode("errorifexists").parquet(f"{path}/hot/run={run}")
    hot = spark.read.schema("_hot string, _parts int").parquet(f"{path}/hot/run={run}")
    part = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in report.columns]), F.col("_parts")).cast("int"))
    report_columns = _write(_with_parts(keyed, hot).withColumn(PART, part).drop("_parts"), f"{path}/report/run={run}", buckets)
    state = invoice_aggregates(invoices, params).withColumnRenamed("subscription", KEY)
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    state_columns = _write(_with_parts(state, hot).withColumn(PART, repeated).drop("_parts"), f"{path}/state/run={run}", buckets)
    marker = spark.createDataFrame([(run, buckets, not invoices.isEmpty(), report_columns, state_columns)], _MARKER)
    marker.coalesce(1).write.mode("errorifexists").parquet(f"{path}/done/run={run}")
    return run


def read(spark: SparkSession, path: str, run: str | None = None) -> tuple[DataFrame, DataFrame, bool]:
    """Report rows, lookup state and whether there were invoices at all, of a run or the latest published one."""
    done = spark.read.schema(_MARKER).parquet(f"{path}/done")
    done = done.filter(F.col("name") == run) if run else done
    last = done.orderBy(F.desc("name")).first()
    if last is None:
        raise ValueError(f"no published run {run or ''} in {path}")
    report, state = (_registered(spark, f"{path}/{side}/run={last['name']}", last["buckets"], last[side]) for side in ("report", "state"))
    return report, state, last["has_invoices"]


def lookups(report: DataFrame, state: DataFrame, has_invoices: bool, params: ReportParams, billing_col: str = "billing_id",
            type_col: str = "package_type") -> DataFrame:
    """The report's columns and the three invoice columns, from tables as ``read`` returns them."""
    columns = [c for c in report.columns if c not in (KEY, PART)]
    right = state.select(F.col(KEY).alias("_state_key"), F.col(PART).alias("_state_part"),
                         *[F.col(c).alias(f"_state_{c}") for c in state.columns if c not in (KEY, PART)])
    joined = report.join(right, (report[KEY] == right["_state_key"]) & (report[PART] == right["_state_part"]), "left")
    return lookup_columns(joined, columns, F.lit(has_invoices), params, billing_col, type_col, prefix="_state_")
