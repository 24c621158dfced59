"""J2-J4 kept up to date: the invoice lookups of every billing id as a state that merges.

All lookups are maxima (of dates, of flags, of structs in arrival order), so the
state of old and newly landed invoices together is the maximum of both states,
column by column. Invoices that were corrected or withdrawn cannot be taken out
of a maximum: the ids they name, before and after, are recomputed from the
invoices that count now, and only those. A state is published by run and read
through its marker, so a failed update leaves the last one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators.invoice_lookup import invoice_aggregates
from subledger.params import ReportParams

KEY = "subscription"


def merged(*states: DataFrame) -> DataFrame:
    """The state of all invoices of these states; an invoice in several of them counts once."""
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    return every.groupBy(KEY).agg(*[F.max(c).alias(c) for c in every.columns if c != KEY])


def updated(state: DataFrame, landed: DataFrame, params: ReportParams) -> DataFrame:
    """``state`` with newly landed invoices (id, subscription, created, status, seq)."""
    return merged(state, invoice_aggregates(landed, params))


def retracted(state: DataFrame, corrected: DataFrame, current: DataFrame, params: ReportParams) -> DataFrame:
    """``state`` after corrections: ``corrected`` has the invoices as they were and as they are now (their
    subscriptions alone are read), ``current`` all invoices that count. Other ids keep their rows."""
    keys = corrected.select(KEY).filter(F.col(KEY).isNotNull()).distinct()
    again = invoice_aggregates(current.join(keys, KEY, "left_semi"), params)
    return state.join(keys, KEY, "left_anti").unionByName(again)


def publish(state: DataFrame, path: str, run: str | None = None) -> str:
    """Write a state under a run's name, then its marker; returns the run."""
    run = run or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    state.write.mode("errorifexists").parquet(f"{path}/state/run={run}")
    marker = state.sparkSession.createDataFrame([(run,)], "name string").coalesce(1)
    marker.write.mode("errorifexists").parquet(f"{path}/done/run={run}")
    return run


def current(spark: SparkSession, path: str) -> DataFrame:
    """The state of the latest published run."""
    run = spark.read.schema("name string").parquet(f"{path}/done").agg(F.max("name")).first()[0]
    return spark.read.parquet(f"{path}/state/run={run}")
