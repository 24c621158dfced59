"""Q1, Q2, A4, A5: data-quality checks, each one aggregation pass over all rows."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from subledger.operators.flatten import leaf_paths, path_col


def required_fields(df: DataFrame, fields: Sequence[str], source: str) -> DataFrame:
    """Q1 over every row: per required (dotted) field, how many rows lack it.

    Returns ``source, field, records, missing``. A field absent from the
    schema counts every row as missing instead of failing.
    """
    present = set()
    for path in leaf_paths(df.schema):
        for i in range(1, len(path) + 1):
            present.add(".".join(path[:i]))
    aggs = [F.count(F.lit(1)).alias("records")]
    for i, f in enumerate(fields):
        miss = (F.count_if(path_col(tuple(f.split("."))).isNull()) if f in present
                else F.count(F.lit(1)))
        aggs.append(miss.alias(f"m{i}"))
    wide = df.agg(*aggs)
    stacked = F.stack(F.lit(len(fields)), *[x for i, f in enumerate(fields)
                                            for x in (F.lit(f), F.col(f"m{i}"))])
    return wide.select(F.lit(source).alias("source"), F.col("records"),
                       stacked.alias("field", "missing")) \
        .select("source", "field", "records", "missing")


def required_keys(records: DataFrame, fields: Sequence[str], source: str,
                  doc_col: str = "doc") -> DataFrame:
    """Q1 on raw records (VARIANT): per (dotted) key, how many records lack it.

    A key present with a JSON null counts as present, as ``key in record``
    does. One aggregation pass over every record.
    """
    doc = F.col(doc_col)
    aggs = [F.count(F.lit(1)).alias("records")]
    for i, f in enumerate(fields):
        aggs.append(F.count_if(F.variant_get(doc, "$." + f, "variant").isNull()).alias(f"m{i}"))
    wide = records.agg(*aggs)
    stacked = F.stack(F.lit(len(fields)), *[x for i, f in enumerate(fields)
                                            for x in (F.lit(f), F.col(f"m{i}"))])
    return wide.select(F.lit(source).alias("source"), F.col("records"),
                       stacked.alias("field", "missing")) \
        .select("source", "field", "records", "missing")


def completeness(pages: DataFrame, records: DataFrame, source: str) -> DataFrame:
    """Q2: announced total (as given by the first answered page) vs rows received;
    significant when missing > 10 % of received."""
    announced = (pages.filter(F.col("http_status") == 200)
                 .select(F.min_by("total", "page_no")).scalar())
    received = records.agg(F.count(F.lit(1)).alias("received"))
    return received.select(
        F.lit(source).alias("source"),
        announced.alias("announced"),
        F.col("received"),
        (announced - F.col("received")).alias("missing"),
        ((announced - F.col("received")) > F.col("received") * 0.1).alias("significant"))


def duplicate_ids(records: DataFrame, id_col: str, source: str) -> DataFrame:
    """A4: rows minus distinct ids, NULL counting as one id value (as a set of ids does)."""
    c = F.col(id_col)
    return records.agg(
        F.lit(source).alias("source"),
        F.count(F.lit(1)).alias("records"),
        F.count_distinct(c).alias("distinct_ids"),
        F.count_if(c.isNull()).alias("null_ids"),
    ).withColumn("duplicates", F.col("records") - F.col("distinct_ids")
                 - F.when(F.col("null_ids") > 0, F.lit(1)).otherwise(F.lit(0)))


def stage_counts(joined: DataFrame, predicates: Sequence[Column],
                 names: Sequence[str]) -> DataFrame:
    """A5: rows after each successive filter, in one pass (no job per stage)."""
    aggs = [F.count(F.lit(1)).alias("joined")]
    acc = None
    for name, p in zip(names, predicates):
        acc = p if acc is None else acc & p
        aggs.append(F.count_if(acc).alias(name))
    return joined.agg(*aggs)


def observe_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count collected as a side metric of whatever action runs ``df`` next."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


class EmptySourceError(RuntimeError):
    """Q3: a mandatory source (plans, user subscriptions) has no rows."""


def require_non_empty(df: DataFrame, name: str) -> None:
    """Q3: abort the run when a mandatory source is empty (a LIMIT 1 probe)."""
    if df.isEmpty():
        raise EmptySourceError(f"no {name} records: the report cannot be built")


def check_gaps(gaps: DataFrame, on_gap: str = "warn") -> list:
    """Surface pages a scan dropped. ``on_gap``: 'ignore', 'warn' or 'fail'.

    ``gaps`` has one row per source (see ``sources.landing.page_gaps``), so the
    collect is bounded by the number of sources; returns all rows.
    """
    found = gaps.collect()
    rows = [r for r in found if r["dropped_pages"]]
    if rows and on_gap == "fail":
        raise RuntimeError(f"pages dropped by failed or empty pages: {rows}")
    if rows and on_gap == "warn":
        warnings.warn(f"pages dropped by failed or empty pages: {rows}", stacklevel=2)
    return found
