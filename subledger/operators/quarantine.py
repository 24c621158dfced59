"""A strict parse that sets failing rows apart instead of failing the job.

``screened`` adds to each row the values that could not be parsed, with their
columns; good rows, failing ones and their counts all come from that one
projection. ``write_screened`` writes both kinds in one pass, counted while they
are written, and gives the run up if more failed than the threshold allows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from subledger.functions.blank import is_blank
from subledger.functions.dates import parse_ts_lenient

ERRORS = "_errors"


class QuarantineError(RuntimeError):
    """More rows failed to parse than the run allows."""


def timestamp(shift: int = 0) -> Callable[[Column], Column]:
    return lambda c: parse_ts_lenient(F.when(~is_blank(F.trim(c)), c), shift)


def screened(rows: DataFrame, parsers: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``rows`` with each column of ``parsers`` parsed, and ``_errors``: (column, raw) of the values that
    are neither blank nor parseable. A parser gives NULL for what it cannot read."""
    errors, parsed = [], []
    for name in rows.columns:
        c = F.col(f"`{name}`")
        if name not in parsers:
            parsed.append(c)
            continue
        value = parsers[name](c)
        parsed.append(value.alias(name))
        errors.append(F.when(~is_blank(F.trim(c)) & value.isNull(), F.struct(F.lit(name).alias("column"), c.cast("string").alias("raw"))))
    found = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<struct<column:string,raw:string>>")
    return rows.select(*parsed, found.alias(ERRORS))


def accepted(rows: DataFrame) -> DataFrame:
    """The screened rows without a failed value."""
    return rows.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejected(rows: DataFrame, place: list[str]) -> DataFrame:
    """A row for each failed value: the record's place, ``column`` and ``raw``."""
    return rows.select(*place, F.explode(ERRORS).alias("_e")).select(*place, "_e.column", "_e.raw")


def write_screened(rows: DataFrame, path: str, most: int | float | None = 0) -> dict[str, int]:
    """Write good and failing rows (``quarantined=0`` and ``1``) in one pass over ``rows``; returns the counts.

    ``most``: failing rows allowed (a float below 1: their share of all rows; None: any
    number). Above it ``QuarantineError`` is raised; the files stay for inspection
    without a ``_DONE`` marker, which ``read_accepted`` asks for.
    """
    marked = rows.withColumn("quarantined", (F.size(ERRORS) > 0).cast("int"))
    seen = Observation("screened")
    counted = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum("quarantined").alias("bad"))
    counted.write.mode("errorifexists").partitionBy("quarantined").parquet(path)
    got = {"rows": int(seen.get["rows"]), "bad": int(seen.get["bad"] or 0)}
    allowed = float("inf") if most is None else most * got["rows"] if isinstance(most, float) else most
    if got["bad"] > allowed:
        raise QuarantineError(f"{got['bad']} of {got['rows']} rows could not be parsed, {most} allowed: see {path}/quarantined=1")
    rows.sparkSession.createDataFrame([(got["rows"], got["bad"])], "rows long, bad long").coalesce(1).write.parquet(f"{path}/_DONE")
    return got


def read_accepted(spark, path: str) -> DataFrame:
    """The good rows of a screened write that was within its threshold."""
    spark.read.parquet(f"{path}/_DONE").first()
    return spark.read.parquet(path).filter("quarantined = 0").drop("quarantined", ERRORS)
