"""Gapless row numbers without a single-partition window.

Rows are sorted by range partitions; each partition counts its rows of each
group, the counts become offsets, and a row's number is its place in its
partition plus the offset. Only the counts (at most partitions + groups rows)
are ever numbered by a window, so a group of any size is spread over as many
partitions as its rows fill.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_ordinals(rows: DataFrame, group: list[str], order: list[Column], name: str, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with ``name``: 0, 1, ... within each ``group`` in ``order`` (nulls are a group like any other).

    ``order`` must tell all rows apart that differ; end it with a stable salt where
    rows may repeat, so that copies do not meet in one partition. ``keep`` makes
    the sorted rows durable (a checkpoint or a written table): the counts and the
    numbers must see the same partitions, also after an executor is lost.
    """
    keys = [F.col(g) for g in group]
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = keep(dealt.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    held = placed.groupBy(*keys, part.alias("_part")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_of"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    same = part == F.col("_of")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    numbered = placed.join(offsets, same)
    return numbered.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_place") + F.col("_offset")).alias(name))
