"""K1: overwrite a region of columns of a landed grid, keep what stands outside it.

A grid is a table with a row number and one column a cell. The report's rows
get gapless row numbers by range partitions and offsets (no single-partition
window), and one full outer join by row number puts them into the grid: cells
of other columns survive, rows above the region's first row are left alone, and
a report that became shorter clears the region's rows below it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.operators.ordinals import with_ordinals

ROW = "row_no"


def numbered(report: DataFrame, order: list[Column], first_row: int, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``report`` with ``row_no`` from ``first_row`` in ``order``; equal rows in any order of theirs."""
    salted = keep(report.withColumn("_salt", F.monotonically_increasing_id()))  # tells copies apart, also when read again
    ranked = with_ordinals(salted, [], [*order, F.col("_salt")], "_at", keep)
    return ranked.withColumn(ROW, F.col("_at") + first_row).drop("_at", "_salt")


def overwrite_region(grid: DataFrame, report: DataFrame, region: dict[str, str], order: list[Column],
                     keep: Callable[[DataFrame], DataFrame], first_row: int = 2, last_row: int | None = None) -> DataFrame:
    """The grid after the report was written into ``region`` (grid column -> report column), whose rows begin at ``first_row``.

    Rows of the region that the report does not reach are cleared, down to ``last_row`` if
    given. Cells take the grid's column types. Rows of the grid without a number stay as they
    are. Columns of the region that the grid lacks are added; a report row below the grid's end becomes a new row.
    """
    rows = numbered(report.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(region.values())], *[c.alias(f"_o{i}") for i, c in enumerate(order)]),
                    [F.col(f"_o{i}") for i in range(len(order))], first_row, keep)
    rows = rows.select(F.col(ROW).alias("_row"), *[f"_c{i}" for i in range(len(region))])
    inside = F.col(ROW) >= first_row
    if last_row is not None:
        inside &= F.col(ROW) <= last_row
    both = grid.join(rows, F.col(ROW) == F.col("_row"), "full_outer")
    kinds = {f.name: f.dataType for f in grid.schema.fields}
    cells = []
    for name in [*grid.columns, *[c for c in region if c not in grid.columns]]:
        old = F.col(f"`{name}`") if name in grid.columns else F.lit(None)
        if name == ROW:
            cells.append(F.coalesce(ROW, "_row").alias(ROW))
        elif name in region:
            new = F.col(f"_c{list(region).index(name)}")
            new = new.cast(kinds[name]) if name in kinds else new
            cells.append(F.when(F.col("_row").isNotNull(), new).when(inside, F.lit(None)).otherwise(old).alias(name))
        else:
            cells.append(old.alias(name))
    return both.select(*cells)


def write_region(grid_path: str, out_path: str, report: DataFrame, region: dict[str, str], order: list[Column],
                 keep: Callable[[DataFrame], DataFrame], first_row: int = 2, last_row: int | None = None) -> None:
    """The next version of a written grid, in a folder of its own (a failed run leaves the previous one readable)."""
    grid = report.sparkSession.read.parquet(grid_path)
    overwrite_region(grid, report, region, order, keep, first_row, last_row).write.mode("errorifexists").parquet(out_path)
