"""K1: a region of a sheet is overwritten, the rest of it stays; gapless numbers without one task."""

import re

import pytest
from pyspark.sql import functions as F

from subledger.operators.ordinals import with_ordinals
from subledger.session import keep_small
from subledger.sinks.region import overwrite_region, write_region

GRID = "row_no long, A string, C string, D string"


def written(spark, grid, report, **kw):
    df = overwrite_region(spark.createDataFrame(grid, GRID), spark.createDataFrame(report, "k long, v string"), {"C": "k", "D": "v"}, [F.col("k"), F.col("v")], keep_small, **kw)
    return sorted((tuple(r) for r in df.select("row_no", "A", "C", "D").collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_cells_outside_survive_and_a_shorter_report_clears_the_rest(spark):
    grid = [(1, "note", "head", "head"), (2, "a2", "old", "old"), (4, "a4", "old", "old"), (9, None, "old", "old"), (20, "a20", "old", "kept")]
    assert written(spark, grid, [(7, "x"), (5, "y"), (6, None)], last_row=15) == [
        (1, "note", "head", "head"), (2, "a2", "5", "y"), (3, None, "6", None), (4, "a4", "7", "x"), (9, None, None, None), (20, "a20", "old", "kept")]
    assert written(spark, grid, [])[1:] == [(2, "a2", None, None), (4, "a4", None, None), (9, None, None, None), (20, "a20", None, None)]
    assert written(spark, [], [(1, "x")]) == [(2, None, "1", "x")]


def test_rows_without_a_number_and_repeated_rows(spark):
    got = written(spark, [(None, "loose", "c", "d"), (2, "a", "c", "d")], [(1, "x")] * 3 + [(None, "n")])
    assert got == [(2, "a", None, "n"), (3, None, "1", "x"), (4, None, "1", "x"), (5, None, "1", "x"), (None, "loose", "c", "d")]


def test_versions_are_folders_of_their_own(spark, tmp_path):
    spark.createDataFrame([(2, "a", "old", "old")], GRID).write.parquet(str(tmp_path / "v1"))
    report = spark.createDataFrame([(1, "x")], "k long, v string")
    write_region(str(tmp_path / "v1"), str(tmp_path / "v2"), report, {"C": "k", "D": "v"}, [F.col("k")], keep_small)
    assert spark.read.parquet(str(tmp_path / "v2")).collect()[0].asDict() == {"row_no": 2, "A": "a", "C": "1", "D": "x"}
    assert spark.read.parquet(str(tmp_path / "v1")).first()["C"] == "old"


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_ordinals_are_gapless_in_order(spark, parts):
    rows = [(g, v) for g in ("a", "b", None) for v in range(500 if g == "a" else 7)] + [("hot", 1)] * 300
    df = keep_small(spark.createDataFrame(rows, "g string, v long").repartition(parts).withColumn("_salt", F.monotonically_increasing_id()))
    got = with_ordinals(df, ["g"], [F.col("v"), F.col("_salt")], "at", keep_small).collect()
    for g in ("a", "b", None, "hot"):
        mine = sorted((r["at"], r["v"]) for r in got if r["g"] == g)
        assert [a for a, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)


def test_hot_group_fills_many_partitions_and_no_window_sees_rows(spark):
    seen = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = keep_small(spark.range(4000).select(F.lit("hot").alias("g"), F.lit(1).alias("v"), F.monotonically_increasing_id().alias("_salt")))
        out = with_ordinals(df, ["g"], [F.col("v"), F.col("_salt")], "at", lambda x: seen.append(keep_small(x)) or seen[-1])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 2000
    assert "SinglePartition" not in plan
    window = plan[plan.index("Window"):]
    assert "HashAggregate" in window[:window.index("Scan")]  # numbered after the counts, not over the rows
    assert not re.search("CartesianProduct|NestedLoop", plan)
