"""Q2, A4: what changed between two runs of a source.

Rows fall into ``LEAVES`` ranges of their key's hash. A range's digest (rows,
and two sums of 64-bit row hashes, exact) does not depend on the order of its
rows and adds up: the digests of ranges are those of the tree's nodes above
them. Only ranges whose digests differ are compared row by row; a run written by
``write_run`` is partitioned by range, with its digests beside it, so that equal
ranges are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF_BITS, NODE_BITS = 8, 4
LEAVES = 1 << LEAF_BITS


def leaf_of(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(LEAVES)).cast("int")


def _row(columns: list[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in sorted(columns)])


def digests(run: DataFrame, key: list[str]) -> DataFrame:
    """leaf, node (the range of ranges above it), rows, one and two (sums of row hashes) of each range that has rows."""
    columns = [c for c in run.columns if c != "leaf"]
    leaf = F.col("leaf").cast("int") if "leaf" in run.columns else leaf_of(key)
    one, two = F.xxhash64(_row(columns)), F.xxhash64(F.lit("second"), _row(columns))
    rows = run.select(leaf.alias("leaf"), one.cast("decimal(20,0)").alias("_1"), two.cast("decimal(20,0)").alias("_2"))
    return rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.sum("_1").alias("one"), F.sum("_2").alias("two")) \
        .select("leaf", F.shiftright("leaf", NODE_BITS).alias("node"), "rows", "one", "two")


def rolled_up(leaves: DataFrame) -> DataFrame:
    """The digests of the tree's nodes (leaf NULL) and of its root (node NULL too), from those of the leaves."""
    sums = [F.sum(c).alias(c) for c in ("rows", "one", "two")]
    return leaves.rollup("node", "leaf").agg(*sums)


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """leaf: the ranges whose digests differ (at most ``LEAVES`` rows)."""
    a, b = (d.select(F.col("leaf").alias(f"leaf_{s}"), F.struct("rows", "one", "two").alias(f"digest_{s}")) for d, s in ((old, "a"), (new, "b")))
    both = a.join(b, F.col("leaf_a") == F.col("leaf_b"), "full_outer").filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
    return both.select(F.coalesce("leaf_a", "leaf_b").alias("leaf"))


def differences(old: DataFrame, new: DataFrame, key: list[str], leaves: DataFrame | None = None) -> DataFrame:
    """key, state, old_rows and new_rows of every key whose rows differ between the runs.

    ``inserted``, ``deleted``; ``repeated``: the same rows, other numbers of them;
    ``changed``: any other difference. Rows are compared whole, by a 256-bit hash.
    ``leaves``: the differing ranges, if known from written digests.
    """
    if leaves is None:
        leaves = differing(digests(old, key), digests(new, key))
    columns = sorted(c for c in new.columns if c != "leaf")
    sides = []
    for run, sign in ((old, -1), (new, 1)):
        leaf = F.col("leaf").cast("int") if "leaf" in run.columns else leaf_of(key)
        part = run.withColumn("leaf", leaf).join(F.broadcast(leaves), "leaf", "left_semi")  # at most LEAVES numbers
        sides.append(part.select(*key, F.sha2(F.to_json(_row(columns), {"ignoreNullFields": "false"}), 256).alias("_h"), F.lit(sign).alias("_s")))
    by_row = sides[0].unionByName(sides[1]).groupBy(*key, "_h").agg(
        F.count_if(F.col("_s") < 0).alias("_old"), F.count_if(F.col("_s") > 0).alias("_new"))
    by_key = by_row.groupBy(*key).agg(
        F.sum("_old").alias("old_rows"), F.sum("_new").alias("new_rows"), F.count_if((F.col("_old") == 0) | (F.col("_new") == 0)).alias("_unlike"),
        F.count_if(F.col("_old") != F.col("_new")).alias("_other"))
    state = (F.when(F.col("old_rows") == 0, "inserted").when(F.col("new_rows") == 0, "deleted")
             .when(F.col("_unlike") == 0, "repeated").otherwise("changed"))
    return by_key.filter(F.col("_other") > 0).select(*key, state.alias("state"), "old_rows", "new_rows")


def write_run(run: DataFrame, key: list[str], path: str) -> None:
    """A run partitioned by range, then its digests (read back from the written files' own columns)."""
    run.withColumn("leaf", leaf_of(key)).repartition("leaf", F.pmod(F.xxhash64(_row(run.columns)), F.lit(8))).write.mode("errorifexists").partitionBy("leaf").parquet(f"{path}/rows")
    digests(run.sparkSession.read.parquet(f"{path}/rows"), key).coalesce(1).write.mode("errorifexists").parquet(f"{path}/digests")


def reconcile(spark: SparkSession, old_path: str, new_path: str, key: list[str]) -> DataFrame:
    """``differences`` of two written runs; the partitions of equal ranges are pruned."""
    read = lambda path, what: spark.read.parquet(f"{path}/{what}")
    leaves = [r["leaf"] for r in differing(read(old_path, "digests"), read(new_path, "digests")).collect()]  # at most LEAVES numbers
    old, new = (read(p, "rows").filter(F.col("leaf").isin(leaves) if leaves else F.lit(False)) for p in (old_path, new_path))
    return differences(old, new, key, spark.createDataFrame([(x,) for x in leaves], "leaf int"))
