"""Q2, A4: two runs of a source, compared by digests of key ranges first."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from subledger.operators import reconcile

SCHEMA = "id long, status string, n double"


def brute(old, new):
    out = set()
    for key in {r[0] for r in old + new}:
        a, b = (Counter(r for r in rows if r[0] == key) for rows in (old, new))
        if a != b:
            state = "inserted" if not a else "deleted" if not b else "repeated" if set(a) == set(b) else "changed"
            out.add((key, state, sum(a.values()), sum(b.values())))
    return out


BASE = [(k, f"s{k % 5}", k / 3 if k % 4 else None) for k in range(300)] + [(None, "x", 1.0), (7, "other", None), (9, "s4", None)]


def changed():
    rows = [r for r in BASE if r[0] != 11]
    rows[20] = (rows[20][0], "new", rows[20][2])
    return rows + [(1000, "s", 0.0), (5, "s0", 5 / 3), (None, "x", 1.0)]


def test_planted_changes_are_all_named(spark):
    old, new = BASE, changed()
    got = {tuple(r) for r in reconcile.differences(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).select("n", "id", "status"), ["id"]).collect()}
    assert got == brute(old, new) and {s for _, s, _, _ in got} == {"inserted", "deleted", "repeated", "changed"}


def test_order_and_partitions_do_not_matter(spark):
    one, other = (spark.createDataFrame(rows, SCHEMA) for rows in (BASE, BASE[::-1]))
    assert reconcile.differing(reconcile.digests(one, ["id"]), reconcile.digests(other.repartition(7), ["id"])).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert reconcile.differences(empty, empty, ["id"]).count() == 0
    assert {r["state"] for r in reconcile.differences(empty, one, ["id"]).collect()} == {"inserted"}


def test_digests_add_up_to_the_tree(spark):
    leaves = reconcile.digests(spark.createDataFrame(BASE, SCHEMA), ["id"])
    rows = reconcile.rolled_up(leaves).collect()
    root = next(r for r in rows if r["node"] is None)
    assert root["rows"] == len(BASE) and root["one"] == sum(r["one"] for r in leaves.collect())
    assert sum(r["rows"] for r in rows if r["node"] is not None and r["leaf"] is None) == len(BASE)


@pytest.mark.parametrize("plant", [True, False])
def test_equal_ranges_are_not_read_again(spark, tmp_path, plant):
    new = [(k, "new" if plant and k == 3 else s, n) for k, s, n in BASE]
    paths = [str(tmp_path / x) for x in "ab"]
    for path, rows in zip(paths, (BASE, new)):
        reconcile.write_run(spark.createDataFrame(rows, SCHEMA), ["id"], path)
    got = reconcile.reconcile(spark, *paths, ["id"])
    assert {tuple(r) for r in got.collect()} == brute(BASE, new)
    if plant:
        leaf = spark.createDataFrame([(3,)], "id long").select(reconcile.leaf_of(["id"])).first()[0]
        files = {f.split("leaf=")[1].split("/")[0] for f in spark.read.parquet(f"{paths[0]}/rows").filter(F.col("leaf").isin([leaf])).inputFiles()}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert f"PartitionFilters: [(leaf" in plan or f"leaf" in plan.split("PartitionFilters")[1][:80]
        assert str(leaf) in files


def test_hot_key(spark):
    old = [(1, "s", float(k % 3)) for k in range(600)] + [(k, "s", 0.0) for k in range(2, 50)]
    got = {tuple(r) for r in reconcile.differences(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(old[1:], SCHEMA), ["id"]).collect()}
    assert got == {(1, "repeated", 600, 599)}
