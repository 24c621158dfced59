"""Rows that cannot be parsed are set apart and counted."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from subledger.operators import quarantine

ROWS = [(1, "2024-01-02T03:04:05Z", "2024-02-01"), (2, "", None), (3, " ", "never"), (4, "31/12/2024", "x"), (5, None, "2024-03-01T00:00:00+02:00")]


@pytest.fixture
def rows(spark):
    df = spark.createDataFrame(ROWS, "id long, a string, b string")
    return quarantine.screened(df, {"a": quarantine.timestamp(2), "b": quarantine.timestamp()})


def test_good_and_failing_rows(rows):
    good = {r["id"]: (r["a"], r["b"]) for r in quarantine.accepted(rows).collect()}
    assert good == {1: (dt.datetime(2024, 1, 2, 5, 4, 5), dt.datetime(2024, 2, 1)), 2: (None, None), 5: (None, dt.datetime(2024, 3, 1))}
    bad = sorted(tuple(r) for r in quarantine.rejected(rows, ["id"]).collect())
    assert bad == [(3, "b", "never"), (4, "a", "31/12/2024"), (4, "b", "x")]


def test_threshold(rows, spark, tmp_path):
    path = str(tmp_path / "ok")
    assert quarantine.write_screened(rows, path, 2) == {"rows": 5, "bad": 2}
    assert sorted(r["id"] for r in quarantine.read_accepted(spark, path).collect()) == [1, 2, 5]
    assert spark.read.parquet(path).filter("quarantined = 1").count() == 2
    assert quarantine.write_screened(rows, str(tmp_path / "share"), 0.4)["bad"] == 2
    assert quarantine.write_screened(rows, str(tmp_path / "any"), None)["bad"] == 2
    for k, most in enumerate((0, 1, 0.3)):
        with pytest.raises(quarantine.QuarantineError, match="2 of 5"):
            quarantine.write_screened(rows, str(tmp_path / f"no{k}"), most)
        with pytest.raises(Exception, match="(?i)path"):
            quarantine.read_accepted(spark, str(tmp_path / f"no{k}"))


def test_one_scan(spark, tmp_path):
    spark.createDataFrame(ROWS, "id long, a string, b string").write.parquet(str(tmp_path / "in"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    raw = spark.read.parquet(str(tmp_path / "in"))
    df = quarantine.screened(raw.mapInArrow(counted, raw.schema), {"a": quarantine.timestamp()})
    quarantine.write_screened(df, str(tmp_path / "out"), None)
    assert reads.value == len(ROWS)


def test_no_parsers_and_no_rows(spark):
    df = spark.createDataFrame([], "id long, a string")
    assert quarantine.accepted(quarantine.screened(df, {"a": quarantine.timestamp()})).count() == 0
    assert quarantine.screened(spark.range(2), {}).filter(F.size("_errors") == 0).count() == 2
