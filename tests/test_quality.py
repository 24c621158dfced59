"""Data-quality operators."""

from pyspark.sql import functions as F

from subledger.operators.quality import completeness, duplicate_ids, observe_count, required_fields
from subledger.schemas import LANDING_PAGE, USER_SUBSCRIPTION


def _pages(spark, total):
    return spark.createDataFrame([("s", 1, 200, total, 1, "[]", None, None)], LANDING_PAGE)


def test_completeness_threshold(spark):
    r95 = completeness(_pages(spark, 100), spark.range(95), "s").collect()[0]
    assert (r95["missing"], r95["significant"]) == (5, False)
    r90 = completeness(_pages(spark, 100), spark.range(90), "s").collect()[0]
    assert (r90["missing"], r90["significant"]) == (10, True)


def test_duplicate_ids(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint")
    r = duplicate_ids(df, "id", "s").collect()[0]
    assert (r["records"], r["distinct_ids"], r["null_ids"], r["duplicates"]) == (4, 2, 1, 1)
    # ids [1, None, None]: a set holds {1, None}, so one duplicate
    two_null = spark.createDataFrame([(1,), (None,), (None,)], "id bigint")
    assert duplicate_ids(two_null, "id", "s").collect()[0]["duplicates"] == 1


def test_required_fields_counts_all_rows(spark):
    rows = [(1, None, "active", None, None, None, None, None, (5, None, None, None, None, None)),
            (2, 3, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, USER_SUBSCRIPTION)
    out = {r["field"]: r["missing"] for r in
           required_fields(df, ["id", "subscription_id", "status", "user.id", "nope"], "u").collect()}
    assert out == {"id": 0, "subscription_id": 1, "status": 1, "user.id": 1, "nope": 2}


def test_observe_count_no_extra_job(spark):
    df, obs = observe_count(spark.range(10).filter(F.col("id") > 2), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_required_keys_null_counts_as_present(spark):
    from subledger.operators.quality import required_keys
    docs = ['{"id":1,"user":{"id":null}}', '{"id":2,"user":{}}', '{"user":null}']
    df = spark.createDataFrame([(d,) for d in docs], "j string").select(F.parse_json("j").alias("doc"))
    out = {r["field"]: r["missing"] for r in required_keys(df, ["id", "user", "user.id"], "s").collect()}
    assert out == {"id": 1, "user": 0, "user.id": 2}
