"""Records whose keys are only known once they are seen."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.operators.flatten import flatten_variant, merged_schema, observed_schema, tree_of


def docs(spark, records):
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i long, j string").select("i", F.try_parse_json("j").alias("doc"))


def flat(df, **kw):
    return {r["i"]: {k: v for k, v in r.asDict().items() if k != "i" and v is not None} for r in flatten_variant(df, observed_schema(df), keep=("i",), json=True, **kw).collect()}


def test_keys_of_any_record_become_columns(spark):
    df = docs(spark, [{"a": 1, "b": {"c": "x", "d": {"e": True}}}] * 50 + [{"a": 2, "late": {"k": 1.5}, "list": [1, {"z": 2}]}])
    got = flat(df)
    assert got[0] == {"a": 1, "b.c": "x", "b.d.e": True} and got[50] == {"a": 2, "late.k": got[50]["late.k"], "list": '[1,{"z":2}]'}
    assert float(got[50]["late.k"]) == 1.5


def test_unlike_types_nulls_and_scalars(spark):
    got = flat(docs(spark, [{"a": 1}, {"a": "text"}, {"a": {"b": 1}}, {"a": None}, {"n": None}, 5, [1], None, {}]))
    assert got[0] == {"a": "1"} and got[1] == {"a": '"text"'} and got[2] == {"a": '{"b":1}'} and all(got[i] == {} for i in range(3, 9))


def test_odd_key_names(spark):
    record = {"it's": 1, 'say "hi"': 2, "a.b": 3, "": 4, "both ' and \"": {"x y": 5}, "OBJECT<": 6, "`tick`": 7, "$": 8, "[0]": 9}
    got = flat(docs(spark, [record]))[0]
    assert got == {"it's": 1, 'say "hi"': 2, "a.b": 3, "": 4, "both ' and \".x y": 5, "OBJECT<": 6, "`tick`": 7, "$": 8, "[0]": 9}


def test_one_name_for_two_leaves(spark):
    got = flat(docs(spark, [{"a": {"b": 1}}, {"a_b": 2}, {"a": {"b": 3}, "a_b": 4}]), sep="_")
    assert [got[i]["a_b"] for i in range(3)] in ([1, 2, 3], [1, 2, 4])


def test_no_records(spark):
    df = docs(spark, [{"a": 1}]).limit(0)
    assert flatten_variant(df, observed_schema(df), keep=("i",)).columns == ["i"]


def test_runs_merge():
    old = tree_of("OBJECT<a: BIGINT, b: OBJECT<c: STRING, v: VOID>, gone: BOOLEAN>")
    new = tree_of("OBJECT<a: STRING, b: OBJECT<d: BIGINT, v: BIGINT>, more: ARRAY<VARIANT>>")
    got = merged_schema(old, new)
    assert got["a"].dataType == T.VariantType() and got["b"].dataType.names == ["c", "v", "d"] and got["b"].dataType["v"].dataType == T.LongType()
    assert got.names == ["a", "b", "gone", "more"] and merged_schema(got, got) == got


def test_flattening_is_one_projection(spark):
    df = docs(spark, [{"a": {"b": 1}}])
    plan = flatten_variant(df, observed_schema(df), keep=("i",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
