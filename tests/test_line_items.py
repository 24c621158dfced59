"""First line item: typed path and VARIANT path (missing key vs explicit null)."""

from pyspark.sql import functions as F

from subledger.operators.line_items import first_line_item, first_line_item_variant, invoice_fact
from subledger.params import Labels, ReportParams
from subledger.schemas import INVOICE_FACT_COLUMNS, INVOICE_RAW

LB = Labels()
PH = (LB.no_description, LB.no_plan_active, LB.no_plan_interval)


def test_variant_path(spark):
    docs = ['{"lines":{"data":[]}}',
            '{"lines":{"data":[{"description":"A","plan":{"active":true,"interval":"month"}}]}}',
            '{"lines":{"data":[{"plan":null}]}}',
            '{"lines":{"data":[{"description":null,"plan":{}}]}}',
            '{"lines":{"data":[{"description":"B","plan":{"active":false}}]}}',
            '{"lines":{"data":[{"description":"C"},{"description":"D","plan":{"active":true}}]}}']
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    cols = first_line_item_variant(F.parse_json("j"), LB)
    out = [tuple(r) for r in df.select(*cols).collect()]
    assert out == [PH, ("A", "true", "month"), (LB.no_description, PH[1], PH[2]),
                   (None, PH[1], PH[2]), ("B", "false", PH[2]), ("C", PH[1], PH[2])]


def test_typed_path_and_fact(spark):
    rows = [("i1", 1000, 1000, 0, 1751320800, "c", "s1", 1, "pi", "paid", True, ([],)),
            ("i2", 250, 0, 250, 1751320800, "c", "s1", None, None, "open", None,
             ([("X", None), ("Y", (True, "year"))],)),
            ("i3", 1, 0, 1, 1600000000, "c", None, 0, None, "open", False, ([("Z", (False, "month"))],))]
    raw = spark.createDataFrame(rows, INVOICE_RAW)
    fact = invoice_fact(raw, ReportParams(local_timezone="Europe/Warsaw"))
    assert tuple(fact.columns) == INVOICE_FACT_COLUMNS
    got = {r["id"]: r for r in fact.collect()}
    assert set(got) == {"i1", "i2"}                     # i3 is before the lower bound
    assert (got["i1"]["lines_data_description"], got["i1"]["plan_active"]) == (PH[0], PH[1])
    assert (got["i2"]["lines_data_description"], got["i2"]["plan_interval"]) == ("X", PH[2])
    assert got["i2"]["amount_due"] == 2.5 and str(got["i1"]["created"]) == "2025-07-01"
    d, a, i = first_line_item(F.col("lines.data"), LB)
    assert [tuple(r) for r in raw.filter(F.col("id") == "i3").select(d, a, i).collect()] == \
        [("Z", "false", "month")]


def test_variant_invoice_fact_top_level_defaults(spark):
    from subledger.operators.line_items import invoice_fact_variant
    base = '"id":"%s","amount_due":250,"amount_paid":0,"amount_remaining":250,"created":1751320800,' \
           '"customer":"c","subscription":"s","status":"open","lines":{"data":[]}'
    docs = ["{" + base % "a" + "}",
            "{" + base % "b" + ',"attempt_count":null,"payment_intent":null,"paid":null}',
            "{" + base % "c" + ',"attempt_count":3,"payment_intent":"pi","paid":true}',
            "{" + (base % "d").replace("1751320800", "1600000000") + "}"]
    df = spark.createDataFrame([(d,) for d in docs], "json string")
    got = {r["id"]: r for r in invoice_fact_variant(df, ReportParams()).collect()}
    assert set(got) == {"a", "b", "c"}          # d is before the lower bound
    assert (got["a"]["attempt_count"], got["a"]["payment_intent"], got["a"]["paid"]) == \
        (0, LB.no_payment_intent, False)
    assert (got["b"]["attempt_count"], got["b"]["payment_intent"], got["b"]["paid"]) == (None, None, None)
    assert (got["c"]["attempt_count"], got["c"]["payment_intent"], got["c"]["paid"]) == (3, "pi", True)
    assert got["a"]["amount_due"] == 2.5 and got["a"]["lines_data_description"] == LB.no_description
