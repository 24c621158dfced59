"""Property tests (hypothesis): invariants the reference's semantics imply."""

import datetime as dt
import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from subledger.operators.invoice_lookup import with_invoice_columns
from subledger.operators.joins import retention_predicates
from subledger.operators.lifecycle import lifecycle_status
from subledger.params import Labels, ReportParams
from subledger.schemas import LANDING_PAGE
from subledger.sources.landing import scan_pages

REC = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
LB = Labels()


@settings(max_examples=10, deadline=None)
@given(ids=st.lists(st.integers(0, 10**6), min_size=1, max_size=40),
       cuts=st.lists(st.integers(1, 39), max_size=6))
def test_page_split_does_not_change_scan(spark, ids, cuts):
    recs = [{"id": i, "v": f"r{n}"} for n, i in enumerate(ids)]
    bounds = sorted({c for c in cuts if c < len(recs)})
    pages, start = [], 0
    for b in bounds + [len(recs)]:
        pages.append(recs[start:b])
        start = b
    rows = [("s", n, 200, len(recs), len(pages), json.dumps(p), None, None) for n, p in enumerate(pages, start=1)]
    random.Random(len(ids)).shuffle(rows)  # landing row order is irrelevant
    got = scan_pages(spark.createDataFrame(rows, LANDING_PAGE), "s", REC).orderBy("seq").collect()
    assert [(r["id"], r["v"]) for r in got] == [(r["id"], r["v"]) for r in recs]


INV = "subscription string, created date, status string, seq bigint"
SUBS = "client_sub_id bigint, billing_id string, package_type string"
P = ReportParams(chosen_month=7, chosen_year=2025, chosen_yearly_start_year=2024)


@settings(max_examples=6, deadline=None)
@given(invs=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 500),
                               st.sampled_from(["paid", "open", "void"])), min_size=1, max_size=30),
       seed=st.integers(0, 1000))
def test_row_order_does_not_matter_when_seq_is_fixed(spark, invs, seed):
    base = [(s, dt.date(2024, 6, 1) + dt.timedelta(days=d), st_, n) for n, (s, d, st_) in enumerate(invs)]
    shuffled = base[:]
    random.Random(seed).shuffle(shuffled)
    subs = spark.createDataFrame([(1, "a", LB.interval_month), (2, "b", LB.interval_year)], SUBS)

    def result(rows):
        df = spark.createDataFrame(rows, INV).repartition(3)
        return sorted(tuple(r) for r in with_invoice_columns(subs, df, P).collect())

    assert result(base) == result(shuffled)


@settings(max_examples=5, deadline=None)
@given(plans=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=30),
       excluded=st.lists(st.integers(0, 6), max_size=3))
def test_plan_exclusion_partitions_rows(spark, plans, excluded):
    df = spark.createDataFrame([(p,) for p in plans], "plan_id bigint")
    f1 = retention_predicates(ReportParams(excluded_plan_ids=tuple(excluded)), status_col="plan_id",
                              user_col="plan_id")[0]
    kept, dropped = df.filter(f1).count(), df.filter(~f1).count()
    assert kept + dropped == len(plans)
    assert kept == sum(1 for p in plans if p is None or p not in excluded)


@settings(max_examples=5, deadline=None)
@given(days=st.lists(st.one_of(st.none(), st.integers(0, 400)), min_size=1, max_size=20),
       a=st.integers(0, 400), b=st.integers(0, 400))
def test_later_as_of_never_revives_cancelled(spark, days, a, b):
    a, b = sorted((a, b))
    d0 = dt.datetime(2025, 1, 1)
    rows = [(n, None if d is None else d0 + dt.timedelta(days=d)) for n, d in enumerate(days)]
    df = spark.createDataFrame(rows, "client_sub_id bigint, expires_at timestamp_ntz")

    def statuses(offset):
        p = ReportParams(as_of=d0 + dt.timedelta(days=offset))
        return [r[0] for r in df.orderBy("client_sub_id")
                .select(lifecycle_status("client_sub_id", "expires_at", p)).collect()]

    for early, late in zip(statuses(a), statuses(b)):
        if early == LB.lifecycle_cancelled:
            assert late == LB.lifecycle_cancelled


def _report_tax_model(v):
    """P12 in plain Python: blanks unchanged, strip, all digits -> integer text."""
    if v is None or v == "":
        return v
    t = v.strip()
    return str(int(t)) if t.isdigit() and t.isascii() else t


@settings(max_examples=8, deadline=None)
@given(vals=st.lists(st.one_of(st.none(), st.text(alphabet=" \t0123456789-PLx", max_size=14)),
                     min_size=1, max_size=40))
def test_report_tax_id_matches_model(spark, vals):
    from subledger.functions.tax_id import normalize_tax_id
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(normalize_tax_id(F.col("v"))).collect()]
    assert got == [_report_tax_model(v) for v in vals]


_MISSING = object()


def _crm_tax_model(value):
    """P13 as the survey states it: a positive number is its whole part in ten digits or more, a text stays
    as it is, and whatever else stands there, or nothing at all, gives an empty text."""
    match value:
        case str():
            return value
        case int() | float() if value > 0:
            return f"{int(value):010d}"
        case _:
            return ""


nip_values = st.one_of(
    st.just(_MISSING), st.none(), st.booleans(), st.integers(-10**3, 10**12),
    st.floats(min_value=-1e6, max_value=1e11, allow_nan=False, allow_infinity=False).map(lambda f: round(f, 2)),
    st.text(alphabet="PL-0123 ", max_size=8))


@settings(max_examples=8, deadline=None)
@given(nips=st.lists(nip_values, min_size=1, max_size=30))
def test_crm_tax_id_matches_model(spark, nips):
    from subledger.functions.tax_id import crm_tax_id
    from pyspark.sql import functions as F
    docs = []
    for n in nips:
        company = {} if n is _MISSING else {"nip": n}
        docs.append(json.dumps({"client": {"company": company}}))
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    got = [r[0] for r in df.orderBy("i").select(crm_tax_id(F.parse_json("d"))).collect()]
    assert got == [_crm_tax_model(n) for n in nips]


def _line_item_model(data):
    """P14/P15 in plain Python over the decoded ``lines.data`` list."""
    if not data:
        return (LB.no_description, LB.no_plan_active, LB.no_plan_interval)
    first = data[0]
    desc = first.get("description", LB.no_description)
    plan = first.get("plan", {})
    active = plan.get("active", LB.no_plan_active) if plan else LB.no_plan_active
    interval = plan.get("interval", LB.no_plan_interval) if plan else LB.no_plan_interval
    as_text = lambda x: x if x is None or isinstance(x, str) else str(x).lower()
    return (desc, as_text(active), interval)


def _optional(key, values):
    return st.one_of(st.just({}), values.map(lambda v: {key: v}))


plan_st = st.one_of(st.none(), st.builds(lambda a, b: {**a, **b},
                                         _optional("active", st.one_of(st.none(), st.booleans())),
                                         _optional("interval", st.one_of(st.none(), st.sampled_from(["month", "year"])))))
item_st = st.builds(lambda a, b: {**a, **b},
                    _optional("description", st.one_of(st.none(), st.sampled_from(["A", "B c"]))),
                    _optional("plan", plan_st))


@settings(max_examples=8, deadline=None)
@given(invoices=st.lists(st.lists(item_st, max_size=3), min_size=1, max_size=25))
def test_first_line_item_matches_model(spark, invoices):
    from subledger.operators.line_items import first_line_item_variant
    from pyspark.sql import functions as F
    docs = [(i, json.dumps({"lines": {"data": d}})) for i, d in enumerate(invoices)]
    df = spark.createDataFrame(docs, "i int, j string")
    cols = first_line_item_variant(F.parse_json("j"), LB)
    got = [tuple(r) for r in df.orderBy("i").select(*cols).collect()]
    assert got == [_line_item_model(d) for d in invoices]
