"""Billing-shaped views over the driver's TPC-H-style tables.

The test tables hold no billing data, so these views give them the shape of
the landed sources (nested plans, user subscriptions, invoices, landing pages,
CRM documents). Each view is a narrow projection of one base table and grows
with it; the only shuffles are the page and project builds, whose groups are
bounded by the page size and by the statuses of one project.

Every rule below is mirrored in ``subledger.plans.oracle`` as DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
import functools
import weakref

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.params import UTC, ReportParams

ISO = "yyyy-MM-dd'T'HH:mm:ss"
PAGE_KEYS = 100          # records of one landing page cover 100 consecutive keys
#: The 'plans' page answered with HTTP 500 and the CRM listing's page answered 503: at nine tenths of the pages, 2 at least.
FAILED_TENTHS = 9
REPEATED_PAGE = 2        # page of the 'usersubs' source delivered twice
CRM_PAGE_KEYS = 10


# Source views are defined once per session and directory, like temp views:
# only the lazy DataFrame definitions are kept (no data is cached), so every
# query still reads and computes everything from the tables. Entries go away
# with their session.
_VIEWS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def _view(fn):
    @functools.wraps(fn)
    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        views = _VIEWS.setdefault(spark, {})
        key = (fn.__name__, sf_dir.rstrip("/"))
        if key not in views:
            views[key] = fn(spark, sf_dir)
        return views[key]
    return get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def proxy_params(**overrides) -> ReportParams:
    """Parameters under which every branch of the report is populated on the proxies."""
    base = dict(
        chosen_month=7, chosen_year=1998, chosen_yearly_start_year=1997,
        window_month1=7, window_month2=8, window_year=1998, window_yearly_start_year=1997,
        current_year=1998, last_yearly_start_year=1997,
        invoice_since=dt.datetime(1997, 7, 1, tzinfo=UTC),
        excluded_plan_ids=(1, 2, 3), excluded_user_ids=(7, 9),
        as_of=dt.datetime(1999, 1, 1), local_timezone="UTC",
        crm_target_status=" NATION_8",
    )
    base.update(overrides)
    return ReportParams(**base)


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ---- plans ------------------------------------------------------------------
@_view
def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan catalogue: every customer not divisible by 10 is a plan."""
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    interval = (F.when(seg == "BUILDING", "month").when(seg == "MACHINERY", "year")
                .when(seg == "FURNITURE", "week"))
    return (c.filter(F.col("c_custkey") % 10 != 0)
            .select(F.col("c_custkey").alias("id"),
                    F.concat(F.lit("Plan "), _s("c_custkey")).alias("name"),
                    F.struct(interval.alias("recurring_interval")).alias("price")))


# ---- user subscriptions -------------------------------------------------------
def _tax_number(k: Column, cust: Column) -> Column:
    padded = F.lpad(_s(cust), 10, "0")
    m = k % 6
    return (F.when(m == 0, F.lit(None).cast("string"))
            .when(m == 1, F.lit(""))
            .when(m == 2, F.concat(F.lit(" "), padded, F.lit(" ")))
            .when(m == 3, F.concat_ws("-", F.substring(padded, 1, 3), F.substring(padded, 4, 3),
                                      F.substring(padded, 7, 2), F.substring(padded, 9, 2)))
            .when(m == 4, _s(cust))
            .otherwise(F.concat(F.lit("PL"), padded)))


@_view
def usersubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user subscription per order, nested like the booking API's records."""
    o = table(spark, sf_dir, "orders")
    k, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    fmt = lambda ts: F.date_format(ts, ISO)
    created_at = (F.when(k % 37 == 0, F.lit("")).when(k % 41 == 0, F.lit("  "))
                  .otherwise(F.concat(fmt(day), F.when(k % 2 == 0, F.lit("Z")).otherwise(F.lit("+02:00")))))
    ends_at = (F.when(k % 3 == 0, F.lit(None).cast("string"))
               .when(k % 29 == 0, F.lit("not-a-date"))
               .otherwise(F.concat(fmt(F.date_add(day, 365).cast("timestamp_ntz")), F.lit("Z"))))
    canceled_at = F.when(k % 4 == 0, F.concat(fmt(F.date_add(day, 30).cast("timestamp_ntz")),
                                              F.lit("+01:00")))
    billing = (F.when(k % 17 == 0, F.lit(None).cast("string")).when(k % 19 == 0, F.lit(""))
               .otherwise(_s(k)))
    status = (F.when(F.col("o_orderstatus") == "F", "active")
              .when(F.col("o_orderstatus") == "O", "canceled").otherwise("trial"))
    user = F.struct(
        F.when(k % 31 == 0, F.lit(None).cast("bigint")).otherwise(cust % 50).alias("id"),
        F.concat(F.lit("Name"), _s(cust % 1000)).alias("name"),
        F.when(k % 23 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Surname"), _s(cust % 97))).alias("surname"),
        F.concat(F.lit("user"), _s(cust), F.lit("@example.com")).alias("email"),
        F.when(k % 7 == 0, F.lit(None))
         .otherwise(F.struct(F.concat(F.lit("+48"), F.lpad(_s(cust), 9, "0")).alias("e164")))
         .alias("default_phone"),
        F.when(k % 13 == 0, F.lit(None))
         .otherwise(F.struct(
             F.when(k % 11 == 0, F.lit(None).cast("string"))
              .otherwise(F.concat(F.lit("Company "), _s(cust))).alias("name"),
             _tax_number(k, cust).alias("tax_number")))
         .alias("default_address"),
    )
    return o.select(
        k.alias("id"), cust.alias("subscription_id"), status.alias("status"),
        created_at.alias("created_at"), ends_at.alias("ends_at"), canceled_at.alias("canceled_at"),
        billing.alias("stripe_subscription_id"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("subscription"),
        user.alias("user"))


# ---- invoices -----------------------------------------------------------------
def _line_items(ln: Column, pk: Column, line_status: Column) -> Column:
    item = lambda d, a, i: F.struct(d.alias("description"),
                                    F.struct(a.alias("active"), i.alias("interval")).alias("plan"))
    desc = F.concat(F.lit("Item "), _s(pk))
    interval = F.when(pk % 2 == 0, F.lit("month")).otherwise(F.lit("year"))
    null_s = F.lit(None).cast("string")
    m = ln % 4
    return (F.when(m == 0, F.array().cast("array<struct<description:string,"
                                          "plan:struct<active:boolean,interval:string>>>"))
            .when(m == 1, F.array(item(desc, line_status == "O", interval)))
            .when(m == 2, F.array(F.struct(null_s.alias("description"),
                                           F.lit(None).cast("struct<active:boolean,interval:string>")
                                           .alias("plan"))))
            .otherwise(F.array(item(desc, F.lit(True), null_s),
                               item(F.lit("Second"), F.lit(False), F.lit("week")))))


def created_epoch(ln: Column, ship: Column) -> Column:
    """Ship day at 00:00 UTC plus 3 h per line number: unique within an order."""
    return (F.unix_date(F.to_date(ship)).cast("bigint") * 86400
            + (ln.cast("bigint") - 1) * 3 * 3600)


@_view
def invoices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per line item, typed like the billing API's invoice object."""
    li = table(spark, sf_dir, "lineitem")
    k, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    due = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    status = (F.when(pk % 53 == 0, F.lit(None).cast("string")).when(F.col("l_returnflag") == "A", "paid")
              .when(F.col("l_returnflag") == "R", "void").otherwise("open"))
    paid_amt = F.when(status == "paid", due).otherwise(F.lit(0).cast("bigint"))
    return li.select(
        F.concat(F.lit("in_"), _s(k), F.lit("_"), _s(ln)).alias("id"),
        due.alias("amount_due"), paid_amt.alias("amount_paid"),
        (due - paid_amt).alias("amount_remaining"),
        created_epoch(ln, F.col("l_shipdate")).alias("created"),
        F.concat(F.lit("cus_"), _s("l_suppkey")).alias("customer"),
        F.when(k % 41 == 0, F.lit(None).cast("string")).otherwise(_s(k)).alias("subscription"),
        (ln % 3).alias("attempt_count"),
        F.when(ln == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("pi_"), _s(k), F.lit("_"), _s(ln))).alias("payment_intent"),
        status.alias("status"), (status == "paid").alias("paid"),
        F.struct(_line_items(ln, pk, F.col("l_linestatus")).alias("data")).alias("lines"),
    )


@_view
def invoices_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices as raw JSON text, where a key may be missing or explicitly null."""
    li = table(spark, sf_dir, "lineitem")
    k, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    inv_id = F.concat(F.lit("in_"), _s(k), F.lit("_"), _s(ln))
    desc = F.concat(F.lit('"Item '), _s(pk), F.lit('"'))
    active = F.when(F.col("l_linestatus") == "O", F.lit("true")).otherwise(F.lit("false"))
    interval = F.when(pk % 2 == 0, F.lit('"month"')).otherwise(F.lit('"year"'))
    m = ln % 7
    data = (F.when(m == 0, F.lit("[]"))
            .when(m == 1, F.concat(F.lit('[{"description":'), desc, F.lit(',"plan":{"active":'),
                                   active, F.lit(',"interval":'), interval, F.lit("}}]")))
            .when(m == 2, F.lit('[{"plan":null}]'))
            .when(m == 3, F.lit('[{"description":null,"plan":{}}]'))
            .when(m == 4, F.concat(F.lit('[{"description":'), desc,
                                   F.lit(',"plan":{"active":false}}]')))
            .when(m == 5, F.concat(F.lit('[{"description":'), desc,
                                   F.lit(',"plan":{"active":null,"interval":null}}]')))
            .otherwise(F.concat(F.lit('[{"description":'), desc,
                                F.lit('},{"description":"Second","plan":{"active":true,'
                                      '"interval":"week"}}]'))))
    due = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    paid = (F.col("l_returnflag") == "A") & (pk % 53 != 0)
    status = (F.when(pk % 53 == 0, F.lit("null")).when(paid, F.lit('"paid"')).when(F.col("l_returnflag") == "R", F.lit('"void"'))
              .otherwise(F.lit('"open"')))
    paid_amt = F.when(paid, due).otherwise(F.lit(0).cast("bigint"))
    sub = F.when(k % 41 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), _s(k), F.lit('"')))

    def optional(key: str, selector: Column, value: Column) -> Column:
        """selector 0: key missing; 1: explicit null; 2: value."""
        return (F.when(selector == 0, F.lit(""))
                .when(selector == 1, F.lit(f',"{key}":null'))
                .otherwise(F.concat(F.lit(f',"{key}":'), value)))

    body = F.concat(
        F.lit('{"id":"'), inv_id, F.lit('","amount_due":'), _s(due),
        F.lit(',"amount_paid":'), _s(paid_amt), F.lit(',"amount_remaining":'), _s(due - paid_amt),
        F.lit(',"created":'), _s(created_epoch(ln, F.col("l_shipdate"))),
        F.lit(',"customer":"cus_'), _s("l_suppkey"), F.lit('","subscription":'), sub,
        F.lit(',"status":'), status,
        optional("attempt_count", ln % 3, _s(ln)),
        optional("payment_intent", pk % 3,
                 F.concat(F.lit('"pi_'), _s(k), F.lit("_"), _s(ln), F.lit('"'))),
        optional("paid", F.col("l_suppkey") % 3, F.when(paid, F.lit("true")).otherwise(F.lit("false"))),
        F.lit(',"lines":{"data":'), data, F.lit("}}"))
    return li.select(inv_id.alias("id"), body.alias("json"))


# ---- landing pages --------------------------------------------------------------
def _failed_page(last_page: Column) -> Column:
    return F.greatest((last_page * FAILED_TENTHS / 10).cast("int"), F.lit(2))


def _pages(records: DataFrame, source: str, key: str, fails: bool = False,
           repeated_page: int | None = None) -> DataFrame:
    """Cut records into pages of PAGE_KEYS consecutive keys, body = JSON array text.

    Groups are bounded by the page size, so collect_list never sees a hot group.
    """
    page_no = (F.col(key) / PAGE_KEYS).cast("bigint").cast("int") + 1
    rec = F.struct(*[F.col(c) for c in records.columns])
    pages = (records.withColumn("page_no", page_no).groupBy("page_no")
             .agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), rec.alias("r"))))
                            .getField("r")).alias("body"),
                  F.count(F.lit(1)).alias("n")))
    # announced total and last page: one pass, one single-row scalar subquery
    stats = records.select(F.struct(
        F.count(F.lit(1)).alias("total"),
        ((F.max(key) / PAGE_KEYS).cast("bigint").cast("int") + 1).alias("last_page"))).scalar()
    status = F.lit(200)
    if fails:
        status = F.when(F.col("page_no") == _failed_page(stats.getField("last_page")), F.lit(500)).otherwise(F.lit(200))
    out = pages.select(
        F.lit(source).alias("source"), F.col("page_no"), status.alias("http_status"),
        stats.getField("total").alias("total"),
        stats.getField("last_page").alias("last_page"),
        F.when(status == 200, F.col("body")).alias("body"))
    if repeated_page is not None:
        again = (out.filter(F.col("page_no") == repeated_page)
                 .withColumn("page_no", F.col("last_page") + 1))
        out = out.unionByName(again)
    return out


@_view
def landing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table of paged API answers for two sources.

    'usersubs': orders as user-subscription records, every page answered, one
    page delivered a second time after the last (an API that repeats a page).
    'plans': customers as plan records, a page at nine tenths answered with HTTP 500.
    """
    us = usersubs(spark, sf_dir)
    pl = plans(spark, sf_dir)
    return (_pages(us, "usersubs", "id", repeated_page=REPEATED_PAGE)
            .unionByName(_pages(pl, "plans", "id", fails=True)))


# Pages of the 'odd' source, by number: retried, never landed, padded but empty, cut off, an error object
ODD_RETRIED, ODD_ABSENT, ODD_EMPTY, ODD_CUT, ODD_ERROR = 2, 5, 7, 8, 9


@_view
def odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans as pages of a fetch run with every kind of bad page, after an older, complete run.

    Page ODD_RETRIED was answered 500 and then 200; ODD_ABSENT was never landed;
    the bodies of ODD_EMPTY, ODD_CUT and ODD_ERROR are an empty array between
    blanks, a truncated array and a long error object, all with status 200.
    """
    good = _pages(plans(spark, sf_dir), "odd", "id").withColumn("attempt", F.lit(0))
    n = F.col("page_no")
    body = (F.when(n == ODD_EMPTY, F.concat(F.lit("["), F.repeat(F.lit(" "), F.lit(80)), F.lit("]")))
            .when(n == ODD_CUT, F.substring("body", 1, 200))
            .when(n == ODD_ERROR, F.concat(F.lit('{"error":"'), F.repeat(F.lit("x"), F.lit(300)), F.lit('"}')))
            .otherwise(F.col("body")))
    retried = good.withColumn("attempt", F.when(n == ODD_RETRIED, F.lit(1)).otherwise(F.lit(0)))
    failed = good.filter(n == ODD_RETRIED).withColumn("http_status", F.lit(500)).withColumn("body", F.lit("<html>busy</html>"))
    run = retried.unionByName(failed).filter(n != ODD_ABSENT).withColumn("body", body)
    return run.withColumn("run_id", F.lit("2025-02")).unionByName(good.withColumn("run_id", F.lit("2025-01")))


@_view
def late_key_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 'usersubs' pages, with keys that one record alone has: the first of page 1 a number ``odd``, the first
    of the last page of new keys ``coupon`` (an object), ``tags`` (an array) and ``odd`` (a text), and a null ``gone``."""
    pages = landing_pages(spark, sf_dir).filter(F.col("source") == "usersubs")
    n, body = F.col("page_no"), F.col("body")
    late = '{"coupon":{"code":"LATE","percent":15},"tags":["a",1],"odd":"text","gone":null,'
    return pages.withColumn("body", F.when(n == F.col("last_page"), F.concat(F.lit("[" + late), F.substr(body, F.lit(3))))
                            .when(n == 1, F.concat(F.lit('[{"odd":1,'), F.substr(body, F.lit(3)))).otherwise(body))


# ---- grids and runs ---------------------------------------------------------------
@_view
def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet as an earlier run left it: notes in A and G, its report in C to E; every 7th row is absent, row 1 holds headings."""
    k = F.col("o_orderkey")
    cell = lambda name: F.concat(F.lit(f"{name}-"), _s(k))
    return table(spark, sf_dir, "orders").filter((k % 7 != 0) | (k == 1)).select(
        k.cast("bigint").alias("row_no"), *[(F.when(k % 3 == 0, cell(c)) if c in "AG" else cell(c)).alias(c) for c in "ACDEG"])


@_view
def next_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later run of the user subscriptions (id, subscription_id, status, ends_at): by id, every 97th is
    gone, every 89th has another status, every 83rd comes twice, and every 101st has a new record beside it."""
    us = usersubs(spark, sf_dir).select("id", "subscription_id", "status", "ends_at")
    k = F.col("id")
    row = lambda key, status: F.struct(key.alias("id"), F.col("subscription_id"), status.alias("status"), F.col("ends_at"))
    same = row(k, F.when(k % 89 == 0, F.lit("paused")).otherwise(F.col("status")))
    rows = F.array_compact(F.array(F.when(k % 97 != 0, same), F.when((k % 97 != 0) & (k % 83 == 0), same),
                                   F.when(k % 101 == 0, row(k + 1_000_000_000_000, F.col("status")))))
    return us.select(F.explode(rows).alias("_r")).select("_r.*")


# ---- cursor pages ---------------------------------------------------------------
CURSOR_CHAINS, CURSOR_KEYS = 3, 100


@_view
def cursor_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices as pages that only cursors order: three sources, by the order's number modulo 3, pages of 100 of its orders.

    At nine tenths of the pages (n), source 1 has one that failed and source 2 one that says it
    is the last. Page n was tried twice where n % 7 = 3, has a rival for its cursor where
    n % 5 = 4 (not beside the failed one), and source 0 has two pages in a ring where
    n % 11 = 6. First pages were landed by an older run too.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    k, n, c = F.col("l_orderkey"), F.col("n"), F.col("c")
    inv = F.concat(F.lit("in_"), _s(k), F.lit("_"), _s("l_linenumber"))
    rec = F.struct(inv.alias("id"), created_epoch(F.col("l_linenumber"), F.col("l_shipdate")).alias("created"))
    page = (k / (CURSOR_CHAINS * CURSOR_KEYS)).cast("bigint")
    place = F.struct(k.alias("k"), F.col("l_linenumber").alias("l"), rec.alias("r"))
    base = li.groupBy((k % CURSOR_CHAINS).alias("c"), page.alias("n")).agg(F.sort_array(F.collect_list(place)).getField("r").alias("data"))
    at = (F.floor(li.select((F.max(page) * 9 / 10)).scalar())).cast("bigint")
    failed = (c == 1) & (n == F.greatest(at, F.lit(1)))
    ended = (c == 2) & (n == F.greatest(at, F.lit(1)))
    # the id that the page before ends with, without its other records: of numbers alone, which are added up without a sort
    lines = li.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("l_linenumber"))
    ends = lines.groupBy((k % CURSOR_CHAINS).alias("_c"), (page + 1).alias("_n")).agg(F.max(k).alias("l_orderkey"), F.max_by("l_linenumber", k).alias("l_linenumber"))
    ends = ends.select("_c", "_n", inv.alias("_last"))
    base = base.join(ends, (c == F.col("_c")) & (n == F.col("_n")), "left")
    cursor = F.when(n > 0, F.coalesce("_last", F.concat_ws("_", F.lit("gap"), c, n)))
    body = lambda data, more: F.to_json(F.struct(data.alias("data"), more.alias("has_more")))
    tried = F.when(n % 7 == 3, 1).otherwise(0)
    row = lambda kind, cur, status, attempt, run="2025-02": F.struct(
        F.lit(kind).alias("kind"), cur.alias("starting_after"), status.alias("http_status"), attempt.alias("attempt"), F.lit(run).alias("run_id"))
    rows = F.array_compact(F.array(
        row("page", cursor, F.when(failed, 500).otherwise(200), tried),
        F.when(n % 7 == 3, row("busy", cursor, F.lit(503), F.lit(0))),
        F.when((n % 5 == 4) & ~failed, row("zz", cursor, F.lit(200), tried)),
        F.when((n % 11 == 6) & (c == 0), row("cyb", F.concat_ws("_", F.lit("cya"), c, n), F.lit(200), F.lit(0))),
        F.when((n % 11 == 6) & (c == 0), row("cya", F.concat_ws("_", F.lit("cyb"), c, n), F.lit(200), F.lit(0))),
        F.when(n == 0, row("old", cursor, F.lit(200), F.lit(0), "2025-01"))))
    kind = F.col("_row.kind")
    # bodies are written after the rows are told apart, so that a reader of other columns writes none
    text = F.when(kind == "page", F.when(~failed, body(F.col("data"), ~ended))).when(kind == "busy", "<html>busy</html>").otherwise(
        body(F.array(F.struct(F.concat_ws("_", kind, c, n).alias("id"), F.lit(0).cast("bigint").alias("created"))), F.lit(True)))
    return base.select("c", "n", "data", F.explode(rows).alias("_row")).select(
        F.concat(F.lit("inv"), _s(c)).alias("source"), "_row.starting_after", "_row.http_status", text.alias("body"), "_row.attempt", "_row.run_id")


# ---- CRM ----------------------------------------------------------------------
@_view
def crm_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CRM project document per region; its statuses are that region's nations.

    Even nation keys carry names between a space and a tab, so the lookup must strip white space.
    """
    n = table(spark, sf_dir, "nation")
    name = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit(" "), F.col("n_name"), F.lit("\t"))) \
        .otherwise(F.col("n_name"))
    st = F.struct(F.col("n_nationkey").alias("k"),
                  F.struct(F.concat(F.lit("st"), _s("n_nationkey")).alias("_id"), name.alias("name")).alias("s"))
    return (n.groupBy(F.col("n_regionkey"))
            .agg(F.array_sort(F.collect_list(st)).getField("s").alias("statuses"))
            .select(F.concat(F.lit("pr"), _s("n_regionkey")).alias("project_id"),
                    F.to_json(F.struct(F.concat(F.lit("pr"), _s("n_regionkey")).alias("_id"),
                                       F.col("statuses"))).alias("body")))


@_view
def crm_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task list pages by status: supplier s is task 't<s>' in status 'st<nation>'."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("st"), _s("s_nationkey")).alias("status_id"),
        (F.col("s_suppkey") / CRM_PAGE_KEYS).cast("bigint").cast("int").alias("page_no"),
        F.concat(F.lit("t"), _s("s_suppkey")).alias("_id"))


@_view
def crm_task_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task detail documents (JSON text); every 13th task has no detail."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    num = _s(((k * 7919 + 1) * 1000003) % 100000000000)
    m = k % 8
    company = (F.when(m == 0, F.concat(F.lit('{"nip":'), num, F.lit("}")))
               .when(m == 1, F.concat(F.lit('{"nip":'), num, F.lit(".0}")))
               .when(m == 2, F.concat(F.lit('{"nip":"PL-'), num, F.lit('"}')))
               .when(m == 3, F.lit('{"nip":""}'))
               .when(m == 4, F.lit('{"nip":-5}'))
               .when(m == 5, F.lit('{"name":"x"}'))
               .when(m == 6, F.lit('"not an object"'))
               .otherwise(F.lit('{"nip":null}')))
    client = F.when(k % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"client":{"company":'), company, F.lit("}")))
    body = F.concat(F.lit('{"_id":"t'), _s(k), F.lit('"'), client, F.lit("}"))
    return s.filter(k % 13 != 0).select(F.concat(F.lit("t"), _s(k)).alias("_id"), body.alias("body"))


CRM_EMPTY_PAGE = 1


@_view
def crm_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task listing over all tasks, pages from 0: page CRM_EMPTY_PAGE is an empty array
    (the listing goes on), a page at nine tenths answered 503 (the listing ends), and a page beyond
    the announced count plus one is never asked for."""
    t = crm_tasks(spark, sf_dir).withColumn("_at", F.substring("_id", 2, 20).cast("bigint"))
    pages = _paged(t.select("_id", "_at", "page_no"), "crm_tasks/all", F.col("page_no"), F.col("_at"), helpers=("_at", "page_no"))
    n, failed = F.col("page_no"), F.col("page_no") == _failed_page(F.col("last_page"))
    return (pages.withColumn("http_status", F.when(failed, F.lit(503)).otherwise(F.lit(200)))
            .withColumn("body", F.when(n == CRM_EMPTY_PAGE, F.lit(" [ ] ")).when(~failed, F.col("body"))))


# ---- a complete, clean landing table (for the end-to-end job) --------------------
def _paged(records: DataFrame, source: Column | str, page_of: Column, sort_key: Column,
           helpers: tuple[str, ...] = ()) -> DataFrame:
    """Pages of JSON-array bodies; records ordered by ``sort_key`` inside a page.

    ``source`` may be a column (one landing source per value); ``helpers``
    are columns used for paging only, left out of the records. Groups are
    bounded by the page size.
    """
    src = F.lit(source) if isinstance(source, str) else source
    rec = F.struct(*[F.col(c) for c in records.columns if c not in helpers])
    pages = (records.select(src.alias("source"), page_of.alias("page_no"),
                            F.struct(sort_key.alias("k"), rec.alias("r")).alias("kr"))
             .groupBy("source", "page_no")
             .agg(F.to_json(F.array_sort(F.collect_list("kr")).getField("r")).alias("body"),
                  F.count(F.lit(1)).alias("n")))
    columns = [F.sum("n").alias("total"), F.max("page_no").alias("last_page")]
    if isinstance(source, str):  # one source: its statistics are one row
        stats = pages.select("n", "page_no").agg(*columns).select(F.struct("total", "last_page")).scalar()
        pages = pages.withColumn("total", stats.getField("total")).withColumn("last_page", stats.getField("last_page"))
    else:
        pages = pages.join(pages.groupBy("source").agg(*columns), "source")
    return pages.select("source", "page_no", F.lit(200).alias("http_status"), "total", "last_page", "body")


def complete_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source the report job reads, landed cleanly (no failed or repeated page).

    Invoice pages hold whole orders, newest invoice first, so the landed
    arrival order equals the proxy invoices' order. The job over this landing
    must reproduce the ``subscription_report`` query row for row.
    """
    page = lambda c: ((c / PAGE_KEYS).cast("bigint") + 1).cast("int")
    # the order key is the middle part of the invoice id ('in_<order>_<line>')
    inv = invoices_raw(spark, sf_dir).withColumn(
        "_order", F.split(F.col("id"), "_").getItem(1).cast("bigint"))
    invoices = _paged(inv, "invoices", page(F.col("_order")),
                      F.struct(F.col("_order"), -F.col("created")), helpers=("_order",))
    us, pl = usersubs(spark, sf_dir), plans(spark, sf_dir)
    project = (crm_projects(spark, sf_dir)
               .select(F.lit("crm_project").alias("source"), F.lit(1).alias("page_no"),
                       F.lit(200).alias("http_status"), F.lit(1).cast("bigint").alias("total"),
                       F.lit(1).alias("last_page"), "body")
               .filter(F.col("body").contains('"_id":"pr3"')))
    rank = F.row_number().over(Window.partitionBy("status_id").orderBy(F.substring("_id", 2, 20).cast("bigint")))
    tasks = crm_tasks(spark, sf_dir).withColumn("page_no", ((rank - 1) / CRM_PAGE_KEYS).cast("int"))
    task_pages = _paged(tasks, F.concat(F.lit("crm_tasks/"), F.col("status_id")), F.col("page_no"),
                        F.col("_id"), helpers=("status_id", "page_no"))
    det = crm_task_details(spark, sf_dir)
    details = (det.groupBy(page(F.substring("_id", 2, 20).cast("bigint")).alias("page_no"))
               .agg(F.concat(F.lit("["), F.concat_ws(",", F.array_sort(F.collect_list("body"))), F.lit("]"))
                    .alias("body"))
               .select(F.lit("crm_task_details").alias("source"), "page_no",
                       F.lit(200).alias("http_status"), F.lit(None).cast("bigint").alias("total"),
                       F.lit(None).cast("int").alias("last_page"), "body"))
    return (_paged(us, "usersubs", page(F.col("id")), F.col("id"))
            .unionByName(_paged(pl, "plans", page(F.col("id")), F.col("id")))
            .unionByName(invoices).unionByName(project).unionByName(task_pages).unionByName(details))
