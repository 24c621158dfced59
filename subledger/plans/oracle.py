"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans: the proxy rules are restated as flat
CASE expressions over the base tables (no string round trip, no JSON), and
the three invoice columns use correlated subqueries, one per report row, the
way the reference evaluates them. Views ``customer orders lineitem nation
supplier`` are the driver's parquet tables.
"""

from __future__ import annotations

from subledger.plans.catalog import CRM_PROJECT_ID, NEWEST_N, P
from subledger.sinks.writers import INVOICE_HEADINGS, REPORT_HEADINGS
from subledger.sources.proxies import CRM_PAGE_KEYS, PAGE_KEYS, REPEATED_PAGE


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"



PRM = P()
LB = PRM.labels

PLANS = f"""plans AS (
  SELECT c_custkey AS id, 'Plan ' || CAST(c_custkey AS VARCHAR) AS name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'month' WHEN 'MACHINERY' THEN 'year'
      WHEN 'FURNITURE' THEN 'week' END AS recurring_interval
  FROM customer WHERE c_custkey % 10 <> 0)"""

_PAD = "lpad(CAST(o_custkey AS VARCHAR), 10, '0')"
_ISO = "'%Y-%m-%dT%H:%M:%S'"

USUBS = f"""usubs AS (
  SELECT o_orderkey AS id, o_custkey AS subscription_id,
    CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'canceled' ELSE 'trial' END AS status,
    CASE WHEN o_orderkey % 37 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN '  ' ELSE
      strftime(o_orderdate, {_ISO}) || CASE WHEN o_orderkey % 2 = 0 THEN 'Z' ELSE '+02:00' END END AS created_at_raw,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'not-a-date'
      ELSE strftime(CAST(CAST(o_orderdate AS DATE) + 365 AS TIMESTAMP), {_ISO}) || 'Z' END AS ends_at_raw,
    CASE WHEN o_orderkey % 4 = 0 THEN strftime(CAST(CAST(o_orderdate AS DATE) + 30 AS TIMESTAMP), {_ISO}) || '+01:00'
      END AS canceled_at_raw,
    CASE WHEN o_orderkey % 37 <> 0 AND o_orderkey % 41 <> 0 THEN o_orderdate + INTERVAL 2 HOUR END AS purchased_at,
    CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 29 = 0 THEN NULL
      ELSE CAST(CAST(o_orderdate AS DATE) + 365 AS TIMESTAMP) + INTERVAL 2 HOUR END AS expires_at,
    CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 30 AS TIMESTAMP) + INTERVAL 2 HOUR
      END AS cancelled_raw,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ''
      ELSE CAST(o_orderkey AS VARCHAR) END AS billing_id,
    o_orderpriority AS package,
    CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey % 50 END AS user_id,
    'Name' || CAST(o_custkey % 1000 AS VARCHAR) AS user_name,
    CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'Surname' || CAST(o_custkey % 97 AS VARCHAR) END AS user_surname,
    'user' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE '+48' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS phone_raw,
    CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 THEN NULL
      ELSE 'Company ' || CAST(o_custkey AS VARCHAR) END AS company_raw,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
      WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN ''
      WHEN o_orderkey % 6 = 2 THEN ' ' || {_PAD} || ' '
      WHEN o_orderkey % 6 = 3 THEN substr({_PAD}, 1, 3) || '-' || substr({_PAD}, 4, 3) || '-'
        || substr({_PAD}, 7, 2) || '-' || substr({_PAD}, 9, 2)
      WHEN o_orderkey % 6 = 4 THEN CAST(o_custkey AS VARCHAR)
      ELSE 'PL' || {_PAD} END AS tax_raw,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL
      WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN ''
      WHEN o_orderkey % 6 IN (2, 4) THEN CAST(o_custkey AS VARCHAR)
      WHEN o_orderkey % 6 = 3 THEN substr({_PAD}, 1, 3) || '-' || substr({_PAD}, 4, 3) || '-'
        || substr({_PAD}, 7, 2) || '-' || substr({_PAD}, 9, 2)
      ELSE 'PL' || {_PAD} END AS tax_norm,
    CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 6 IN (2, 4) THEN o_custkey END AS tax_num
  FROM orders)"""

_EXCL_PLANS = ", ".join(str(x) for x in PRM.excluded_plan_ids)
_EXCL_USERS = ", ".join(str(x) for x in PRM.excluded_user_ids)
_KEPT = ", ".join(_q(s) for s in PRM.kept_statuses)

F1 = f"(p.id IS NULL OR p.id NOT IN ({_EXCL_PLANS}))"
F2 = f"(u.status IN ({_KEPT}))"
F3 = f"(u.user_id IS NULL OR u.user_id NOT IN ({_EXCL_USERS}))"


def _status_label(c: str) -> str:
    return (f"CASE {c} WHEN 'canceled' THEN {_q(LB.status_canceled)} "
            f"WHEN 'active' THEN {_q(LB.status_active)} ELSE {c} END")


def _type_label(c: str) -> str:
    return (f"CASE {c} WHEN 'year' THEN {_q(LB.interval_year)} "
            f"WHEN 'month' THEN {_q(LB.interval_month)} ELSE {c} END")


RB = f"""rb AS (
  SELECT u.id AS client_sub_id, p.id AS plan_id, {_status_label('u.status')} AS status,
    u.purchased_at, u.package, u.expires_at, COALESCE(u.cancelled_raw, u.expires_at) AS cancelled_at,
    u.user_id AS client_id, u.user_name || ' ' || u.user_surname AS client_name, u.email,
    {_type_label('p.recurring_interval')} AS package_type, u.billing_id, u.tax_norm AS tax_id,
    COALESCE(u.company_raw, '') AS company_name, COALESCE(u.phone_raw, '') AS phone
  FROM usubs u LEFT JOIN plans p ON u.subscription_id = p.id
  WHERE {F1} AND {F2} AND {F3})"""

BASE_COLS = ("client_sub_id, plan_id, status, purchased_at, package, expires_at, cancelled_at, "
             "client_id, client_name, email, package_type, billing_id, tax_id, company_name, phone")


# The windows of the proxy run, written out: a wrong bound in the parameters shows here.
CHOSEN_MONTH = "i.created >= DATE '1998-07-01' AND i.created < DATE '1998-08-01'"
CHOSEN_YEAR = "i.created BETWEEN DATE '1997-07-01' AND DATE '1998-07-30'"
WINDOW_MONTHS = "i.created BETWEEN DATE '1998-07-01' AND DATE '1998-08-31'"
WINDOW_TURN_OF_YEAR = "i.created BETWEEN DATE '1997-12-01' AND DATE '1998-01-31'"
WINDOW_YEAR = "i.created BETWEEN DATE '1997-08-01' AND DATE '1998-08-31'"
LAST_MONTHLY = "i.created BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
LAST_YEARLY = "i.created >= DATE '1997-01-01'"
SINCE_1997_07_01, SINCE_2100_01_01 = 867715200, 4102444800


def invs_cte(since_epoch: int) -> str:
    return f"""invs AS (
  SELECT 'in_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
    CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS due_minor,
    CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'paid' WHEN l_returnflag = 'R' THEN 'void' ELSE 'open' END AS status,
    CAST(l_shipdate AS DATE) AS created,
    CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400
      + (CAST(l_linenumber AS BIGINT) - 1) * 3 * 3600 AS created_epoch,
    CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS subscription,
    'cus_' || CAST(l_suppkey AS VARCHAR) AS customer,
    CAST(l_linenumber % 3 AS INTEGER) AS attempt_count,
    CASE WHEN l_linenumber = 1 THEN NULL
      ELSE 'pi_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) END AS payment_intent,
    l_linenumber AS ln, l_partkey AS pk, l_linestatus AS lstat, l_suppkey AS sk,
    l_orderkey AS subscription_key
  FROM lineitem
  WHERE CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400
      + (CAST(l_linenumber AS BIGINT) - 1) * 3 * 3600 >= {since_epoch})"""


def _month_name(expr: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(n)}" for i, n in enumerate(LB.month_names, start=1))
    return f"COALESCE(CASE month({expr}) {whens} END, '')"


def derived_cols(window_months: str = WINDOW_MONTHS) -> str:
    blank = "(rb.billing_id IS NULL OR rb.billing_id = '')"
    none = "NOT EXISTS (SELECT 1 FROM invs)"
    cannot = _q(LB.cannot_determine)
    mon, yr = _q(LB.interval_month), _q(LB.interval_year)

    def first(rng):
        """Newest first, then highest id; a NULL status stays NULL, no invoice is ''."""
        own = f"FROM invs i WHERE i.subscription = rb.billing_id AND {rng}"
        return (f"CASE WHEN EXISTS (SELECT 1 {own}) THEN "
                f"(SELECT i.status {own} ORDER BY i.created_epoch DESC, i.id DESC LIMIT 1) ELSE '' END")

    def anypaid(rng):
        return f"EXISTS (SELECT 1 FROM invs i WHERE i.subscription = rb.billing_id AND i.status = 'paid' AND {rng})"

    last = (f"(SELECT max(i.created) FROM invs i WHERE i.subscription = rb.billing_id "
            f"AND i.status = 'paid' AND (CASE WHEN rb.package_type = {mon} THEN {LAST_MONTHLY} "
            f"WHEN rb.package_type = {yr} THEN {LAST_YEARLY} ELSE TRUE END))")
    return f"""
    CASE WHEN {none} THEN '' WHEN {blank} THEN {cannot}
      WHEN rb.package_type = {mon} THEN {first(CHOSEN_MONTH)}
      WHEN rb.package_type = {yr} THEN {first(CHOSEN_YEAR)}
      ELSE '' END AS status_chosen_month,
    CASE WHEN {none} THEN '' WHEN {blank} THEN {cannot}
      WHEN rb.package_type = {mon} AND {anypaid(window_months)} THEN {_q(LB.paid_flag)}
      WHEN rb.package_type = {yr} AND {anypaid(WINDOW_YEAR)} THEN {_q(LB.paid_flag)}
      ELSE '' END AS paid_last_2_months,
    CASE WHEN {none} THEN '' WHEN {blank} THEN '' ELSE {_month_name(last)} END AS last_invoice_month"""


def lifecycle_expr(params) -> str:
    now = params.as_of.strftime("%Y-%m-%d %H:%M:%S")
    return (f"CASE WHEN client_sub_id IS NULL THEN {_q(LB.lifecycle_unspecified)} "
            f"WHEN expires_at > TIMESTAMP '{now}' THEN {_q(LB.lifecycle_cancelled_active)} "
            f"WHEN expires_at IS NULL THEN {_q(LB.lifecycle_active)} "
            f"ELSE {_q(LB.lifecycle_cancelled)} END")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def report18(since: int = SINCE_1997_07_01, window_months: str = WINDOW_MONTHS) -> str:
    return (with_ctes(PLANS, USUBS, RB, invs_cte(since))
            + f"SELECT rb.*, {derived_cols(window_months)} FROM rb")


# ---- CRM ------------------------------------------------------------------------
_NUM = "(((s_suppkey * 7919 + 1) * 1000003) % 100000000000)"
_TARGET_KEY = 8
_TARGET_NAME = PRM.crm_target_status.strip()

def _crm(where: str) -> str:
    return f"""crm AS (
  SELECT 't' || CAST(s_suppkey AS VARCHAR) AS _id, 'st' || CAST(s_nationkey AS VARCHAR) AS status_id,
    CAST(s_suppkey // {CRM_PAGE_KEYS} AS INTEGER) AS page_no,
    CASE WHEN s_suppkey % 5 = 0 THEN ''
      WHEN s_suppkey % 8 IN (0, 1) AND {_NUM} > 0
        THEN lpad(CAST({_NUM} AS VARCHAR), CAST(greatest(10, length(CAST({_NUM} AS VARCHAR))) AS INTEGER), '0')
      WHEN s_suppkey % 8 = 2 THEN 'PL-' || CAST({_NUM} AS VARCHAR)
      ELSE '' END AS tax_id
  FROM supplier
  WHERE s_suppkey % 13 <> 0 {where})"""


CRM_ALL = _crm("")
CRM = _crm(f"""AND 'st' || CAST(s_nationkey AS VARCHAR) IN (
      SELECT 'st' || CAST(n_nationkey AS VARCHAR) FROM nation
      WHERE trim(n_name) = {_q(_TARGET_NAME)} AND 'pr' || CAST(n_regionkey AS VARCHAR) = {_q(CRM_PROJECT_ID)})""")

CRM_ROWS_SELECT = f"""SELECT CAST(0 AS BIGINT) AS client_sub_id, CAST(0 AS BIGINT) AS plan_id, '' AS status,
    CAST(NULL AS TIMESTAMP) AS purchased_at, {_q(LB.crm_package)} AS package,
    CAST(NULL AS TIMESTAMP) AS expires_at, CAST(NULL AS TIMESTAMP) AS cancelled_at,
    CAST(0 AS BIGINT) AS client_id, '' AS client_name, '' AS email, '' AS package_type,
    '' AS billing_id, tax_id, '' AS company_name, '' AS phone, '' AS status_chosen_month,
    '' AS paid_last_2_months, '' AS last_invoice_month, {_q(LB.lifecycle_unspecified)} AS lifecycle_status
  FROM crm WHERE tax_id <> ''"""


def full_report(params) -> str:
    return (with_ctes(PLANS, USUBS, RB, invs_cte(SINCE_1997_07_01), CRM)
            + f"SELECT rb.*, {derived_cols()}, {lifecycle_expr(params)} AS lifecycle_status FROM rb\n"
            + "UNION ALL\n" + CRM_ROWS_SELECT)


# ---- landing pages ----------------------------------------------------------------
US_RECS = f"""us_recs AS (
  SELECT CAST(id // {PAGE_KEYS} + 1 AS INTEGER) AS page_no,
    CAST(row_number() OVER (PARTITION BY id // {PAGE_KEYS} ORDER BY id) - 1 AS INTEGER) AS pos,
    id, subscription_id, status, billing_id, user_id FROM usubs)"""

PL_RECS = f"""pl_recs AS (
  SELECT CAST(id // {PAGE_KEYS} + 1 AS INTEGER) AS page_no,
    CAST(row_number() OVER (PARTITION BY id // {PAGE_KEYS} ORDER BY id) - 1 AS INTEGER) AS pos,
    id, name, recurring_interval FROM plans)"""

US_SCAN = f"""us_scan AS (
  SELECT page_no, pos, id, subscription_id, status, billing_id, user_id FROM us_recs
  UNION ALL
  SELECT CAST((SELECT max(id) // {PAGE_KEYS} + 1 FROM usubs) + 1 AS INTEGER), pos, id, subscription_id,
    status, billing_id, user_id FROM us_recs WHERE page_no = {REPEATED_PAGE})"""

# One page of plans failed, at nine tenths of the pages (the second at least).
PL_FAILED = "(SELECT greatest(2, max(page_no) * 9 // 10) FROM pl_recs)"
PL_SCAN = f"pl_scan AS (SELECT * FROM pl_recs WHERE page_no < {PL_FAILED})"
PL_ALL = f"pl_scan AS (SELECT * FROM pl_recs WHERE page_no <> {PL_FAILED})"


def _required(src: str, fields: list[tuple[str, str]]) -> str:
    parts = []
    for name, cond in fields:
        parts.append(f"SELECT {_q(src)} AS source, {_q(name)} AS field, count(*) AS records, "
                     f"count_if({cond}) AS missing FROM {src}_req")
    return "\nUNION ALL\n".join(parts)


def _required_from(src: str, table: str, fields: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {_q(src)} AS source, {_q(name)} AS field, count(*) AS records, "
        f"count_if({cond}) AS missing FROM {table}" for name, cond in fields)


def _oracles() -> dict[str, str]:
    p = PRM
    since = SINCE_1997_07_01
    shift_rows = with_ctes(PLANS, USUBS)
    o: dict[str, str] = {}
    o["subscription_report"] = full_report(p)
    o["report_base"] = with_ctes(PLANS, USUBS, RB) + f"SELECT {BASE_COLS} FROM rb"
    o["subscriptions_only"] = (with_ctes(PLANS, USUBS, RB.replace("u.tax_norm AS tax_id", "u.tax_raw AS tax_id"))
                               + f"SELECT {BASE_COLS} FROM rb")
    o["report_no_crm"] = report18()
    o["report_with_crm"] = (
        with_ctes(PLANS, USUBS, RB, invs_cte(since), CRM)
        + f"SELECT rb.*, {derived_cols()}, CAST(NULL AS VARCHAR) AS lifecycle_status FROM rb\n"
        + "UNION ALL\n" + CRM_ROWS_SELECT)
    o["report_no_invoices"] = report18(SINCE_2100_01_01)
    o["invoice_fact"] = with_ctes(invs_cte(since)) + f"""
SELECT id, due_minor / 100 AS amount_due,
  CASE WHEN status = 'paid' THEN due_minor ELSE 0 END / 100 AS amount_paid,
  CASE WHEN status = 'paid' THEN 0 ELSE due_minor END / 100 AS amount_remaining,
  created, customer,
  CASE WHEN ln % 4 = 0 THEN {_q(LB.no_description)} WHEN ln % 4 = 2 THEN NULL
    ELSE 'Item ' || CAST(pk AS VARCHAR) END AS lines_data_description,
  CASE WHEN ln % 4 = 1 THEN CASE WHEN lstat = 'O' THEN 'true' ELSE 'false' END
    WHEN ln % 4 = 3 THEN 'true' ELSE {_q(LB.no_plan_active)} END AS plan_active,
  CASE WHEN ln % 4 = 1 THEN CASE WHEN pk % 2 = 0 THEN 'month' ELSE 'year' END
    WHEN ln % 4 = 3 THEN NULL ELSE {_q(LB.no_plan_interval)} END AS plan_interval,
  subscription, attempt_count, payment_intent, status, status = 'paid' AS paid
FROM invs"""
    o["plan_left_join"] = with_ctes(PLANS) + """
SELECT o_orderkey AS client_sub_id, o_custkey AS subscription_id, p.id AS plan_id, p.recurring_interval
FROM orders LEFT JOIN plans p ON o_custkey = p.id"""
    o["filter_exclusions"] = shift_rows + f"""
SELECT u.id AS client_sub_id, p.id AS plan_id, u.user_id AS client_id, u.status
FROM usubs u LEFT JOIN plans p ON u.subscription_id = p.id WHERE {F1} AND {F2} AND {F3}"""
    o["flatten_struct"] = shift_rows + """
SELECT id, subscription_id, status, created_at_raw AS created_at, ends_at_raw AS ends_at,
  canceled_at_raw AS canceled_at, billing_id AS stripe_subscription_id, package AS subscription_name,
  user_id, user_name, user_surname, email AS user_email, phone_raw AS user_default_phone_e164,
  company_raw AS user_default_address_name, tax_raw AS user_default_address_tax_number
FROM usubs"""
    o["blank_fill"] = shift_rows + """
SELECT id AS client_sub_id, COALESCE(phone_raw, '') AS phone, COALESCE(company_raw, '') AS company_name
FROM usubs"""
    o["full_name"] = shift_rows + """
SELECT id AS client_sub_id, user_name || ' ' || user_surname AS client_name FROM usubs"""
    o["relabel"] = shift_rows + f"""
SELECT u.id AS client_sub_id, {_status_label('u.status')} AS status,
  {_type_label('p.recurring_interval')} AS package_type
FROM usubs u LEFT JOIN plans p ON u.subscription_id = p.id"""
    o["ts_parse"] = shift_rows + """
SELECT id AS client_sub_id, purchased_at, expires_at, cancelled_raw AS cancelled_at FROM usubs"""
    o["cancel_backfill"] = shift_rows + """
SELECT id AS client_sub_id, COALESCE(cancelled_raw, expires_at) AS cancelled_at FROM usubs"""
    o["tax_id_norm"] = shift_rows + """
SELECT id AS client_sub_id, tax_raw AS tax_id_raw, tax_norm AS tax_id, tax_num AS tax_id_num,
  CASE WHEN regexp_replace(tax_raw, '[^0-9]', '', 'g') = '' THEN NULL
    WHEN length(regexp_replace(tax_raw, '[^0-9]', '', 'g')) < 10
      THEN lpad(regexp_replace(tax_raw, '[^0-9]', '', 'g'), 10, '0')
    ELSE regexp_replace(tax_raw, '[^0-9]', '', 'g') END AS tax_id10
FROM usubs"""
    for name in ("status_chosen_month", "paid_last_2_months", "last_invoice_month"):
        o[{"status_chosen_month": "chosen_month_status"}.get(name, name)] = (
            f"SELECT client_sub_id, billing_id, package_type, {name} FROM ({report18()})")
    o["colocated_lookups"] = ("SELECT client_sub_id, billing_id, package_type, status_chosen_month, paid_last_2_months, last_invoice_month "
                              f"FROM ({report18()})")
    o["lifecycle_status"] = (with_ctes(PLANS, USUBS, RB)
                             + f"SELECT client_sub_id, expires_at, {lifecycle_expr(p)} AS lifecycle_status FROM rb")
    o["first_line_item"] = f"""
SELECT 'in_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS id,
  CASE l_linenumber % 7 WHEN 0 THEN {_q(LB.no_description)} WHEN 2 THEN {_q(LB.no_description)}
    WHEN 3 THEN NULL ELSE 'Item ' || CAST(l_partkey AS VARCHAR) END AS lines_data_description,
  CASE l_linenumber % 7 WHEN 1 THEN CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END
    WHEN 4 THEN 'false' WHEN 5 THEN NULL ELSE {_q(LB.no_plan_active)} END AS plan_active,
  CASE l_linenumber % 7 WHEN 1 THEN CASE WHEN l_partkey % 2 = 0 THEN 'month' ELSE 'year' END
    WHEN 4 THEN {_q(LB.no_plan_interval)} WHEN 5 THEN NULL ELSE {_q(LB.no_plan_interval)} END AS plan_interval
FROM lineitem"""
    o["invoice_json_fact"] = with_ctes(invs_cte(since)) + f"""
SELECT id, due_minor / 100 AS amount_due,
  CASE WHEN status = 'paid' THEN due_minor ELSE 0 END / 100 AS amount_paid,
  CASE WHEN status = 'paid' THEN 0 ELSE due_minor END / 100 AS amount_remaining,
  created, customer,
  CASE ln % 7 WHEN 0 THEN {_q(LB.no_description)} WHEN 2 THEN {_q(LB.no_description)}
    WHEN 3 THEN NULL ELSE 'Item ' || CAST(pk AS VARCHAR) END AS lines_data_description,
  CASE ln % 7 WHEN 1 THEN CASE WHEN lstat = 'O' THEN 'true' ELSE 'false' END
    WHEN 4 THEN 'false' WHEN 5 THEN NULL ELSE {_q(LB.no_plan_active)} END AS plan_active,
  CASE ln % 7 WHEN 1 THEN CASE WHEN pk % 2 = 0 THEN 'month' ELSE 'year' END
    WHEN 5 THEN NULL ELSE {_q(LB.no_plan_interval)} END AS plan_interval,
  subscription,
  CAST(CASE ln % 3 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE ln END AS INTEGER) AS attempt_count,
  CASE pk % 3 WHEN 0 THEN {_q(LB.no_payment_intent)} WHEN 1 THEN NULL
    ELSE 'pi_' || CAST(subscription_key AS VARCHAR) || '_' || CAST(ln AS VARCHAR) END AS payment_intent,
  status,
  CASE sk % 3 WHEN 0 THEN FALSE WHEN 1 THEN NULL ELSE coalesce(status = 'paid', FALSE) END AS paid
FROM invs"""
    o["invoice_since"] = with_ctes(invs_cte(since)) + "SELECT id, subscription, created_epoch FROM invs"
    o["newest_n"] = f"""
SELECT o_orderkey AS id,
  CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'O' THEN 'canceled' ELSE 'trial' END AS status
FROM orders ORDER BY o_orderkey DESC LIMIT {NEWEST_N}"""
    o["paged_scan"] = (with_ctes(PLANS, USUBS, US_RECS, US_SCAN)
                       + "SELECT page_no, pos, id, subscription_id, status, billing_id, user_id AS client_id FROM us_scan")
    o["page_prefix"] = with_ctes(PLANS, PL_RECS, PL_SCAN) + "SELECT page_no, pos, id, name, recurring_interval FROM pl_scan"
    o["completeness"] = with_ctes(PLANS, USUBS, US_RECS, US_SCAN, PL_RECS, PL_SCAN) + """
SELECT 'usersubs' AS source, (SELECT count(*) FROM usubs) AS announced, count(*) AS received,
  (SELECT count(*) FROM usubs) - count(*) AS missing,
  ((SELECT count(*) FROM usubs) - count(*)) > count(*) * 0.1 AS significant FROM us_scan
UNION ALL
SELECT 'plans', (SELECT count(*) FROM plans), count(*), (SELECT count(*) FROM plans) - count(*),
  ((SELECT count(*) FROM plans) - count(*)) > count(*) * 0.1 FROM pl_scan"""
    o["dup_ids"] = with_ctes(PLANS, USUBS, US_RECS, US_SCAN, PL_RECS, PL_ALL) + """
SELECT 'usersubs' AS source, count(*) AS records, count(DISTINCT id) AS distinct_ids,
  count_if(id IS NULL) AS null_ids,
  count(*) - count(DISTINCT id) - CASE WHEN count_if(id IS NULL) > 0 THEN 1 ELSE 0 END AS duplicates
FROM us_scan
UNION ALL
SELECT 'plans', count(*), count(DISTINCT id), count_if(id IS NULL),
  count(*) - count(DISTINCT id) - CASE WHEN count_if(id IS NULL) > 0 THEN 1 ELSE 0 END FROM pl_scan"""
    o["required_fields"] = (
        with_ctes(PLANS, USUBS, "usersubs_req AS (SELECT * FROM usubs)", "plans_req AS (SELECT * FROM plans)")
        + _required("usersubs", [("id", "id IS NULL"), ("subscription_id", "subscription_id IS NULL"),
                                 ("user", "FALSE"), ("status", "status IS NULL"),
                                 ("user.id", "user_id IS NULL"),
                                 ("stripe_subscription_id", "billing_id IS NULL")])
        + "\nUNION ALL\n"
        + _required("plans", [("id", "id IS NULL"), ("name", "name IS NULL"), ("price", "FALSE"),
                              ("price.recurring_interval", "recurring_interval IS NULL")]))
    o["required_keys"] = (
        with_ctes(PLANS, USUBS, US_RECS, US_SCAN, PL_RECS, PL_ALL,
                  f"usersubs_keys AS (SELECT s.id, u.user_id, u.billing_id FROM us_scan s JOIN usubs u ON s.id = u.id)",
                  "plans_keys AS (SELECT * FROM pl_scan)")
        + _required_from("usersubs", "usersubs_keys",
                         [("id", "FALSE"), ("subscription_id", "FALSE"), ("user", "FALSE"),
                          ("status", "FALSE"), ("user.id", "user_id IS NULL"),
                          ("stripe_subscription_id", "billing_id IS NULL")])
        + "\nUNION ALL\n"
        + _required_from("plans", "plans_keys",
                         [("id", "FALSE"), ("name", "FALSE"), ("price", "FALSE"),
                          ("price.recurring_interval", "recurring_interval IS NULL")]))
    o["stage_counts"] = with_ctes(PLANS, USUBS) + f"""
SELECT count(*) AS joined, count_if({F1}) AS after_plan_filter, count_if({F1} AND {F2}) AS after_status_filter,
  count_if({F1} AND {F2} AND {F3}) AS after_user_filter
FROM usubs u LEFT JOIN plans p ON u.subscription_id = p.id"""
    o["crm_status_id"] = f"""
SELECT 'pr' || CAST(n_regionkey AS VARCHAR) AS project_id,
  arg_min(CASE WHEN trim(n_name) = {_q(_TARGET_NAME)} THEN 'st' || CAST(n_nationkey AS VARCHAR) END,
          CASE WHEN trim(n_name) = {_q(_TARGET_NAME)} THEN n_nationkey END) AS status_id
FROM nation GROUP BY n_regionkey"""
    o["crm_tasks"] = with_ctes(CRM) + "SELECT _id, status_id, page_no FROM crm"
    o["crm_tax_id"] = with_ctes(CRM_ALL) + "SELECT _id, tax_id FROM crm WHERE tax_id <> ''"
    o["crm_rows"] = with_ctes(CRM) + CRM_ROWS_SELECT
    ts_cols = ("purchased_at", "expires_at", "cancelled_at")
    sel = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" if c in ts_cols else c
                    for c in (BASE_COLS.split(", ") + ["status_chosen_month", "paid_last_2_months",
                                                       "last_invoice_month", "lifecycle_status"]))
    o["report_export"] = f"SELECT {sel} FROM ({full_report(p)})"
    o["report_meta"] = (f"SELECT DATE '{p.as_of.date().isoformat()}' AS as_of_date, count(*) AS row_count "
                        f"FROM ({full_report(p)})")
    o["report_headed"] = _headed(o["report_export"], REPORT_HEADINGS)
    o["invoice_headed"] = _headed(
        f"SELECT * REPLACE (strftime(created, '%Y-%m-%d %H:%M:%S') AS created) FROM ({o['invoice_json_fact']})", INVOICE_HEADINGS)
    o["window_across_years"] = ("SELECT client_sub_id, billing_id, package_type, paid_last_2_months "
                                f"FROM ({report18(window_months=WINDOW_TURN_OF_YEAR)})")
    # Pages hold 100 consecutive customer keys. The run: page 2 tried twice, 5 never landed, 7 empty, 8 cut off, 9 an error object.
    o["page_status"] = with_ctes(PLANS) + """, pg AS (SELECT CAST(id // 100 + 1 AS INTEGER) AS page_no, count(*) AS n FROM plans GROUP BY 1)
SELECT 'odd' AS source, page_no, CAST(CASE page_no WHEN 2 THEN 1 ELSE 0 END AS INTEGER) AS attempt,
  CASE WHEN page_no = 7 THEN 'empty' WHEN page_no IN (8, 9) THEN 'invalid' ELSE 'ok' END AS outcome,
  CAST(CASE WHEN page_no IN (7, 8, 9) THEN 0 ELSE n END AS INTEGER) AS n_records, page_no < 5 AS in_prefix
FROM pg WHERE page_no <> 5"""
    # Pages hold ten consecutive supplier keys from 0: page 1 is empty, the page at nine tenths failed, one page past the announced one is allowed.
    o["crm_task_pages"] = """
SELECT CAST(s_suppkey // 10 AS INTEGER) AS page_no,
  CAST(row_number() OVER (PARTITION BY s_suppkey // 10 ORDER BY s_suppkey) - 1 AS INTEGER) AS pos, 't' || CAST(s_suppkey AS VARCHAR) AS _id
FROM supplier
WHERE s_suppkey // 10 < (SELECT greatest(2, max(s_suppkey // 10) * 9 // 10) FROM supplier) AND s_suppkey // 10 <> 1"""
    o["ts_accepted"] = shift_rows + """
SELECT id AS client_sub_id, purchased_at AS created_at, expires_at AS ends_at, cancelled_raw AS canceled_at
FROM usubs WHERE id % 29 <> 0 OR id % 3 = 0"""
    o["ts_quarantine"] = shift_rows + """
SELECT id AS client_sub_id, 'ends_at' AS "column", ends_at_raw AS raw FROM usubs WHERE id % 29 = 0 AND id % 3 <> 0"""
    o["run_differences"] = shift_rows + """
SELECT id, CASE WHEN id % 97 = 0 THEN 'deleted' WHEN id % 89 = 0 AND status <> 'paused' THEN 'changed' ELSE 'repeated' END AS state,
  CAST(1 AS BIGINT) AS old_rows, CAST(CASE WHEN id % 97 = 0 THEN 0 WHEN id % 83 = 0 THEN 2 ELSE 1 END AS BIGINT) AS new_rows
FROM usubs WHERE id % 97 = 0 OR id % 89 = 0 OR id % 83 = 0
UNION ALL
SELECT id + 1000000000000, 'inserted', 0, 1 FROM usubs WHERE id % 101 = 0"""
    o["flatten_observed"] = with_ctes(PLANS, USUBS, US_RECS, US_SCAN) + f"""
SELECT s.page_no, s.pos, f.*,
  CASE WHEN late THEN 'LATE' END AS coupon_code, CAST(CASE WHEN late THEN 15 END AS BIGINT) AS coupon_percent, CASE WHEN late THEN '["a",1]' END AS tags,
  CASE WHEN s.page_no = 1 AND s.pos = 0 THEN '1' WHEN late THEN '"text"' END AS odd, CAST(NULL AS VARCHAR) AS gone
FROM (SELECT *, pos = 0 AND page_no = (SELECT max(id) // {PAGE_KEYS} + 1 FROM usubs) AS late FROM us_scan) s
JOIN ({o["flatten_struct"]}) f ON f.id = s.id"""
    o["region_overwrite"] = with_ctes(PLANS, USUBS, RB) + """, rows_ AS (
  SELECT row_number() OVER (ORDER BY client_sub_id NULLS FIRST, status NULLS FIRST, package_type NULLS FIRST, billing_id NULLS FIRST) + 1 AS "at",
    client_sub_id, status, package_type, billing_id FROM rb),
grid AS (
  SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 3 = 0 THEN 'A-' || o_orderkey END AS "A", 'C-' || o_orderkey AS "C", 'D-' || o_orderkey AS "D",
    'E-' || o_orderkey AS "E", CASE WHEN o_orderkey % 3 = 0 THEN 'G-' || o_orderkey END AS "G"
  FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey = 1)
SELECT CAST(coalesce(row_no, "at") AS BIGINT) AS row_no, "A", "G",
  CASE WHEN "at" IS NOT NULL THEN CAST(client_sub_id AS VARCHAR) WHEN row_no < 2 THEN "C" END AS "C",
  CASE WHEN "at" IS NOT NULL THEN status WHEN row_no < 2 THEN "D" END AS "D",
  CASE WHEN "at" IS NOT NULL THEN package_type WHEN row_no < 2 THEN "E" END AS "E",
  CASE WHEN "at" IS NOT NULL THEN billing_id END AS "F"
FROM grid FULL JOIN rows_ ON "at" = row_no"""
    o["cursor_pages"] = CURSOR + """
SELECT source, starting_after, attempt, outcome, n_records, last_id, rank, state FROM base_states
UNION ALL
SELECT source, starting_after, 0, 'failed', 0, NULL, NULL, 'superseded' FROM base_states WHERE n % 7 = 3
UNION ALL
SELECT source, starting_after, attempt, 'ok', 1, concat_ws('_', 'zz', c, n), NULL, 'forked' FROM base_states WHERE n % 5 = 4 AND outcome = 'ok'
UNION ALL
SELECT source, concat_ws('_', a, c, n), 0, 'ok', 1, concat_ws('_', b, c, n), NULL, 'cyclic'
FROM base_states, (VALUES ('cya', 'cyb'), ('cyb', 'cya')) AS ring(a, b) WHERE c = 0 AND n % 11 = 6"""
    o["cursor_scan"] = CURSOR + """
SELECT source, rank, pos, id, created FROM recs JOIN base_states USING (c, n) WHERE rank IS NOT NULL"""
    return o


#: Invoices in three chains of pages (by order number modulo 3, 100 orders a page); pages are numbered here only.
CURSOR = """
WITH RECURSIVE recs AS (
  SELECT l_orderkey % 3 AS c, l_orderkey // 300 AS n, 'in_' || l_orderkey || '_' || l_linenumber AS id,
    CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400 + (l_linenumber - 1) * 10800 AS created,
    CAST(row_number() OVER (PARTITION BY l_orderkey % 3, l_orderkey // 300 ORDER BY l_orderkey, l_linenumber, l_shipdate) - 1 AS INTEGER) AS pos
  FROM lineitem),
edge AS (SELECT greatest(1, max(n) * 9 // 10) AS e FROM recs),
raw AS (
  SELECT c, n, count(*) AS size, arg_max(id, pos) AS last,
    NOT (c = 1 AND n = (SELECT e FROM edge)) AS ok, NOT (c = 2 AND n = (SELECT e FROM edge)) AND NOT (c = 1 AND n = (SELECT e FROM edge)) AS more
  FROM recs GROUP BY c, n),
base AS (SELECT r.*, p.n IS NOT NULL AS before, p.ok AS before_ok, p.more AS before_more, p.last AS before_last FROM raw r LEFT JOIN raw p ON p.c = r.c AND p.n = r.n - 1),
chain(c, n, rank) AS (
  SELECT c, n, CAST(0 AS BIGINT) FROM base WHERE n = 0 AND ok
  UNION ALL
  SELECT b.c, b.n, k.rank + 1 FROM chain k JOIN base b ON b.c = k.c AND b.n = k.n + 1 WHERE b.before_more AND b.ok),
lost(c, n, state) AS (
  SELECT c, n, CASE WHEN before AND before_ok THEN 'after_end' ELSE 'broken' END FROM base WHERE n > 0 AND NOT coalesce(before_more, FALSE)
  UNION ALL
  SELECT b.c, b.n, l.state FROM lost l JOIN base b ON b.c = l.c AND b.n = l.n + 1 WHERE b.before_more),
base_states AS (
  SELECT b.c, b.n, 'inv' || b.c AS source, CASE WHEN b.n > 0 THEN coalesce(before_last, concat_ws('_', 'gap', b.c, b.n)) END AS starting_after,
    CAST(CASE WHEN b.n % 7 = 3 THEN 1 ELSE 0 END AS INTEGER) AS attempt, CASE WHEN ok THEN 'ok' ELSE 'failed' END AS outcome,
    CAST(CASE WHEN ok THEN size ELSE 0 END AS INTEGER) AS n_records, CASE WHEN ok THEN last END AS last_id, k.rank,
    CASE WHEN k.rank IS NOT NULL THEN 'ok' ELSE coalesce(l.state, 'end') END AS state
  FROM base b LEFT JOIN chain k USING (c, n) LEFT JOIN lost l USING (c, n))
"""


def _headed(sql: str, headings: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f'{c} AS "{h}"' for c, h in headings.items()) + f" FROM ({sql})"


ORACLES = _oracles()
