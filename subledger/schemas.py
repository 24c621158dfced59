"""Explicit schemas of the landed sources and of the outputs.

Nothing is inferred: a field that no record carries still becomes a (null)
column, so a report never fails on a missing nested key.
"""

from __future__ import annotations

from pyspark.sql import types as T

LANDING_PAGE = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("total", T.LongType()),
    T.StructField("last_page", T.IntegerType()),
    T.StructField("body", T.StringType()),
    # a fetch run (the latest, in text order, counts) and the try within it; both may be absent
    T.StructField("run_id", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
])

PLAN = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", T.StructType([T.StructField("recurring_interval", T.StringType())])),
])

USER_SUBSCRIPTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("subscription_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("ends_at", T.StringType()),
    T.StructField("canceled_at", T.StringType()),
    T.StructField("stripe_subscription_id", T.StringType()),
    T.StructField("subscription", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("user", T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("surname", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("default_phone", T.StructType([T.StructField("e164", T.StringType())])),
        T.StructField("default_address", T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("tax_number", T.StringType()),
        ])),
    ])),
])

LINE_ITEM = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("plan", T.StructType([
        T.StructField("active", T.BooleanType()),
        T.StructField("interval", T.StringType()),
    ])),
])

INVOICE_RAW = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("amount_due", T.LongType()),
    T.StructField("amount_paid", T.LongType()),
    T.StructField("amount_remaining", T.LongType()),
    T.StructField("created", T.LongType()),
    T.StructField("customer", T.StringType()),
    T.StructField("subscription", T.StringType()),
    T.StructField("attempt_count", T.IntegerType()),
    T.StructField("payment_intent", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("paid", T.BooleanType()),
    T.StructField("lines", T.StructType([T.StructField("data", T.ArrayType(LINE_ITEM))])),
])

CRM_STATUS = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("name", T.StringType()),
])

CRM_PROJECT = T.StructType([
    T.StructField("_id", T.StringType()),
    T.StructField("statuses", T.ArrayType(CRM_STATUS)),
])

CRM_TASK = T.StructType([T.StructField("_id", T.StringType())])

# Column order of the 19-column report.
REPORT_BASE_COLUMNS = (
    "client_sub_id", "plan_id", "status", "purchased_at", "package", "expires_at",
    "cancelled_at", "client_id", "client_name", "email", "package_type", "billing_id",
    "tax_id", "company_name", "phone",
)
INVOICE_COLUMNS = ("status_chosen_month", "paid_last_2_months", "last_invoice_month")
REPORT_COLUMNS = REPORT_BASE_COLUMNS + INVOICE_COLUMNS + ("lifecycle_status",)

INVOICE_FACT_COLUMNS = (
    "id", "amount_due", "amount_paid", "amount_remaining", "created", "customer",
    "lines_data_description", "plan_active", "plan_interval", "subscription",
    "attempt_count", "payment_intent", "status", "paid",
)
