"""subledger: subscription-billing reconciliation on Spark DataFrames.

Main entry points::

    from subledger import ReportParams, JobConfig, run_report, configure
    from subledger import subscription_report, report_no_crm, report_base, invoice_fact
"""

from subledger.operators.line_items import invoice_fact, invoice_fact_variant
from subledger.params import Labels, ReportParams
from subledger.plans.job import JobConfig, run_report
from subledger.plans.reports import report_base, report_no_crm, subscription_report
from subledger.session import configure

__version__ = "0.1.0"

__all__ = ["JobConfig", "Labels", "ReportParams", "configure", "invoice_fact", "invoice_fact_variant",
           "report_base", "report_no_crm", "run_report", "subscription_report"]
