"""K1-K5: report and invoice-table sinks."""

from subledger.sinks.writers import (
    REPORT_HEADINGS,
    format_for_export,
    report_meta,
    write_invoice_fact,
    write_report,
)

__all__ = ["REPORT_HEADINGS", "format_for_export", "report_meta", "write_invoice_fact",
           "write_report"]
