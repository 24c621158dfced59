"""DataFrame -> DataFrame operators: flatten, plan join and retention filters,
invoice lookups, lifecycle, line items / invoice fact, CRM branch, data quality."""
