"""Column expressions (JVM-side, codegen-friendly): no Python UDFs."""

from subledger.functions.blank import blank_fill, is_blank
from subledger.functions.dates import (
    epoch_to_local_date,
    month_name,
    parse_ts_lenient,
    parse_ts_strict,
    shift_hours,
)
from subledger.functions.text import full_name, relabel
from subledger.functions.tax_id import crm_tax_id, normalize_tax_id, tax_id_number

__all__ = [
    "blank_fill", "is_blank", "epoch_to_local_date", "month_name", "parse_ts_lenient",
    "parse_ts_strict", "shift_hours", "full_name", "relabel", "crm_tax_id",
    "normalize_tax_id", "tax_id_number",
]
