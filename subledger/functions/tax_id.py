"""Tax-id (NIP) normalisation, report side and CRM side.

The report side turns an all-digit id into a number (so leading zeros go), the
CRM side pads numeric ids to ten digits: one column, two formats, as in the
reference. ``tax_id10`` gives the canonical ten-digit form for joining.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.functions.blank import _col

EDGE_SPACE = r"(?U)^\s+|\s+$"
_DIGITS = r"^[0-9]+$"
_NUMERIC_VARIANT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, EDGE_SPACE, "")


def normalize_tax_id(c: Column | str) -> Column:
    """Report side: NULL/'' unchanged; strip; all digits -> integer text; else stripped text."""
    c = _col(c)
    t = _stripped(c)
    return (F.when(c.isNull() | (c == ""), c)
            .when(t.rlike(_DIGITS), F.regexp_replace(t, "^0+(?=.)", ""))
            .otherwise(t))


def tax_id_number(c: Column | str) -> Column:
    """Numeric form of an all-digit tax id (NULL otherwise or when it overflows BIGINT)."""
    t = _stripped(_col(c))
    return F.when(t.rlike(_DIGITS), t.try_cast("bigint"))


def tax_id10(c: Column | str) -> Column:
    """Canonical form: digits only, left-padded to ten (longer ids kept whole)."""
    digits = F.regexp_replace(_col(c), "[^0-9]", "")
    return (F.when(digits == "", F.lit(None).cast("string"))
            .when(F.length(digits) < 10, F.lpad(digits, 10, "0"))
            .otherwise(digits))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT<"), F.lit(False))


def crm_tax_id(detail: Column | str) -> Column:
    """CRM side, from the task detail as VARIANT: ``client.company.nip``.

    positive number -> integer text left-padded to 10 (longer kept whole);
    non-empty string -> as is; anything else (missing, null, 0, negative,
    empty, client or company not an object) -> ''.
    """
    v = _col(detail)
    company = F.variant_get(v, "$.client.company", "variant")
    nip = F.variant_get(v, "$.client.company.nip", "variant")
    kind = F.schema_of_variant(nip)
    numeric = kind.isin(*_NUMERIC_VARIANT_TYPES) | kind.startswith("DECIMAL")
    as_number = F.try_variant_get(nip, "$", "decimal(38,6)")
    digits = F.floor(as_number).cast("string")
    padded = F.when(F.length(digits) < 10, F.lpad(digits, 10, "0")).otherwise(digits)
    as_text = F.try_variant_get(nip, "$", "string")
    is_true = (kind == "BOOLEAN") & F.coalesce(F.try_variant_get(nip, "$", "boolean"), F.lit(False))
    return (F.when(~_is_object(company) | nip.isNull(), F.lit(""))
            .when(numeric & (as_number > 0), padded)
            # a JSON true counts as the number 1, as Python's bool does
            .when(is_true, F.lit("0000000001"))
            .when((kind == "STRING") & (as_text != ""), as_text)
            .otherwise(F.lit("")))
