"""String projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.functions.blank import _col


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first + ' ' + last``; NULL when either part is NULL (``concat``, not ``concat_ws``)."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def relabel(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace listed values; NULL and unlisted values pass through unchanged."""
    c = _col(c)
    out = None
    for raw, label in mapping.items():
        out = (F.when(c == F.lit(raw), F.lit(label)) if out is None
               else out.when(c == F.lit(raw), F.lit(label)))
    return c if out is None else out.otherwise(c)
