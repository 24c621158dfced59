"""Blank handling: the reference treats null and the empty string alike in tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for NULL or ''; never NULL itself (no trimming, like the reference)."""
    c = _col(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def blank_fill(c: Column | str, fill: str = "") -> Column:
    """NULL -> ``fill`` (the reference's ``fillna('')``)."""
    return F.coalesce(_col(c), F.lit(fill))
