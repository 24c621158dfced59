"""A Bloom filter in DataFrame functions: which rows may have one of many ids.

The filter is one row (an array of 64-bit words of bounded size) that a scalar
subquery brings to the scan; building it starts no job and collects no ids. It
lets every wanted id through and few others, so an exact join comes after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter (128 kB): some 2 % of other ids pass when it holds 70 000.
BITS = 1 << 20


def _places(value: Column, bits: int) -> list[Column]:
    return [F.pmod(h, F.lit(bits)) for h in (F.xxhash64(value), F.xxhash64(F.lit("second"), value))]


def _mask(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def bloom_filter(ids: DataFrame, column: str, bits: int = BITS) -> Callable[[Column | str], Column]:
    """A test for values that may be among ``column`` of ``ids``: true for all that are, NULL never."""
    places = ids.filter(F.col(column).isNotNull()).select(F.explode(F.array(*_places(F.col(column), bits))).alias("_p"))
    words = places.groupBy(F.shiftright("_p", 6).alias("_w")).agg(F.bit_or(_mask(F.col("_p"))).alias("_b"))
    every = ids.sparkSession.range(bits >> 6).join(words, F.col("id") == F.col("_w"), "left")
    row = every.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("_b", F.lit(0).cast("long")).alias("b")))).alias("_f"))
    found = row.select(F.transform("_f", lambda x: x["b"]).alias("words")).scalar()

    def test(value: Column | str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        hits = [F.get(found, F.shiftright(p, 6).cast("int")).bitwiseAND(_mask(p)) != 0 for p in _places(value, bits)]
        return value.isNotNull() & hits[0] & hits[1]

    return test
