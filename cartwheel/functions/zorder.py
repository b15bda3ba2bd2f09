"""Interleaved-bit order of two columns, as column expressions.

A table sorted by one column answers ranges of that column from few row groups and of any
other from all of them. Sorted by the interleaved bits of two columns, each row group
covers a small rectangle of both, so that the minima and maxima Parquet keeps of either column
rule out most row groups for a lookup by either.

``spread`` gives a column that is compared by equality only (an id) equal shares of the
bits by its hash; ``scaled`` keeps the order of a column that is asked for by range.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16


def spread(c: Column, bits: int = BITS) -> Column:
    """``bits`` bits of a column's hash; null is 0."""
    return F.when(c.isNull(), 0).otherwise(F.pmod(F.xxhash64(c), F.lit(1 << bits))).cast("bigint")


def scaled(c: Column, low: float, high: float, bits: int = BITS) -> Column:
    """Where the number ``c`` lies between ``low`` and ``high``, in ``bits`` bits; null and what lies below is 0."""
    share = (c.cast("double") - F.lit(float(low))) / F.lit(max(float(high) - float(low), 1e-9))
    place = F.floor(share * (1 << bits))
    return F.coalesce(F.least(F.greatest(place, F.lit(0)), F.lit((1 << bits) - 1)), F.lit(0)).cast("bigint")


def interleaved(x: Column, y: Column, bits: int = BITS) -> Column:
    """The bits of ``x`` and ``y`` in turn, the highest of ``x`` first."""
    out = F.lit(0).cast("bigint")
    for k in range(bits):
        one = F.lit(1).cast("bigint")
        bit_x = F.shiftleft(F.shiftright(x, k).bitwiseAND(one), 2 * k + 1)
        bit_y = F.shiftleft(F.shiftright(y, k).bitwiseAND(one), 2 * k)
        out = out.bitwiseOR(bit_x).bitwiseOR(bit_y)
    return out
