"""Column-expression helpers shared by the operators.

All are built-in Spark SQL expressions (codegen'd, JVM-side). Money is summed
as ``decimal(18,2)`` so totals do not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """A money value as an exact 2-place decimal."""
    return col_(c).cast(MONEY)


def money_sum(c) -> Column:
    """Order-independent sum of a money column, returned as double."""
    return F.sum(money(c)).cast("double")


def parse_ts(df: DataFrame, name: str) -> Column:
    """Timestamp from an ISO string (NULL if unparsable, never an error under
    ANSI); typed timestamp columns pass through unchanged."""
    dt = df.schema[name].dataType
    if isinstance(dt, T.StringType):
        return F.try_to_timestamp(F.col(name))
    return F.col(name)


def whole_seconds(start, end) -> Column:
    """Whole seconds from start to end (truncated), on naive or zoned timestamps."""
    s, e = col_(start), col_(end)
    micros = F.unix_micros(e.cast("timestamp")) - F.unix_micros(s.cast("timestamp"))
    return F.floor(micros / F.lit(1_000_000)).cast("int")


def safe_size(c) -> Column:
    """Array length with NULL counted as 0, whatever the ANSI setting
    (``size(NULL)`` is NULL under ANSI and -1 without it)."""
    c = col_(c)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def div_half_up(num, den, places: int = 2) -> Column:
    """round(num / den, places), half away from zero, for integral num/den,
    computed with integer division only (exact; no binary or
    intermediate-decimal rounding). NULL when den is 0 or NULL."""
    n, d = col_(num).cast("decimal(38,0)"), col_(den).cast("decimal(38,0)")
    scale = 10 ** places
    q = F.call_function("div", F.lit(2) * F.abs(n) * F.lit(scale) + d, F.lit(2) * d)
    return F.when(d != 0, F.signum(n) * q.cast("double") / F.lit(float(scale)))


def array_fields(array_col: str, *fields: str) -> Column:
    """array<struct> restricted to ``fields``, built from per-field arrays
    (``items.product_id`` ...). Field extractions prune the Parquet scan to
    those nested columns; exploding the whole array (or a lambda over it)
    would read every field of every element."""
    return F.arrays_zip(*[F.col(f"{array_col}.{f}").alias(f) for f in fields])
