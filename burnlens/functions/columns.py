"""Column helpers shared by every model. All are plain Column expressions
(JVM side, inside whole-stage codegen); none is a UDF.

Exactness rules (so that two engines agree bit for bit):

* ``rnd`` rounds half to even on a double operand: ``rint(x * 10^n) / 10^n``.
* money is summed as DECIMAL(18,4), by its units, and cast to double once (``dsum``);
  averages of rounded ratios are decimal sums over a count (``exact_avg``).
  Inputs carry at most 4 (money) or 6 (ratios) decimals, so this is lossless
  and independent of summation order, i.e. of the partitioning.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(x: str | Column, n: int) -> Column:
    """Round half to even at ``n`` decimals (n in 2, 4, 6)."""
    scale = F.lit(float(10 ** n))
    return F.rint(col(x).cast("double") * scale) / scale


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)`` in double; NULL on a zero or NULL divisor."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def safe_divide(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    """``default`` when the divisor is 0 or NULL, else the quotient."""
    d = col(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(default)).otherwise(col(num).cast("double") / d)


def money(c: str | Column, scale: int = 4) -> Column:
    return col(c).cast(f"decimal(18,{scale})")


#: Below this, a value's units of 10^-scale are read off the double itself; and bits of the lower part of a sum of units.
PLAIN, LOW_BITS = 1e6, 24


def units(c: str | Column, scale: int) -> Column:
    """``money`` as a whole number of 10^-scale. Values that have no more decimals than that, as nearly all do, are exact
    in a double's integers; the others go by the decimal (whose parsing costs ten times as much)."""
    x = col(c).cast("double")
    scaled = x * F.lit(float(10 ** scale))
    plain = (F.abs(x) < F.lit(PLAIN)) & (F.abs(scaled - F.rint(scaled)) < F.lit(1e-3))
    return F.when(plain, F.rint(scaled).cast("bigint")).otherwise((money(c, scale) * F.lit(10 ** scale)).cast("bigint"))


def exact_sum(c: str | Column, scale: int, over: WindowSpec | None = None) -> Column:
    """The double of the sum of ``money``. Units are added up as integers, their upper and lower bits apart, so that no sum
    of 2^38 rows is too large; over a window, which adds up few rows for many results, the decimals themselves."""
    if over is not None:
        return F.sum(money(c, scale)).over(over).cast("double")
    k = units(c, scale)
    high, low = F.sum(F.shiftright(k, LOW_BITS)), F.sum(k.bitwiseAND(F.lit(2 ** LOW_BITS - 1)))
    small = (F.abs(high) < F.lit(2 ** (52 - LOW_BITS))) & (low < F.lit(2 ** 52))
    total = high.cast("decimal(20,0)") * F.lit(2 ** LOW_BITS) + low.cast("decimal(20,0)")
    return F.when(small, (high * F.lit(2 ** LOW_BITS) + low).cast("double") / F.lit(float(10 ** scale))).otherwise(
        (total * F.lit(Decimal(1).scaleb(-scale))).cast("double"))


def dsum(c: str | Column, scale: int = 4, over: WindowSpec | None = None) -> Column:
    """Order-independent sum of a double with at most ``scale`` decimals."""
    return exact_sum(c, scale, over)


def exact_avg(c: str | Column, scale: int, over: WindowSpec | None = None) -> Column:
    """Average that does not depend on summation order (NULLs skipped)."""
    n = F.count(col(c))
    return exact_sum(c, scale, over) / (n if over is None else n.over(over))


def nan_to_null(x: Column) -> Column:
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def flag(cond: Column) -> Column:
    """``if(cond, true, false)``: a NULL condition gives false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def to_monday(d: str | Column) -> Column:
    return F.date_trunc("week", col(d)).cast("date")


def month_key(d: str | Column) -> Column:
    return F.date_format(col(d), "yyyyMM")


def case_map(c: str | Column, pairs, default=None) -> Column:
    """``case c when k then v ... else default end`` from (k, v) pairs."""
    c = col(c)
    expr = None
    for k, v in pairs:
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr if default is None else expr.otherwise(F.lit(default))


def running(partition: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def trailing(partition: list[str], order: list[str], start: int, end: int = 0) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(start, end)
