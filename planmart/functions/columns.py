"""Column expressions. Everything here is a built-in Spark expression, so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from decimal import Decimal
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def passes(cond: Column) -> Column:
    """A rule passes only when its predicate is TRUE (NULL fails, as in a filter)."""
    return F.coalesce(cond, F.lit(False))


def isin_or_false(col: Column | str, values: Sequence) -> Column:
    """Membership that treats an empty selection as 'no rows' (not 'no filter')."""
    c = F.col(col) if isinstance(col, str) else col
    values = list(values)
    return c.isin(values) if values else F.lit(False)


def decimal_avg(total: Column, count: Column, input_type: T.DecimalType) -> Column:
    """Mean of decimals from a partial sum and count, typed like ``avg``.

    ``avg(decimal(p,s))`` returns ``decimal(p+4, s+4)`` computed from a
    ``decimal(p+10, s)`` sum; rebuilding it from pre-aggregated parts keeps the
    exact value and type while letting the sums be combined map-side.
    """
    p, s = input_type.precision, input_type.scale
    sum_type = T.DecimalType(min(p + 10, 38), s)
    out_type = T.DecimalType(min(p + 4, 38), min(s + 4, 38))
    return F.when(count > 0, (total.cast(sum_type) / count.cast(T.DecimalType(20, 0))).cast(out_type))


def rounded_avg(col: Column | str, places: int) -> Column:
    """``ROUND(AVG(x), k)``: HALF_UP on the decimal mean, nulls skipped."""
    return F.round(F.avg(col), places)


def affordability_score_exact(deductible: Column | str, oop_max: Column | str) -> Column:
    """deductible + 0.3 * out-of-pocket max, exact in decimal (null if either is null)."""
    d = F.col(deductible) if isinstance(deductible, str) else deductible
    o = F.col(oop_max) if isinstance(oop_max, str) else oop_max
    return d + o * F.lit(Decimal("0.3"))


def percent(num: Column, den: Column, places: int, out_type: str = "decimal(7,2)") -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), k)`` in exact decimal arithmetic."""
    ratio = num.cast("decimal(20,0)") * F.lit(Decimal("100.0")) / F.nullif(den, F.lit(0)).cast("decimal(20,0)")
    return F.round(ratio, places).cast(out_type)


# Numbers as text: sign, digits with or without a point, exponent; or an infinity. No suffix, no hexadecimal, no grouping.
NUMBER = r"^[ \t\r\n]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"
INFINITY = r"^[ \t\r\n]*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?[ \t\r\n]*$"


def lenient_double(col: Column | str) -> Column:
    """Text as a number; NULL where it is none, is NaN or is out of range.

    The grammar is checked before the cast, whose own one is wider: it takes
    ``1d``, ``2.5F`` and ``0x1p3``.
    """
    c = F.trim(F.translate(F.col(col) if isinstance(col, str) else col, "\t\r\n", "   "))
    value = c.try_cast(T.DoubleType())
    finite = F.abs(value) < F.lit(float("inf"))
    return F.when(c.rlike(NUMBER) & finite, value).when(c.rlike(INFINITY), value)


def canonical_position(col: Column | str, values: Sequence[str]) -> Column:
    """1-based position of a value in a fixed display order (0 when absent)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_position(F.array(*[F.lit(v) for v in values]), c)
