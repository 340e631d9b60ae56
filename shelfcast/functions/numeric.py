"""Exact sums, portable rounding and divisions that never raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Decimal places that amounts keep in sums; more than any money or quantity column of a till has.
PLACES = 10
# Whole units in which means leave a sum: till amounts carry four decimals, daily ones three.
SOURCE_SCALE = 10_000
DAILY_SCALE = 1_000
_WHOLE = float(2**52)  # from here on a double has no fraction
_UNIT = 10**PLACES


def exact_parts(df: DataFrame, name: str) -> tuple[Column, Column]:
    """An amount as whole units and the rest in units of ``10**-PLACES``, both bigint; null and non-finite as 0.

    Sums of whole numbers do not depend on the order in which partitions arrive, so a
    retried task gives the same total and truncation never loses a unit. They stay
    primitive in generated code. A rest is at most half a unit, so its sum has room
    for more than a billion rows of one key; amounts are below 9e18. A decimal column
    with more digits than a double holds is parted as a decimal.
    """
    col, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, DecimalType) and kind.precision > 15:
        whole = F.floor(col).cast("bigint")
        parts = whole, F.round((col - F.floor(col)) * F.lit(_UNIT), 0).cast("bigint")
    else:
        x = col.cast("double")
        x = F.when(F.abs(x) < float("inf"), x).otherwise(0.0)  # NaN is above infinity, null is neither
        # To four decimals by rounding the amount itself, so that 0.1 is a tenth; what remains is tiny.
        near = F.abs(x) < _WHOLE / SOURCE_SCALE
        cut = F.when(near, F.rint(x * F.lit(float(SOURCE_SCALE)))).otherwise(F.rint(x) * F.lit(float(SOURCE_SCALE)))
        tail = F.rint((x - F.when(near, cut / F.lit(float(SOURCE_SCALE))).otherwise(F.rint(x))) * F.lit(float(_UNIT)))
        head = F.when(near, cut - F.rint(x) * F.lit(float(SOURCE_SCALE))).otherwise(0.0)
        parts = F.rint(x).cast("bigint"), (head * F.lit(float(_UNIT // SOURCE_SCALE)) + tail).cast("bigint")
    return tuple(F.coalesce(p, F.lit(0).cast("bigint")) for p in parts)


def units(whole: Column, rest: Column, scale: int) -> Column:
    """A total of parts in units of ``1/scale`` as a double."""
    return whole.cast("double") * F.lit(float(scale)) + rest.cast("double") / F.lit(float(_UNIT // scale))


def truncated(whole: Column, rest: Column) -> Column:
    """A total of parts cut to whole units towards zero, as a double without a negative zero."""
    left = F.pmod(rest, F.lit(_UNIT))
    floor = whole + F.rint((rest - left) / F.lit(float(_UNIT))).cast("bigint")
    return F.when((floor < 0) & (left > 0), floor + 1).otherwise(floor).cast("double")


def half_up(col: Column, digits: int = 3) -> Column:
    """Round half up through ``floor``; ``round`` differs between engines at ties.

    A value too large to have such digits is returned as it is, NaN too.
    """
    unit = F.lit(float(10**digits))
    rounded = F.floor(col * unit + F.lit(0.5)).cast("double") / unit
    return F.when(F.abs(col * unit) < F.lit(_WHOLE), rounded).otherwise(col.cast("double"))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` with null for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def not_nan(col: Column) -> Column:
    """NaN as null, so that averages skip it."""
    return F.when(~F.isnan(col), col)


def clip_low(col: Column, low: float = 0.0) -> Column:
    """Values below ``low`` raised to it; null stays null."""
    return F.when(col.isNotNull(), F.greatest(col, F.lit(low)))
